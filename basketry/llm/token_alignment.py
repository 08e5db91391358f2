"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes.

* *Groups.*  Tokens of both sides are nodes over the bytes of a text.  Every token points
  to the overlapping token that reaches farthest to the right (itself if none reaches
  farther; of two that end alike, the one of side A).  Doubling the pointers of a whole block
  of texts at once (``to = to[to]`` until nothing changes) takes every token to the terminal
  token of its component, which is its group.  A terminal ends where a token of the other side
  ends too, so the groups are the cuts at common ends.
* *Links.*  Two tokens of different sides are linked where their bytes overlap.  The count of
  an id pair is the number of documents that hold it linked; Spark sums it from counts
  already summed over each task's documents.
* *Judging links.*  Texts are tokenised once; each document's distinct pairs go to a checkpoint,
  compressed.  The pairs held by the most documents (``TABLE_PAIRS`` at most) are broadcast; the
  others, each in few documents, are joined with their counts by a shuffle, so the table of
  pairs may grow without limit and no key is hot.

Defined cases: null and empty texts, and texts whose token bytes differ from the text (a
literal U+2581 reads back as a space), have no tokens, zeros and ''; repeated rows are
documents of their own; ties for the highest count are all best; columns beside id and text are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm import piece_offsets

#: Bytes of text worked on at once.
BLOCK = 1 << 18
#: Strings whose ids a worker keeps; the ids of further ones are kept for one block.
REMEMBERED = 300_000
#: Strings encoded as one text, and the sign that a piece vocabulary writes for a space.
TOGETHER, MARK = 64, "▁".encode()
#: Pairs whose counts are broadcast (8 bytes each and 1 for being best).
TABLE_PAIRS = 1 << 20
#: Pairs a task holds before it passes their counts on.
FLUSH = 2_000_000
#: Steps of the histogram of counts in each doubling.
STEPS = 16


# ---------------------------------------------------------------- tokenizers

def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """One tokenizer: ids of texts and the bytes of each id."""

    def __init__(self, spellings: list[bytes]):
        self.data = np.frombuffer(b"".join(spellings), np.uint8)
        size = np.array([len(x) for x in spellings], np.int64)
        self.start, self.size = np.cumsum(size) - size, size
        # decimal ids, followed by the sign that closes them
        text = [str(k).encode() for k in range(len(spellings))]
        self.width = max(map(len, text)) + 1
        self.digits = np.array([t.ljust(self.width) for t in text]).view(np.uint8).reshape(len(text), self.width)
        self.n_digits = np.array([len(t) for t in text])

    def bytes_of(self, ids):
        size = self.size[ids]
        return self.data[np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


class ByteLevel(Side):
    """A byte-level vocabulary of the ``tokenizers`` library; a space goes before the text."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")        # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        known, of = json.loads(definition), _byte_level()
        spellings = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, k in known["model"]["vocab"].items():
            spellings[k] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        for added in known.get("added_tokens", []):
            spellings[added["id"]] = added["content"].encode()
        super().__init__(spellings)

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with their space."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Side):
    """A SentencePiece model whose normaliser only marks spaces and puts one before the text."""

    def __init__(self, proto: bytes):
        import sentencepiece

        whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        pieces = whole.id_to_piece(list(range(whole.get_piece_size())))
        super().__init__([bytes([int(p[3:5], 16)]) if whole.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)])
        normaliser = next((piece_offsets.Normaliser(body) for number, body, _, _ in piece_offsets._fields(proto) if number == 3), None)
        if normaliser is None or len(normaliser.map.label) or normaliser.strip or not (normaliser.escape and normaliser.dummy_prefix):
            raise ValueError("the model changes its text, so its tokens cannot cover the text's bytes")
        #: Whether no piece reaches over a space behind another character, so words are encoded by themselves.
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_offsets.plain_model(proto))

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with their space."""
        return self.model.encode([t.replace(" ", "▁") for t in texts], num_threads=1)


class Flat:
    """Lists of ids laid end to end; the newest can be forgotten."""

    def __init__(self):
        self.data, self.start, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.count = self.used = 0

    def add(self, data: np.ndarray, size: np.ndarray) -> None:
        total, n = len(data), len(size)
        while self.used + total > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while self.count + n > len(self.size):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.data[self.used:self.used + total] = data
        self.start[self.count:self.count + n] = self.used + np.cumsum(size) - size
        self.size[self.count:self.count + n] = size
        self.used, self.count = self.used + total, self.count + n

    def gather(self, at: np.ndarray) -> np.ndarray:
        size = self.size[at]
        return self.data[np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].astype(np.int64)


class Both:
    """Ids of texts on both sides.  No token of either reaches over a space behind a printable
    ASCII character, so texts are cut there and the ids of each string are kept."""

    def __init__(self, side_a: Side, side_b: Side):
        self.sides = side_a, side_b
        self.known: dict[bytes, int] = {}
        self.flat = Flat(), Flat()

    def _learn(self, strings: list[bytes]) -> None:
        # strings that may stand before another one are encoded together by side A, as one text (side B takes longer so)
        joint = [s for s in strings if 32 < s[-1] < 127 and MARK not in s] if self.sides[1].by_word else []
        apart = [s for s in strings if not (32 < s[-1] < 127) or MARK in s] if self.sides[1].by_word else strings
        start = len(self.known)
        self.known.update(zip(chain(joint, apart), range(start, start + len(strings)), strict=True))
        for (side, flat), encode in zip(zip(self.sides, self.flat, strict=True), (self._together, self._apart), strict=True):
            for lo in range(0, len(joint), TOGETHER * TOGETHER):
                flat.add(*encode(side, joint[lo:lo + TOGETHER * TOGETHER]))
            flat.add(*self._apart(side, apart))

    @staticmethod
    def _apart(side: Side, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = side.ids([s.decode("utf-8", "replace") for s in strings]) if strings else []
        size = np.array([len(x) for x in lists], np.int64)
        return np.fromiter(chain.from_iterable(lists), np.int32, int(size.sum())), size

    def _together(self, side: Side, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings joined to texts; a token that reached over their ends would show in the lengths."""
        ids, _ = self._apart(side, [b"".join(strings[k:k + TOGETHER]) for k in range(0, len(strings), TOGETHER)])
        end = np.cumsum(side.size[ids])
        want = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))
        at = np.searchsorted(end, want)
        if not len(end) or end[-1] != want[-1] or not np.array_equal(end[at], want):
            return self._apart(side, strings)
        return ids, np.diff(at, prepend=-1)

    def ids(self, raw: np.ndarray, offsets: np.ndarray):
        """((ids, tokens of each text) of side A, of side B) of texts that begin with their space."""
        data = raw.tobytes()
        first = np.zeros(len(raw) + 1, bool)
        if self.sides[1].by_word:
            first[1:-1] = (raw[1:] == 32) & (raw[:-1] > 32) & (raw[:-1] < 127)
        first[offsets] = True
        edge = np.flatnonzero(first)
        places = edge.tolist()
        strings = [data[x:y] for x, y in zip(places[:-1], places[1:], strict=True)]
        before = len(self.known), [f.used for f in self.flat]
        at = np.fromiter(map(self.known.get, strings, repeat(-1)), np.int64, len(strings))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(strings[k] for k in unknown)))
            at[unknown] = [self.known[strings[k]] for k in unknown]
        begin = np.searchsorted(edge, offsets[:-1])
        out = [(f.gather(at), np.add.reduceat(f.size[at], begin) if len(begin) else begin) for f in self.flat]
        if before[0] >= REMEMBERED:          # forget what only this block needed: the newest entries come last
            for _ in range(len(self.known) - before[0]):
                self.known.popitem()
            for f, used in zip(self.flat, before[1], strict=True):
                f.count, f.used = before[0], used
        return out


# ---------------------------------------------------------------- alignment of a block

def groups_of(begin_a, end_a, begin_b, end_b):
    """(group of each A token, group of each B token): the place of its component's terminal token.

    Both sides cover the same bytes from 0 without gaps, in order.
    """
    n = len(begin_a)
    end = np.concatenate([end_a, end_b])
    # the last token of the other side that begins before this one ends
    far = np.concatenate([n + np.searchsorted(begin_b, end_a) - 1, np.searchsorted(begin_a, end_b) - 1])
    own = np.arange(len(end))
    farther = (end[far] > end) | ((end[far] == end) & (own >= n))
    to = np.where(farther, far, own)
    while True:
        on = to[to]
        if np.array_equal(on, to):
            return to[:n], to[n:]
        to = on


def _kept(ids, count, good):
    return ids[np.repeat(good, count)], np.where(good, count, 0)


def _spaced(raw, offsets):
    """Texts with a space before each."""
    n = len(offsets) - 1
    out = np.full(len(raw) + n, 32, np.uint8)
    out[np.arange(len(raw)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = raw
    return out, offsets + np.arange(n + 1)


def _same_bytes(side, ids, count, raw, offsets):
    """Which texts equal their tokens' bytes."""
    size = np.bincount(np.repeat(np.arange(len(count)), count), weights=side.size[ids], minlength=len(count)).astype(np.int64)
    want = np.diff(offsets)
    good = size == want
    data = side.bytes_of(ids)
    if not good.all():
        data, raw = data[np.repeat(good, size)], raw[np.repeat(good, want)]
    differ = np.flatnonzero(data != raw)
    if len(differ):
        good[np.repeat(np.flatnonzero(good), want[good])[differ]] = False
    return good


class Aligned:
    """Tokens, groups and links of a block of texts; texts without tokens keep their row."""

    def __init__(self, both: Both, raw, offsets):
        side_a, side_b = both.sides
        spaced, places = _spaced(raw, offsets)
        (a, n_a), (b, n_b) = both.ids(spaced, places)
        good = _same_bytes(side_a, a, n_a, spaced, places) & _same_bytes(side_b, b, n_b, spaced, places) & (np.diff(offsets) > 0)
        (self.a, self.n_a), (self.b, self.n_b) = _kept(a, n_a, good), _kept(b, n_b, good)
        self.n = len(good)
        self.row_a, self.row_b = (np.repeat(np.arange(self.n), x) for x in (self.n_a, self.n_b))
        end_a, end_b = np.cumsum(side_a.size[self.a]), np.cumsum(side_b.size[self.b])
        begin_a, begin_b = end_a - side_a.size[self.a], end_b - side_b.size[self.b]
        self.group_a, self.group_b = groups_of(begin_a, end_a, begin_b, end_b) if len(self.a) else (self.a, self.b)
        # an A token's links: the B tokens that begin before it ends and end after it begins
        first, last = np.searchsorted(end_b, begin_a, side="right"), np.searchsorted(begin_b, end_a)
        size = last - first
        self.link_a = np.repeat(np.arange(len(self.a)), size)
        self.link_b = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        self.n_links = np.bincount(self.row_a, weights=size, minlength=self.n).astype(np.int64)
        terminal = self.group_a == np.arange(len(self.a))
        self.n_groups = np.bincount(self.row_a[terminal], minlength=self.n)

    def digests(self, side_a, side_b):
        """sha256 of each text's groups written as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        import hashlib

        ids = np.concatenate([self.a, self.b])
        group, row = np.concatenate([self.group_a, self.group_b]), np.concatenate([self.row_a, self.row_b])
        is_b = np.repeat([0, 1], [len(self.a), len(self.b)])
        # groups in order of their terminals, A before B, in order of place
        order = np.argsort(2 * group + is_b, kind="stable")
        ids, group, row, is_b = ids[order], group[order], row[order], is_b[order]
        width = max(side_a.width, side_b.width)
        text = np.zeros((len(ids), width), np.uint8)
        size = np.zeros(len(ids), np.int64)
        for k, side in enumerate((side_a, side_b)):
            own = np.flatnonzero(is_b == k)
            text[own, :side.width] = side.digits[ids[own]]
            size[own] = side.n_digits[ids[own]]
        new_group = np.append(group[1:] != group[:-1], True)
        new_side = np.append(is_b[1:] != is_b[:-1], False)
        text[np.arange(len(ids)), size] = np.where(new_group, ord(";"), np.where(new_side, ord("|"), ord(",")))
        data = text[np.arange(width) <= size[:, None]].tobytes()
        total = np.bincount(row, weights=size + 1, minlength=self.n).astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(total)])
        return [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]

    def pairs(self, n_b: int):
        """(pair, times, pairs of each text): distinct linked id pairs ``a * n_b + b`` in order."""
        span = (int(self.a.max(initial=0)) + 1) * n_b             # a block has few texts: rows times pairs fit 64 bits
        key = np.sort(self.row_a[self.link_a] * span + self.a[self.link_a] * n_b + self.b[self.link_b])
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        row, pair = np.divmod(key[start], span)
        return pair, np.diff(np.append(start, len(key))), np.bincount(row, minlength=self.n)


_WORKER: dict[int, Both] = C.held()


def _with_cache(batches):
    return C.trimmed(batches, _WORKER)


def _both(definition: str, proto: bytes) -> Both:
    """The tokenizers, kept by the worker for its next tasks (the last two only)."""
    key = zlib.crc32(proto, zlib.crc32(definition.encode()))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Both(ByteLevel(definition), Pieces(proto))
    return _WORKER[key]


def _blocks(batches, both):
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        for i, j in C.blocks(offsets, BLOCK):
            yield batch.column("doc").slice(i, j - i), Aligned(both, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


# ---------------------------------------------------------------- rows

def _lists(values, count):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(values.astype(np.int32)))


_GROUPS = "doc_id long, a_ids array<int>, a_group array<int>, b_ids array<int>, b_group array<int>"


def _group_rows(batches, shared):
    both = _both(*shared.value)
    for doc, x in _blocks(batches, both):
        # groups of a text are numbered from 0 in order
        terminal = np.unique(x.group_a)
        first = np.concatenate([[0], np.cumsum(x.n_groups)])
        a, b = (np.searchsorted(terminal, g) - first[r] for g, r in ((x.group_a, x.row_a), (x.group_b, x.row_b)))
        yield pa.RecordBatch.from_arrays([doc, _lists(x.a, x.n_a), _lists(a, x.n_a), _lists(x.b, x.n_b), _lists(b, x.n_b)],
                                         names=[c.split()[0] for c in _GROUPS.split(", ")])


_LINKED = "doc long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def _linked_rows(batches, shared):
    both = _both(*shared.value)
    n_b = len(both.sides[1].size)
    for doc, x in _blocks(batches, both):
        pair, times, count = x.pairs(n_b)
        edge = np.concatenate([[0], np.cumsum(count)])
        blobs = []
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            wide = int(e > s and max(pair[e - 1], times[s:e].max()) >= 1 << 32)
            data = np.concatenate([np.diff(pair[s:e], prepend=0), times[s:e]]).astype("<u8" if wide else "<u4").tobytes()
            blobs.append(bytes([wide]) + int(e - s).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if e > s else b"")
        yield pa.RecordBatch.from_arrays(
            [doc, *(pa.array(v.astype(np.int64)) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(x.digests(*both.sides), pa.string()), pa.array(blobs, pa.binary())],
            names=[c.split()[0] for c in _LINKED.split(", ")])


def _unpacked(blob: bytes):
    if not blob:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind, n = ("<u8" if blob[0] else "<u4"), int.from_bytes(blob[1:9], "little")
    data = np.frombuffer(pa.decompress(blob[9:], 2 * n * int(kind[2]), codec="zstd", asbytes=True), kind).astype(np.int64)
    return np.cumsum(data[:n]), data[n:]


def _runs(batches, columns):
    """Rows of about FLUSH pairs together: (columns, pairs, times, pairs of each row)."""
    for batch in batches:
        held, rows = [], 0
        blobs = batch.column("pairs")
        done = 0
        for r in range(batch.num_rows):
            held.append(_unpacked(blobs[r].as_py()))
            rows += len(held[-1][0])
            if rows > FLUSH or r + 1 == batch.num_rows:
                pair, times = (np.concatenate(x) for x in zip(*held, strict=True))
                yield [batch.column(c).slice(done, r + 1 - done) for c in columns], pair, times, np.array([len(x) for x, _ in held])
                held, rows, done = [], 0, r + 1


def _summed(pair, n):
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else order
    return pair[start], np.add.reduceat(n[order], start) if len(pair) else n


def _count_rows(batches):
    """(pair, n): documents that hold a pair, summed over a task's documents."""
    pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for _, more, _, _ in _runs(batches, []):
        pair, n = _summed(np.concatenate([pair, more]), np.concatenate([n, np.ones(len(more), np.int64)]))
        if len(pair) > FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])
            pair, n = pair[:0], n[:0]
    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])


class Table:
    """The pairs of the most documents: their counts, and whether they are best for their A id."""

    def __init__(self, pair, n, best):
        order = np.argsort(pair)
        self.pair, self.n, self.best = pair[order], n[order], best[order]

    def find(self, pair):
        if not len(self.pair):
            return np.zeros(len(pair), bool), np.zeros(len(pair), np.int64)
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        return self.pair[at] == pair, at


def _known_rows(batches, shared):
    """(row, n_best, count_sum) from the pairs of the table."""
    table = shared.value
    for (row,), pair, times, count in _runs(batches, ["row"]):
        hit, at = table.find(pair)
        owner = np.repeat(np.arange(len(count)), count)[hit]
        at, times = at[hit], times[hit]
        sums = []
        for weight in (times * table.best[at], times * table.n[at]):
            total = np.zeros(len(count), np.int64)
            np.add.at(total, owner, weight)
            sums.append(pa.array(total))
        yield pa.RecordBatch.from_arrays([row, *sums], names=["row", "n_best", "count_sum"])


def _other_rows(batches, shared):
    """(row, pair, times) of the pairs outside the table."""
    for (row,), pair, times, count in _runs(batches, ["row"]):
        hit, _ = shared.value.find(pair)
        owner = np.repeat(row.to_numpy(zero_copy_only=False), count)[~hit]
        yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(pair[~hit]), pa.array(times[~hit])], names=["row", "pair", "times"])


# ---------------------------------------------------------------- on Spark

def _source(docs, byte_level_path, piece_path, id_col, text_col):
    with open(byte_level_path, encoding="utf-8") as file:
        definition = file.read()
    with open(piece_path, "rb") as file:
        proto = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((definition, proto))       # vocabulary files: a few MB
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")), shared


def groups(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a_ids, a_group, b_ids, b_group: each document's tokens of both sides and their groups, numbered from 0."""
    source, shared = _source(docs, byte_level_path, piece_path, id_col, text_col)
    return source.mapInArrow(lambda it: _with_cache(_group_rows(it, shared)), _GROUPS)


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, n: in how many documents each id pair is linked."""
    return linked.select("pairs").mapInArrow(lambda it: C.trimmed(_count_rows(it)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    spark = docs.sparkSession
    source, shared = _source(docs, byte_level_path, piece_path, id_col, text_col)
    n_b = len(Pieces(shared.value[1]).size)
    # the checkpoint fixes rows and partitions, so the numbers given to rows stay the same
    linked = C.checkpointed(source.mapInArrow(lambda it: _with_cache(_linked_rows(it, shared)), _LINKED)).withColumn("row", F.monotonically_increasing_id())
    counts = C.checkpointed(pair_counts(linked))
    best = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("most"))          # a row for each A id at most
    judged = counts.join(F.broadcast(best), F.expr(f"pair div {n_b}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))

    # the pairs of the most documents that fit the table: a threshold from a histogram of logarithms
    level = F.floor(F.log2("n") * STEPS)
    least, total = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += r["count"]
        if total > TABLE_PAIRS:
            break
        least = r.level
    common = judged.filter(level >= least).toPandas() if least is not None else judged.limit(0).toPandas()
    table = spark.sparkContext.broadcast(Table(common["pair"].to_numpy(np.int64), common["n"].to_numpy(np.int64), common["best"].to_numpy(np.int64)))
    known = linked.select("row", "pairs").mapInArrow(lambda it: C.trimmed(_known_rows(it, table)), "row long, n_best long, count_sum long")
    if total > len(common):
        other = linked.select("row", "pairs").mapInArrow(lambda it: C.trimmed(_other_rows(it, table)), "row long, pair long, times long")
        rare = judged.filter(level < least) if least is not None else judged
        known = known.unionByName(
            other.join(rare, "pair").select("row", F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
                                            (F.col("times") * F.col("n")).alias("count_sum")))
    sums = known.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (linked.drop("pairs").join(sums, "row")
            .select(F.col("doc").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
