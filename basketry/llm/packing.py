"""Best-fit packing of tokenised documents with exact-complement hashing.

Each document's token ids, followed by an end id, are one piece, or
several where they exceed a sequence's ``capacity``.  Packing needs only the
number of pieces of each length, at most ``capacity`` numbers:

* *Exact complements.*  From the longest length down, the gap behind a piece is
  looked up among the sums of one, two and three available lengths; a
  combination that fills the gap exactly is used as often as the counts allow.
* *Best fit.*  What remains is packed longest first into the smallest gap that
  holds it.

The plan is a list of templates (lengths and how many sequences have them).
Spark ranks the pieces of each length, spread over hash buckets so that a
length held by a third of all pieces is no hot group, and each piece finds its
place from its rank in the broadcast plan, whose size depends on the
capacity, not on the data.

Defined cases: a null or empty text is one piece, the end id alone; a null id
and repeated rows are packed like any others.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

#: White-space separated strings whose ids a worker keeps; the ids of further ones are kept for one block.
REMEMBERED = 300_000
#: A character that stands between strings encoded together (its own token), and how many of them.
BETWEEN, TOGETHER = "\x01", 100
#: Lower-case letters of Latin-1 alone: neither normalised nor split by the tokenizer.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: Signs that are cut from the end of a string; not the apostrophe, behind which letters may be split off.
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds:
    """Token ids of texts; the tokenizer never joins over white space, so ids are kept per string.

    A string that ends in signs behind a letter or digit is its
    stem's ids and theirs, and A-Z are lower-cased first: the tokenizer itself only sees
    each stem.  A plain word is all of one piece, whose last token carries the model's
    suffix: many such words go to the model together, past the steps that would leave them as they are.
    """

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # a task has one core; threads only add memory
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids[0]
        self.words = Tokenizer(self.tokenizer.model)          # the same model, for plain words
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, vocabulary = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[n for token, n in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known: dict[bytes, int] = {}
        self.count = self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        C.trim()              # what parsing the vocabulary took

    def _add(self, strings: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        total, n = len(flat), len(strings)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + n > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used:self.used + total] = flat
        self.start[self.count:self.count + n] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count:self.count + n] = sizes
        self.known.update(zip(strings, range(self.count, self.count + n), strict=True))
        self.used += total
        self.count += n

    def _encode_all(self, strings: list[bytes]) -> None:
        plain, other = [], strings
        if self.last.any():
            is_plain = list(map(PLAIN.fullmatch, strings))
            plain, other = [s for s, p in zip(strings, is_plain, strict=True) if p], [s for s, p in zip(strings, is_plain, strict=True) if not p]
        parts = [b" ".join(plain[i:i + TOGETHER]).decode() for i in range(0, len(plain), TOGETHER)]
        if parts:
            ids = np.concatenate([np.array(part.ids, np.uint32) for part in self.words.encode_batch_fast(parts, add_special_tokens=False)])
            self._add(plain, ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1))
        alone = [s for s in other if b"\x01" in s]
        joined = [s for s in other if b"\x01" not in s]
        parts = [f" {BETWEEN} ".join(s.decode("utf-8", "replace") for s in joined[i:i + TOGETHER]) for i in range(0, len(joined), TOGETHER)]
        for part, k in zip(self.tokenizer.encode_batch_fast(parts, add_special_tokens=False), range(0, len(joined), TOGETHER), strict=True):
            ids = np.array(part.ids, np.uint32)
            cut = ids == self.between
            edge = np.concatenate([[-1], np.flatnonzero(cut), [len(ids)]])
            self._add(joined[k:k + TOGETHER], ids[~cut], np.diff(edge) - 1)
        for s in alone:
            ids = np.array(self.tokenizer.encode(s.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
            self._add([s], ids, np.array([len(ids)]))

    @staticmethod
    def _split(s: bytes) -> tuple[bytes, bytes]:
        """(stem, signs at the end)."""
        stem = s if b"<|" in s else s.rstrip(SIGNS)      # a special token stays whole
        if len(stem) < len(s) and not (stem[-1:].isalnum() or stem and stem[-1] >= 128 and stem.decode("utf-8", "replace")[-1].lower()[-1].isalnum()):
            stem = s              # what stands before the stops may be one token with them
        tail = s[len(stem):]
        return stem, tail

    def _learn(self, strings: list[bytes]) -> None:
        ended = [s for s in strings if s[-1] in SIGNS]
        split = [self._split(s) for s in ended]
        parts = chain((s for s in strings if s[-1] not in SIGNS), (part for pair in split for part in pair if part))
        self._encode_all([part for part in dict.fromkeys(parts) if part not in self.known])
        rest = [(s, pair) for s, pair in zip(ended, split, strict=True) if s not in self.known]
        if rest:
            if b"" not in self.known:
                self._add([b""], np.zeros(0, np.uint32), np.zeros(1, np.int64))
            at = np.array([[self.known[a], self.known[b]] for _, (a, b) in rest]).ravel()
            sizes = self.size[at]
            self._add([s for s, _ in rest], self._gather(at), sizes.reshape(-1, 2).sum(1))

    def _gather(self, at: np.ndarray) -> np.ndarray:
        size = self.size[at]
        return self.flat[np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

    def encode(self, texts: list[bytes], end_id: int) -> list[np.ndarray]:
        # the tokenizer lower-cases anyway; special tokens are told by their case
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        words = list(chain.from_iterable(split))
        full, before = self.count >= REMEMBERED, (self.count, self.used)
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(words[k] for k in unknown)))
            at[unknown] = [self.known[words[k]] for k in unknown]
        ids, total = self._gather(at), np.concatenate([[0], np.cumsum(self.size[at])])
        edge = np.cumsum([0] + [len(x) for x in split])
        out = [np.append(ids[total[a]:total[b]], np.uint32(end_id)) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        if full:      # forget what only this block needed: the newest entries come last
            for _ in range(len(self.known) - before[0]):
                self.known.popitem()
            self.count, self.used = before
        return out


_WORKER: dict[int, WordIds] = C.held()


def _with_cache(batches):
    return C.trimmed(batches, _WORKER)


def _piece_rows(batches, tokenizer_json, capacity, end_id, with_ids):
    key = zlib.crc32(tokenizer_json.encode())
    words = _WORKER.setdefault(key, None) or WordIds(tokenizer_json)   # kept by the worker for its next tasks
    _WORKER[key] = words
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        for i, j in C.blocks(offsets):
            texts = [raw[a:b].tobytes() for a, b in zip(offsets[i:j], offsets[i + 1:j + 1], strict=True)]
            own, piece, start, length, crc, blob = [], [], [], [], [], []
            for r, ids in enumerate(words.encode(texts, end_id)):
                data = ids.astype("<u4").tobytes()
                for k, s in enumerate(range(0, len(ids), capacity)):
                    part = data[4 * s:4 * (s + capacity)]
                    own.append(i + r)
                    piece.append(k)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    blob.append(part)
            columns = [batch.column("doc").take(pa.array(own, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(blob, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


class Plan:
    """Templates for counts of lengths: (((length, times), ...), sequences)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.templates: list[tuple[tuple[tuple[int, int], ...], int]] = []
        self._complements()
        self._best_fit()

    def _take(self, lengths: tuple[int, ...]) -> int:
        """Use a combination as often as the counts allow."""
        times = {x: lengths.count(x) for x in lengths}
        n = int(min(self.left[x] // t for x, t in times.items()))
        if n:
            for x, t in times.items():
                self.left[x] -= n * t
            self.templates.append((tuple(sorted(times.items(), reverse=True)), n))
        return n

    def _pair(self, gap: int, held: tuple[int, ...], most: int) -> tuple[int, int] | None:
        """The two available lengths of this sum whose longer one is the longest."""
        if gap < 2:
            return None
        longer = np.arange(min(gap - 1, most), (gap + 1) // 2 - 1, -1)
        if not len(longer):
            return None
        free = self.left
        if held:
            free = free.copy()
            for x in held:
                free[x] -= 1
        shorter = gap - longer
        good = np.flatnonzero((free[longer] > 0) & (free[shorter] > (longer == shorter)))
        return (int(longer[good[0]]), int(shorter[good[0]])) if len(good) else None

    def _filling(self, length: int) -> tuple[int, ...] | None:
        gap = self.capacity - length
        if self.left[gap] > (gap == length):
            return (gap,)
        pair = self._pair(gap, (length,), length)
        if pair:
            return pair
        for first in np.flatnonzero(self.left[:min(gap, length) + 1])[::-1]:
            if first * 3 < gap:
                break
            if first < gap and self.left[first] > (first == length):
                pair = self._pair(gap - int(first), (length, int(first)), int(first))
                if pair:
                    return (int(first), *pair)
        return None

    def _complements(self):
        self._take((self.capacity,))
        for length in range(self.capacity - 1, 0, -1):
            while self.left[length]:
                filling = self._filling(length)
                if not filling or not self._take((length, *filling)):
                    break

    def _best_fit(self):
        gaps: dict[int, list] = {}
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                n = int(self.left[length])
                gap = min((g for g, kept in gaps.items() if g >= length and kept), default=None)
                if gap is not None:      # as many as fit behind one another into the smallest gap
                    template, sequences = gaps[gap].pop()
                    times = min(gap // length, n)
                    used = min(sequences, n // times)
                    if used < sequences:
                        gaps[gap].append((template, sequences - used))
                else:
                    template, gap = (), self.capacity
                    times = min(gap // length, n)
                    used = n // times
                self.left[length] -= used * times
                gaps.setdefault(gap - times * length, []).append((template + ((length, times),), used))
        for kept in gaps.values():
            self.templates.extend(kept)

    def runs(self) -> dict[str, np.ndarray]:
        """For each length, runs of ranks: first rank, first sequence, pieces per sequence, offset."""
        rank = np.zeros(self.capacity + 1, np.int64)
        rows, sequence = [], 0
        for template, sequences in self.templates:
            offset = 0
            for length, times in template:
                rows.append((length, rank[length], sequence, times, offset))
                rank[length] += times * sequences
                offset += length * times
            sequence += sequences
        rows.sort()
        names = ("length", "rank", "sequence", "times", "offset")
        return {n: np.array([r[k] for r in rows], np.int64) for k, n in enumerate(names)} | {"sequences": sequence}


def _placed(batches, runs):
    key = (runs["length"] << 44) | runs["rank"]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        at = np.searchsorted(key, (length << 44) | rank, side="right") - 1
        inside = rank - runs["rank"][at]
        times = runs["times"][at]
        sequence = runs["sequence"][at] + inside // times
        offset = runs["offset"][at] + inside % times * length
        kept = [(n, batch.column(n)) for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(sequence), pa.array(offset)],
                                         names=[n for n, _ in kept] + ["sequence_id", "offset"])


def pieces_of(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
              capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc, piece, start, length, ids_crc32 (and the ids, little-endian 32 bits) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)    # a vocabulary file: a few MB
    schema = "doc long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .mapInArrow(lambda it: _with_cache(_piece_rows(it, shared.value, capacity, end_id, with_ids)), schema))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for)."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    spark = docs.sparkSession
    pieces = C.checkpointed(pieces_of(docs, tokenizer_json, id_col, text_col, capacity, end_id, with_ids))
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}   # at most ``capacity`` rows
    runs = spark.sparkContext.broadcast(Plan(counts, capacity).runs())

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc", "piece", "ids_crc32")
    ranked = (dealt.withColumn("inside", F.row_number().over(inside) - 1).join(sizes, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("inside")))
    columns = ["doc", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = "doc long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return (ranked.select(*columns, "rank").mapInArrow(lambda it: _placed(it, runs.value), schema)
            .withColumnRenamed("doc", "doc_id"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (binary, in order of place) of pieces packed ``with_ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))      # one sequence: at most its capacity of pieces
    joined = F.aggregate(F.col("parts"), F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select("sequence_id", "n_tokens", joined.alias("ids"))
