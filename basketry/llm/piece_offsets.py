"""SentencePiece encoding that projects every piece to its original bytes, and decoding.

* *Normalisation.*  A model carries a compiled character map: a double-array trie of
  source strings and their replacements.  The trie is walked from all positions of a block of
  texts at once, one byte a step; the longest source string at a position is replaced, any
  other character is copied.  Each byte of the result remembers where its source begins, so
  normalised text and source stay aligned.
* *Encoding.*  The library segments the normalised text (with a copy of the model whose own
  normaliser is switched off).
* *Projection.*  Pieces lie end to end in the normalised bytes; through the alignment each
  piece gets the span of source bytes it stands for.  Spans are gapless up to what the map
  or white-space rules drop; a piece that ends inside a replacement has an empty span, the one
  that completes it has the whole source.
* *Decoding* is the library's.

Defined cases: a null or empty text has no pieces and decodes to the empty text; repeated
rows are encoded each; a null id stays null; texts of any length are encoded whole;
columns beside id and text are ignored, whatever their names.  Models with user-defined symbols, or with
white space as suffix, are refused.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C

SPACE = "▁".encode()
#: Bytes of text worked on at once.
BLOCK = 1 << 19


# ---------------------------------------------------------------- the model file

def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(field number, value, start, end) of a serialised message."""
    at = 0
    while at < len(data):
        start = at
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        yield tag >> 3, value, start, at


def _message(number: int, body: bytes) -> bytes:
    size, out = len(body), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes(out) + bytes([size]) + body


#: A normaliser that changes nothing: no dummy prefix, white space neither removed nor escaped.
_PLAIN = _message(1, b"identity") + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 0])


def plain_model(proto: bytes) -> bytes:
    """The model without its normaliser and self test."""
    kept = b"".join(proto[start:end] for number, _, start, end in _fields(proto) if number not in (3, 4))
    return kept + _message(3, _PLAIN)


# ---------------------------------------------------------------- normalisation

class CharacterMap:
    """The compiled map: a double-array trie and the replacements its leaves point at."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        units = np.frombuffer(compiled, "<u4", size // 4, 4).astype(np.int64) if size else np.zeros(0, np.int64)
        # a unit holds its label, the offset to its children, and whether a leaf (a value) follows
        self.label = units & 0x800000FF
        self.offset = (units >> 10) << ((units & 512) >> 6)
        self.leaf = (units >> 8 & 1).astype(bool)
        self.value = units & 0x7FFFFFFF
        self.text = np.frombuffer(compiled, np.uint8, -1, 4 + size) if size else np.zeros(0, np.uint8)
        self.ends = np.flatnonzero(self.text == 0)

    def longest(self, raw: np.ndarray, limit: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, value) of the longest source string at each start; length 0 where there is none."""
        length, value = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        if not len(self.label):
            return length, value
        live = np.arange(len(start))
        node = np.full(len(start), self.offset[0])
        step = 0
        while len(live):
            at = start[live] + step
            inside = at < limit[live]
            live, node, at = live[inside], node[inside], at[inside]
            byte = raw[at].astype(np.int64)
            node = node ^ byte
            good = (node < len(self.label)) & (byte > 0)
            good &= self.label[np.where(good, node, 0)] == byte
            live, node = live[good], node[good]
            leaf = self.leaf[node]
            node = node ^ self.offset[node]
            length[live[leaf]] = step + 1
            value[live[leaf]] = self.value[node[leaf]]
            step += 1
        return length, value

    def replacements(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) in ``text`` of the replacements."""
        end = self.ends[np.searchsorted(self.ends, value)] if len(value) else value
        return value, end - value


class Normaliser:
    """The normaliser of a model, over many texts at once."""

    def __init__(self, spec: bytes):
        fields = {number: value for number, value, _, _ in _fields(spec)}
        self.map = CharacterMap(fields.get(2, b""))
        self.dummy_prefix, self.strip, self.escape = (bool(fields.get(k, 1)) for k in (3, 4, 5))

    def units(self, raw, offsets):
        """Source units in order: (start, size, replacement value or -1): longest source strings, else characters."""
        begin = np.flatnonzero((raw & 0xC0) != 0x80)
        limit = offsets[np.searchsorted(offsets, begin, side="right")]
        length, value = self.map.longest(raw, limit, begin)
        size = np.diff(np.append(begin, len(raw)))
        step = np.where(length > 0, length, size)
        # a match longer than its character hides those inside it
        kept = np.ones(len(begin), bool)
        reach = 0
        for k in np.flatnonzero(step > size).tolist():
            if kept[k] and begin[k] >= reach:
                reach = begin[k] + step[k]
                kept[k + 1:np.searchsorted(begin, reach)] = False
        return begin[kept], step[kept], np.where(length > 0, value, -1)[kept]

    def _cut_tails(self, out, owner, source, end):
        """Without white space, and marks that stand for it, at the ends of texts; ``end`` moves to where they began."""
        count = np.bincount(owner, minlength=len(end))
        high = np.cumsum(count)
        low, left = high - count, high.copy()
        row = np.flatnonzero(count)
        while len(row):
            cut = np.where(out[left[row] - 1] == 32, 1, 0)
            if self.escape:
                long = left[row] - 3 >= low[row]
                mark = long.copy()
                for k, byte in enumerate(SPACE):
                    mark &= out[np.where(long, left[row] - 3 + k, 0)] == byte
                cut[mark] = 3
            row, cut = row[cut > 0], cut[cut > 0]
            left[row] -= cut
            end[row] = source[left[row]]
            row = row[left[row] > low[row]]
        kept = np.arange(len(out)) < left[owner]
        return out[kept], owner[kept], source[kept]

    def __call__(self, raw: np.ndarray, offsets: np.ndarray):
        """(bytes, offsets, source) of the normalised texts.

        ``source`` has for each byte the begin of its source (in its text) and one more
        entry for each text, the end of what was read: byte b of text r is entry b + r.
        """
        n = len(offsets) - 1
        if len(self.map.label):
            start, size, value = self.units(raw, offsets)
            row = np.searchsorted(offsets, start, side="right") - 1
            mapped = value >= 0
            pool = np.concatenate([raw, self.map.text])
            new, new_size = start.copy(), size.copy()
            new[mapped], new_size[mapped] = self.map.replacements(value[mapped])
            new[mapped] += len(raw)
            out = pool[np.repeat(new - (np.cumsum(new_size) - new_size), new_size) + np.arange(int(new_size.sum()))]
            owner = np.repeat(row, new_size)
            source = np.repeat(start, new_size) - offsets[owner]
            solid = (new_size != 1) | (pool[np.minimum(new, len(pool) - 1)] != 32)
        else:                                       # no map: every byte is copied
            out, start = raw, np.arange(len(raw))
            row = owner = np.repeat(np.arange(n), np.diff(offsets))
            source = start - offsets[owner]
            solid = raw != 32
        end = np.diff(offsets).copy()               # where reading a text ended
        begin = np.zeros(n, np.int64)               # where its first character behind white space begins
        space = out == 32
        if self.strip:
            first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(out) else np.zeros(0, bool)
            again = np.concatenate([[False], space[:-1]]) if len(out) else first
            gone = space & (first | again)
            out, owner, source = out[~gone], owner[~gone], source[~gone]
            out, owner, source = self._cut_tails(out, owner, source, end)
            space = out == 32
            solid = np.flatnonzero(solid)
            some, first = np.unique(row[solid], return_index=True)
            begin[some] = start[solid[first]] - offsets[some]
        count = np.bincount(owner, minlength=n)
        wide = np.where(space, 3, 1) if self.escape else np.ones(len(out), np.int64)
        prefix = np.where((count > 0) & self.dummy_prefix, 3 if self.escape else 1, 0)
        total = prefix + np.bincount(owner, weights=wide, minlength=n).astype(np.int64)
        to = np.concatenate([[0], np.cumsum(total)])
        result, align = np.zeros(to[-1], np.uint8), np.zeros(to[-1] + n, np.int64)
        # places of the bytes behind each text's prefix
        place = np.cumsum(wide) - wide + np.cumsum(prefix)[owner]
        result[place] = out
        align[place + owner] = source
        if self.escape:
            for k, byte in enumerate(SPACE):
                result[place[space] + k] = byte
                align[place[space] + k + owner[space]] = source[space]
        marked = np.flatnonzero(prefix)
        for k, byte in enumerate(SPACE if self.escape else b" "):
            result[to[marked] + k] = byte
            align[to[marked] + k + marked] = begin[marked]
        align[to[1:] + np.arange(n)] = end
        return result, to, align


# ---------------------------------------------------------------- encoding

class Encoder:
    """Ids and source spans of texts, as the library encodes them with this model."""

    def __init__(self, proto: bytes):
        import sentencepiece

        fields = [(number, value) for number, value, _, _ in _fields(proto)]
        trainer = {number: value for f, body in fields if f == 2 for number, value, _, _ in _fields(body)}
        pieces = [dict((number, value) for number, value, _, _ in _fields(body)) for f, body in fields if f == 1]
        kinds = np.array([p.get(3, 1) for p in pieces])
        if (kinds == 4).any() or trainer.get(24, 0):
            raise ValueError("models with user-defined symbols or white space as suffix are not supported")
        self.normaliser = Normaliser(next((body for f, body in fields if f == 3), b""))
        self.size = np.array([1 if kind == 6 else len(p.get(1, b"")) for p, kind in zip(pieces, kinds, strict=True)], np.int64)
        self.unknown = int(np.flatnonzero(kinds == 2)[0])
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=plain_model(proto))

    def encode(self, raw: np.ndarray, offsets: np.ndarray):
        """(ids, pieces of each text, span begins, span ends) of texts laid end to end."""
        data, to, align = self.normaliser(raw, offsets)
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(to[:-1], to[1:], strict=True)]
        found = self.plain.encode(texts, num_threads=1)
        count = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(count.sum()))
        size = self.size[ids]
        edge = np.concatenate([[0], np.cumsum(count)])
        for r in np.unique(np.searchsorted(edge, np.flatnonzero(ids == self.unknown), side="right") - 1).tolist():
            # an unknown piece has the length of what it stands for
            parts = self.plain.encode(texts[r], return_type="proto").pieces
            size[edge[r]:edge[r + 1]] = [len(p.surface.encode()) for p in parts]
        row = np.repeat(np.arange(len(count)), count)
        total = np.concatenate([[0], np.cumsum(size)])
        place = total[:-1] - total[edge[:-1]][row] + to[:-1][row] + row
        return ids, count, align[place], align[place + size]

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[str]:
        edge = np.cumsum(count)[:-1]
        return self.whole.decode([x.tolist() for x in np.split(ids, edge)], num_threads=1) if len(count) else []


_WORKER: dict[int, Encoder] = C.held()


def _with_cache(batches):
    return C.trimmed(batches, _WORKER)


def encoder(proto: bytes) -> Encoder:
    """The encoder of a model, kept by the worker for its next tasks (the last model only)."""
    key = zlib.crc32(proto)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(proto)
    return _WORKER[key]


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(values))


_ENCODED = "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"


def _encoded_rows(batches, proto):
    own = encoder(proto)
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        for i, j in C.blocks(offsets, BLOCK):
            ids, count, begin, end = own.encode(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(i, j - i), *(_lists(x.astype(np.int32), count) for x in (ids, begin, end)), pa.array(own.decode(ids, count), pa.string())],
                names=[c.split()[0] for c in _ENCODED.split(", ")])


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, begins and ends (source bytes of each piece, end exclusive), decoded: a row for each row of ``docs``."""
    with open(model_path, "rb") as file:
        proto = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(proto)             # a vocabulary file: a few MB
    return (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .mapInArrow(lambda it: _with_cache(_encoded_rows(it, shared.value)), _ENCODED))
