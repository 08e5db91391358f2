"""Brown class-based bigram language model, learnt and applied on Spark.

P(text) = product of P(class | class before) * P(word | class); one end token
closes each text and is the context of its first word.

* *Counts.*  Spark counts every word of the training texts (the table of
  counts has a row for each word; nothing is cut off).
* *Units give the start.*  Exchange clustering first runs on units: the
  ``cluster_words`` most frequent words each, every other word by its last four
  bytes (the ``suffixes`` commonest endings, and one unit for the rest).  Spark
  counts unit bigrams and sums neighbours by class; the driver moves units one by one.
* *Every word is then moved by its own neighbours.*  In each of ``word_rounds`` rounds one scan
  of the training texts counts, for each word, the classes of its left and right neighbours (at
  most 2 x classes numbers a word, however frequent it is); Spark brings a word's counts
  together, and the word goes to the class that raises the likelihood of the class bigrams
  most, against the broadcast class grid.  The ``table_words`` frequent words take part in every round and
  show their new class to their neighbours in the next one; rarer words move in the last
  round, until which they are seen in the class of their ending.  As they all move at once, Spark first
  sums the neighbours of every one of them by its commonest left and right classes (classes x classes
  groups at most); the driver moves the groups one by one, which
  settles the grid that every word is then held against.  A round returns the
  changes of the grid, a cell a row.  Only words unseen in training have the class of their ending.
* *The class bigrams are counted anew* from the final classes of all words, in the pass over the
  texts that also scores them: a text leaves its emission score and the counts of its class pairs.
* *Smoothing.*  Transitions are interpolated with class frequencies; emissions
  are discounted by D_c = n1/(n1 + 2 n2), and what is taken away goes to the
  unseen word of the class.  The unseen words together are one type, as in the base.
* *Scoring.*  ``table_words`` frequent words are looked up in a broadcast table of
  bounded size.  Rarer ones are joined with the table of counts and classes on the
  word and brought to their texts, so the vocabulary may grow without limit.

Defined cases: a null or empty text is one end token; a null id counts as the
id '' when texts are dealt to training; each row is scored by itself, repeated
rows included; ties between classes go to the lower number, and a word stays where no class is better; without
training texts all words are unseen.
"""

from __future__ import annotations

import gc
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C

END = np.uint64(0xE0D)          # stands for the end token; words are mixed hashes
SUFFIX_BYTES = 4
BUCKETS_PER_DOUBLING = 64
FLUSH = 1_500_000
BUCKET_TOKENS = 2_000_000       # training tokens for each bucket of words
PAIR_BUCKETS = 64               # buckets of unit pairs, of which there are units x units at most
SLICES = 16                     # the units' neighbour counts are summed in so many slices
PARTS = 3                       # a pass is so many turns
COMMON_COUNTS = 64              # the smallest counts, whose gains are looked up
TOLERANCE = 0.002               # gain of a pass (nats a token) that ends the exchange


def _spans(raw, offsets):
    """(prefix hashes, start, end, row) of all words of texts laid end to end."""
    raw = C.lower_bytes(raw)
    return C.prefix_hash(raw), *C.word_spans(raw, offsets)


def _ending(prefix, start, end):
    return C.span_hash(prefix, np.maximum(start, end - SUFFIX_BYTES), end)


def _tokens(raw, offsets):
    """(word hash, ending hash, row) of all words of texts laid end to end."""
    prefix, start, end, row = _spans(raw, offsets)
    return C.span_hash(prefix, start, end), _ending(prefix, start, end), row


def _distinct(values):
    """(distinct values in order, a place of each, number of each value among them): hashed, only the distinct ones are sorted."""
    code, some = pd.factorize(values)
    place = np.empty(len(some), np.int64)
    place[code] = np.arange(len(code))
    order = np.argsort(some)
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    return some[order], place[order], number[code]


def _firsts(values):
    """(distinct values in order, a place of each)."""
    order = np.argsort(values)
    values = values[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))
    return values[starts], order[starts]


def _block(raw, offsets):
    """(distinct words in order, their endings, number of each word among them, row): tables are asked once a word."""
    prefix, start, end, row = _spans(raw, offsets)
    distinct, place, number = _distinct(C.span_hash(prefix, start, end))
    return distinct, _ending(prefix, start[place], end[place]), number, row


def _summed(keys, counts):
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts[order], starts), order[starts]


def _count_rows(batches):
    """(word, ending, n) summed over blocks of the training texts."""
    held, rows = [], 0

    def flush():
        word, ending, n = (np.concatenate(x) for x in zip(*held, strict=True))
        word, n, first = _summed(word, n)
        return word, ending[first], n

    def emit(word, ending, n):
        return pa.RecordBatch.from_arrays([pa.array(C.signed(word)), pa.array(C.signed(ending)), pa.array(n)], names=["word", "ending", "n"])

    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        held.append((np.array([END]), np.array([END]), np.array([len(offsets) - 1], np.int64)))
        rows += 1
        for i, j in C.blocks(offsets):
            distinct, ending, number, _ = _block(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            if len(distinct):
                held.append((distinct, ending, np.bincount(number)))
                rows += len(distinct)
            if rows > FLUSH:
                held = [flush()]
                rows = len(held[0][0])
                if rows > FLUSH // 2:
                    yield emit(*held[0])
                    held, rows = [], 0
    if held:
        yield emit(*flush())


class Units:
    """Word -> unit: 0 is the end, then frequent words, then endings, then the rest, then one for each class.

    A counted word has the unit of its class once ``words`` (word, cls) is known: ``own`` holds
    the frequent ones; ``table``, on the driver only, all of them.
    """

    def __init__(self, words: np.ndarray, endings: np.ndarray):
        self.words, self.endings = np.sort(words), np.sort(endings)
        self.size = len(words) + len(endings) + 2
        self.own, self.table = None, None

    def in_table(self, word: np.ndarray) -> np.ndarray:
        return _find(self.own[0], word, 0, 0)[0]

    def __getstate__(self):
        return self.__dict__ | {"table": None}

    def of(self, word: np.ndarray, ending: np.ndarray, more=None) -> np.ndarray:
        """``more``: (sorted words, classes) known beside the frequent ones."""
        _, unit = _find(self.endings, ending, 1 + len(self.words), self.size - 1)
        _, unit = _find(self.words, word, 1, unit)
        if self.table is not None and more is None:
            spark = self.table.sparkSession
            asked = spark.createDataFrame(pd.DataFrame({"word": C.signed(np.unique(word))}))
            got = self.table.join(asked, "word").select("word", "cls").toPandas()
            more = _by_word(got.word.to_numpy(np.int64).view(np.uint64), got.cls.to_numpy())
        for table in (self.own, more):
            if table is not None and len(table[0]):
                hit, at = _find(table[0], word, 0, 0)
                unit = np.where(hit, self.size + table[1][at], unit)
        return np.where(word == END, 0, unit)


def _find(table, keys, base, default):
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64) + default
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    hit = table[at] == keys
    return hit, np.where(hit, at + base, default)


def _by_word(word, value):
    order = np.argsort(word)
    return word[order], np.asarray(value, np.int64)[order]


def _chain(unit, row, n):
    """Units of n texts with their ends: each text's words, then the end; (sequence, row, is word)."""
    count = np.bincount(row, minlength=n)
    place = np.arange(len(row)) + row
    sequence = np.zeros(len(row) + n, np.int64)
    sequence[place] = unit
    owner = np.repeat(np.arange(n), count + 1)
    is_word = np.zeros(len(sequence), bool)
    is_word[place] = True
    return sequence, owner, is_word


def _pairs(sequence, end=0):
    """Previous unit or class of each token; the first word of a text follows an end."""
    before = np.full_like(sequence, end)
    before[1:] = sequence[:-1]
    return before


_PACKED = "bucket long, data binary"


def _packed_rows(buckets, blobs):
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "data"])


def _pack_pairs(pair, n):
    return np.array([len(pair)], np.int64).tobytes() + pair.astype(np.int64).tobytes() + n.astype(np.int64).tobytes()


def _unpack_pairs(blob):
    """(pairs in order, their counts)."""
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    return np.frombuffer(blob, np.int64, size, 8), np.frombuffer(blob, np.int64, size, 8 + 8 * size)


def _bigram_rows(batches, units):
    """(bucket, pairs of units and their counts), summed over blocks of the training texts."""
    held_keys, held_counts, rows = [], [], 0

    def flush():
        keys, n, _ = _summed(np.concatenate(held_keys), np.concatenate(held_counts))
        return keys, n

    def emit(keys, n):
        bucket = (keys % PAIR_BUCKETS).astype(np.uint8)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(PAIR_BUCKETS + 1))
        some = np.flatnonzero(np.diff(edge))
        return _packed_rows(some, [_pack_pairs(keys[order[edge[k]:edge[k + 1]]], n[order[edge[k]:edge[k + 1]]]) for k in some])

    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        for i, j in C.blocks(offsets):
            distinct, ending, number, row = _block(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sequence, _, _ = _chain(units.of(distinct, ending)[number], row, j - i)
            # a block starts after an end, as every text does
            keys, n = np.unique(_pairs(sequence) * units.size + sequence, return_counts=True)
            held_keys.append(keys)
            held_counts.append(n)
            rows += len(keys)
            if rows > FLUSH:
                keys, n = flush()
                held_keys, held_counts, rows = [keys], [n], len(keys)
                if rows > FLUSH // 2:
                    yield emit(keys, n)
                    held_keys, held_counts, rows = [], [], 0
    if held_keys:
        yield emit(*flush())


def _pair_rows(batches):
    """One row a bucket: its pairs, equal ones summed (rows come sorted by bucket)."""
    keys, counts, rows, now = [], [], 0, None

    def summed():
        return _summed(np.concatenate(keys), np.concatenate(counts))[:2]

    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
            if keys and bucket != now:
                yield _packed_rows([now], [_pack_pairs(*summed())])
                keys, counts, rows = [], [], 0
            now = bucket
            pair, n = _unpack_pairs(blob.as_py())
            keys.append(pair)
            counts.append(n)
            rows += len(pair)
            if rows > FLUSH:             # what stays is bounded by the distinct pairs
                some, n = summed()
                keys, counts, rows = [some], [n], 0
    if keys:
        yield _packed_rows([now], [_pack_pairs(*summed())])


def _unit_pairs(texts, units):
    """Table (bucket, data) of the unit pairs of all texts."""
    return (texts.mapInArrow(lambda it: _bigram_rows(it, units), _PACKED).repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_pair_rows, _PACKED))


def _neighbour_rows(batches, classes, n_classes):
    """(slice, cells of units and classes of neighbours with their right and left sums) of one partition of unit pairs."""
    size = len(classes)
    right, left = np.zeros(size * n_classes, np.int64), np.zeros(size * n_classes, np.int64)
    for batch in batches:
        for blob in batch.column("data"):
            pair, n = _unpack_pairs(blob.as_py())
            a, b = np.divmod(pair, size)
            right += np.bincount(a * n_classes + classes[b], weights=n, minlength=size * n_classes).astype(np.int64)
            left += np.bincount(b * n_classes + classes[a], weights=n, minlength=size * n_classes).astype(np.int64)
    some = np.flatnonzero(right + left)
    yield _sliced(some, right[some], left[some], size * n_classes)


def _sliced(cell, right, left, size):
    edge = np.searchsorted(cell, np.arange(SLICES + 1) * -(-size // SLICES))
    some = np.flatnonzero(np.diff(edge))
    blobs = [np.concatenate([x[edge[k]:edge[k + 1]] for x in (cell, right, left)]).tobytes() for k in some]
    return _packed_rows(some, blobs)


def _slice_rows(batches, size):
    """The slices' sums over all partitions."""
    right, left = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        for blob in batch.column("data"):
            cell, r, l = np.frombuffer(blob.as_py(), np.int64).reshape(3, -1)
            right[cell] += r
            left[cell] += l
    some = np.flatnonzero(right + left)
    yield _sliced(some, right[some], left[some], size)


def _neighbours(bigrams, classes, n_classes):
    """Right and left neighbour counts, units x classes, summed by Spark."""
    size = len(classes) * n_classes
    got = (bigrams.mapInArrow(lambda it: _neighbour_rows(it, classes, n_classes), _PACKED).repartition("bucket")
           .mapInArrow(lambda it: _slice_rows(it, size), _PACKED).collect())         # bounded by units and classes
    right, left = np.zeros((2, size))
    for r in got:
        cell, *sums = np.frombuffer(r["data"], np.int64).reshape(3, -1)
        right[cell], left[cell] = sums
    return right.reshape(-1, n_classes), left.reshape(-1, n_classes)


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def _start_classes(bigrams, n_units, n_classes, order):
    """k-means of units by the square roots of their neighbour shares among the commonest units."""
    contexts = min(n_units, 96)
    which = np.full(n_units, contexts)
    which[order[:contexts]] = np.arange(contexts)
    right, left = _neighbours(bigrams, which, contexts + 1)
    weight = right.sum(1)
    profile = np.sqrt(np.hstack([right / np.maximum(right.sum(1, keepdims=True), 1), left / np.maximum(left.sum(1, keepdims=True), 1)]))
    seeds = order[:n_classes - 1]
    centre = profile[seeds]
    for _ in range(12):
        label = np.argmax(2 * profile @ centre.T - (centre ** 2).sum(1), axis=1)
        for c in range(len(centre)):
            own = label == c
            if weight[own].sum():
                centre[c] = np.average(profile[own], axis=0, weights=weight[own])
    label += 1
    label[0] = 0                   # the end token is a class of its own
    return label


def _exchange(classes, right, left, moved, n_classes):
    """Move each unit in ``moved`` to the class that raises the likelihood most."""
    grid = np.zeros((n_classes, n_classes))
    np.add.at(grid, classes, right)
    return _moved_one_by_one(classes, right, left, moved, grid)[0]


def _moved_one_by_one(classes, right, left, moved, grid):
    """(classes, class grid) after each of ``moved`` went to its best class in turn."""
    for u in moved:
        a, r, f = classes[u], right[u], left[u]
        if not r.sum() + f.sum():
            continue
        grid[a] -= r
        grid[:, a] -= f
        grid = np.maximum(grid, 0)
        out, into = grid.sum(1), grid.sum(0)
        gain = (_xlogx(grid + r[None, :]) - _xlogx(grid)).sum(1) + (_xlogx(grid + f[:, None]) - _xlogx(grid)).sum(0)
        own = np.diag(grid)        # this cell takes both
        gain += _xlogx(own + r + f) + _xlogx(own) - _xlogx(own + r) - _xlogx(own + f)
        gain -= _xlogx(out + r.sum()) - _xlogx(out) + _xlogx(into + f.sum()) - _xlogx(into)
        gain[0] = -np.inf
        b = int(np.argmax(gain))
        classes[u] = b
        grid[b] += r
        grid[:, b] += f
    return classes, grid


def learn_classes(bigrams, n_units, n_classes, rounds, order):
    """Exchange clustering in turns: units are dealt once to ``PARTS`` parts, one of which may move in a turn.

    Whole passes go on, for ``rounds`` turns at least, until one gains less than ``TOLERANCE`` a token.
    """
    classes = _start_classes(bigrams, n_units, n_classes, order)
    deal = np.random.default_rng(7).integers(0, PARTS, len(order))
    best, k = (-np.inf, None, None), 0
    while True:
        right, left = _neighbours(bigrams, classes, n_classes)
        if k % PARTS == 0:
            grid = np.zeros((n_classes, n_classes))
            np.add.at(grid, classes, right)
            now = _likelihood(grid) / max(grid.sum(), 1)
            gain = now - best[0]
            if gain > 0:
                best = now, classes.copy(), grid
            if k >= rounds and gain < TOLERANCE:
                return best[1:]
        moved = order[(order != 0) & (deal == k % PARTS)]
        classes = _exchange(classes, right, left, moved, n_classes)
        k += 1


class Model:
    """What scoring needs, all bounded by parameters: units, classes, class tables, frequent words."""

    def __init__(self, units, classes, grid, totals, words, counts, n, v):
        self.units, self.classes, self.words, self.counts, self.n, self.v = units, classes, words, counts, n, v
        self.set_grid(grid)
        self.total, types, once, twice = totals.T
        self.discount = np.clip(np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.05, 0.95)
        self.discount[0] = 0.0     # every text ends: the end token is never unseen
        self.unseen = np.log10(np.maximum(self.discount * types, 1e-3) / np.maximum(self.total, 1))

    def set_grid(self, grid):
        """Transitions from the counts of class pairs."""
        size = len(grid)
        self.grid = grid
        share = (grid.sum(0) + 1) / (grid.sum() + size)
        self.step = np.log10((grid + size * share[None, :]) / (grid.sum(1, keepdims=True) + size))

    def emission(self, count, cls):
        """log10 P(word | class) for a word seen ``count`` times."""
        seen = np.log10(np.maximum(count - self.discount[cls], 1e-9) / np.maximum(self.total[cls], 1))
        return np.where(count > 0, seen, self.unseen[cls])

    def base(self, count):
        return np.log10((count + 1) / (self.n + self.v + 1))


# ---------------------------------------------------------------- classes of all words

def _cell_rows(batches, units, classes, n_classes, buckets, all_words):
    """(bucket, bytes): counts of the neighbours' classes of words, summed over blocks of texts.

    Cell c is a left neighbour of class c, cell ``n_classes`` + c a right one.  Unless
    ``all_words``, only the words of the table send theirs.
    """
    held, rows = [], 0
    cells = 2 * n_classes

    def flush():
        # words in the order of their buckets: (word, cell) sorted once lies bucket by bucket
        word, first, number = _distinct(np.concatenate([w for w, *_ in held]))
        cls = np.concatenate([c for _, c, _, _ in held])[first]
        bucket = (C.mix(word) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
        order = np.argsort(bucket, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        number, start, keys = place[number], 0, []
        for w, _, key, _ in held:
            keys.append(number[start + key // cells] * cells + key % cells)
            start += len(w)
        key, n, _ = _summed(np.concatenate(keys), np.concatenate([n for *_, n in held]))
        number, cell = np.divmod(key, cells)
        word, cls, bucket = word[order], cls[order], bucket[order]
        some, low = np.unique(bucket, return_index=True)
        edge, high = np.searchsorted(number, np.append(low, len(word))), np.append(low[1:], len(word))
        blobs = [_pack(word[x:y], cls[x:y], number[u:v] - x, cell[u:v], n[u:v]) for x, y, u, v in zip(low, high, edge[:-1], edge[1:], strict=True)]
        return _packed_rows(some, blobs)

    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        for i, j in C.blocks(offsets):
            word, ending, number, row = _block(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            if not len(word):
                continue
            own = classes[units.of(word, ending)]
            cls, _, _ = _chain(own[number], row, j - i)            # the end is class 0
            place = np.arange(len(row)) + row
            # a text's first word follows an end, its last one stands before its own
            left, right = np.where(place > 0, cls[place - 1], 0), cls[place + 1]
            if not all_words:
                some = units.in_table(word)
                pick = some[number]
                place = np.cumsum(some) - 1
                word, own, number, left, right = word[some], own[some], place[number[pick]], left[pick], right[pick]
            key, n = np.unique(np.concatenate([number * cells + left, number * cells + n_classes + right]), return_counts=True)
            held.append((word, own, key, n))
            rows += len(key)
            if rows > FLUSH:
                yield flush()
                held, rows = [], 0
    if rows:
        yield flush()


def _pack(word, cls, which, cell, n):
    """The entries lie in the order of their words: a word tells how many are its own; a count of 255 or more stands behind."""
    some = np.minimum(n, 255).astype(np.uint8)
    parts = [np.array([len(word), len(cell)], np.int64), word, n[some == 255].astype(np.int64), cls.astype(np.uint8),
             np.bincount(which, minlength=len(word)).astype("<u2").view(np.uint8), cell.astype(np.uint8), some]
    return zlib.compress(b"".join(x.tobytes() for x in parts), 1)


def _unpack(blob):
    """(words, their classes, word number, cell and count of each entry)."""
    raw = zlib.decompress(blob)
    words, size = np.frombuffer(raw, np.int64, 2)
    out, at = [], len(raw)
    for length in (size, size, 2 * words, words):
        at -= int(length)
        out.append(np.frombuffer(raw, np.uint8, length, at))
    some, cell, per, cls = out
    word = np.frombuffer(raw, np.uint64, words, 16)
    n = some.astype(np.int64)
    n[some == 255] = np.frombuffer(raw[16 + 8 * int(words):at], np.int64)
    return word, cls, np.repeat(np.arange(words), np.frombuffer(per.tobytes(), "<u2")), cell, n


OTHER, OWN, CELL, TOTAL = range(4)
_MOVED = "kind int, key long, value long, n long"


def _merged_rows(batches):
    """One row a bucket: the entries of its words, equal ones summed (rows come sorted by bucket)."""
    held, now = [], None

    def merged():
        word, cls, which, cell, n = zip(*map(_unpack, held), strict=True)
        which = np.concatenate([w[k] for w, k in zip(word, which, strict=True)])
        word, first = _firsts(np.concatenate(word))
        key, n, _ = _summed((np.searchsorted(word, which) << 8) + np.concatenate(cell), np.concatenate(n))
        return _packed_rows([now], [_pack(word, np.concatenate(cls)[first], key >> 8, key & 255, n)])

    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
            if held and bucket != now:
                yield merged()
                held = []
            now = bucket
            held.append(blob.as_py())
    if held:
        yield merged()


def _tables(blob, n_classes, pick=None):
    """(words, classes, left and right neighbours by class) in slices of a bucket's words, or of those that ``pick`` chooses."""
    word, cls, which, cell, n = _unpack(blob)
    cls, which, cell = cls.astype(np.int64), which.astype(np.int64), cell.astype(np.int64)
    chosen = np.arange(len(word)) if pick is None else np.flatnonzero(pick(word))
    for lo in range(0, len(chosen), 20_000):
        some = chosen[lo:lo + 20_000]
        place = np.full(len(word), -1)
        place[some] = np.arange(len(some))
        at = place[which]
        good = at >= 0
        table = np.bincount(at[good] * (2 * n_classes) + cell[good], weights=n[good], minlength=len(some) * 2 * n_classes).reshape(len(some), 2, n_classes)
        yield word[some], cls[some], table[:, 0], table[:, 1]


def _group_rows(batches, units, n_classes):
    """(cell, n): neighbours' classes of all words outside the table, summed by their commonest left and right classes, then by
    their own class; last how many tokens of a group are in which class."""
    cells, groups = 2 * n_classes, n_classes ** 2
    summed, own = np.zeros((groups + n_classes) * cells), np.zeros(groups * n_classes)
    for batch in batches:
        for blob in batch.column("data"):
            for _, cls, left, right in _tables(blob.as_py(), n_classes, lambda w: ~units.in_table(w)):
                group = np.argmax(left, 1) * n_classes + np.argmax(right, 1)
                table = np.hstack([left, right])
                row, cell = np.nonzero(table)
                n = table[row, cell]
                for at in (group, groups + cls):
                    summed += np.bincount(at[row] * cells + cell, weights=n, minlength=len(summed))
                own += np.bincount(group * n_classes + cls, weights=right.sum(1), minlength=len(own))
    total = np.concatenate([summed, own])
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].astype(np.int64))], names=["cell", "n"])


def _settled(got, grid):
    """The class grid after the words outside the table went to their classes, group by group; ``got``: the sums of ``_group_rows``."""
    n_classes = len(grid)
    cells, groups = 2 * n_classes, n_classes ** 2
    total = np.zeros((groups + n_classes) * cells + groups * n_classes)
    total[got.cell] = got.n
    table = total[:(groups + n_classes) * cells].reshape(-1, 2, n_classes)
    own = np.argmax(total[(groups + n_classes) * cells:].reshape(groups, n_classes), axis=1)
    left, right = table[:groups, 0], table[:groups, 1]
    grid = grid - table[groups:, 1] - table[groups:, 0].T           # all of them leave, a group comes back as one
    np.add.at(grid, own, right)
    np.add.at(grid.T, own, left)
    order = np.argsort(-right.sum(1), kind="stable")
    for _ in range(2):
        own, grid = _moved_one_by_one(own, right, left, order, np.maximum(grid, 0))
    return grid


def _move_rows(batches, units, grid, n_classes):
    """(OWN or OTHER, word, class, count) of every word, of the table or not; the table's (CELL, cell, change) of the class grid;
    (TOTAL, four for each class, sum): the tokens of its words, the words, those seen once, those seen twice."""
    change, totals = np.zeros((n_classes, n_classes)), np.zeros((n_classes, 4), np.int64)

    def emit(kind, key, value, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), *(pa.array(x.astype(np.int64)) for x in (value, n))],
                                          names=["kind", "key", "value", "n"])

    for batch in batches:
        for blob in batch.column("data"):
            for in_table in (True, False):
                for word, cls, left, right in _tables(blob.as_py(), n_classes, lambda w, t=in_table: units.in_table(w) == t):
                    best = best_classes(cls, right, left, grid) if in_table else _best_apart(cls, right, left, grid)
                    go = np.flatnonzero((best != cls) & in_table)
                    for sign, to in ((1, best[go]), (-1, cls[go])):
                        np.add.at(change, to, sign * right[go])
                        np.add.at(change.T, to, sign * left[go])
                    n = right.sum(1).astype(np.int64)
                    for k, x in enumerate((n, np.ones_like(n), n == 1, n == 2)):
                        totals[:, k] += np.bincount(best, weights=x, minlength=n_classes).astype(np.int64)
                    yield emit(OWN if in_table else OTHER, C.signed(word), best, n)
    for kind, table in ((CELL, change.ravel()), (TOTAL, totals.ravel())):
        some = np.flatnonzero(table)
        yield emit(kind, some, table[some], np.zeros(len(some)))


def _delta(grid, r):
    return _xlogx(grid + r) - _xlogx(grid)


def _row_sums(term, starts):
    """Sums of the rows from each start to the next, bit for bit those of ``np.add.reduceat``, which is slow on short runs."""
    size = np.diff(starts, append=len(term))
    out = np.empty((len(starts), term.shape[1]))
    order = np.argsort(-size)
    start, size = starts[order], -size[order]
    long, more = np.searchsorted(size, (-8, -1))          # runs of more than 8 rows, of more than 1
    first, rest = term[start[long:]], term[start[long:more] + 1]
    for k in range(2, 8):
        some = int(np.searchsorted(size, -k)) - long
        if some <= 0:
            break
        rest[:some] += term[start[long:long + some] + k]
    first[:more - long] += rest
    out[order[long:]] = first
    if long:
        size = -size[:long]
        edge = np.cumsum(size) - size
        out[order[:long]] = np.add.reduceat(term[np.repeat(start[:long] - edge, size) + np.arange(int(size.sum()))], edge)
    return out


def best_classes(cls, right, left, grid, held=True):
    """The class of each word that raises the likelihood of the class bigrams most, all others standing still.

    ``right`` and ``left`` (words x classes) are the counts of neighbours by class.  ``held``: whether
    the grid counts each word in its class ``cls``.
    """
    n, size = right.shape
    gain = np.zeros((n, size))
    out, into = grid.sum(1), grid.sum(0)
    rows = np.arange(n)
    for counts, table, total in ((right, grid, out), (left, grid.T, into)):
        u, j = np.nonzero(counts)
        r = counts[u, j]
        values, _, which = _distinct(r)
        columns = np.ascontiguousarray(table.T)             # [neighbour class, own class]
        few = _delta(columns[None], values[:COMMON_COUNTS, None, None])
        for lo in range(0, len(u), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            term = few[np.minimum(which[part], COMMON_COUNTS - 1), j[part]] if len(few) else np.zeros((0, size))
            more = lo + np.flatnonzero(which[part] >= COMMON_COUNTS)
            term[more - lo] = _delta(columns[j[more]], r[more, None])
            own = cls[u[part]]                               # its own class without it
            if held:
                term[np.arange(len(own)), own] = _delta(np.maximum(columns[j[part], own] - r[part], 0), r[part])
            starts = np.flatnonzero(np.concatenate([[True], u[part][1:] != u[part][:-1]]))
            gain[u[part][starts]] += _row_sums(term, starts)
        whole = counts.sum(1)
        minus = _delta(total[None, :], whole[:, None])
        if held:
            minus[rows, cls] = _delta(np.maximum(total[cls] - whole, 0), whole)
        gain -= minus
    gain[:, 0] = -np.inf
    best = np.argmax(gain, axis=1)
    return np.where(gain[rows, best] > gain[rows, cls] + 1e-9, best, cls)


def _best_apart(cls, right, left, grid):
    """``best_classes`` of words that the grid does not hold; words seen once between the same classes are looked at once."""
    once = (right.sum(1) == 1) & (left.sum(1) == 1)
    single, rest = np.flatnonzero(once), np.flatnonzero(~once)
    n_classes = len(grid)
    _, place, number = _distinct((np.argmax(left[single], 1) * n_classes + np.argmax(right[single], 1)) * n_classes + cls[single])
    some = np.append(rest, single[place])
    found = best_classes(cls[some], right[some], left[some], grid, held=False)
    best = cls.copy()
    best[rest], best[single] = found[:len(rest)], found[len(rest):][number]
    return best


def _likelihood(grid):
    return _xlogx(grid).sum() - _xlogx(grid.sum(0)).sum() - _xlogx(grid.sum(1)).sum()


def learn_words(texts, units, classes, grid, n_tokens, n_words, rounds):
    """Table (word, cls, n, own) of ``_learn_words``."""
    return _learn_words(texts, units, classes, grid, n_tokens, n_words, rounds)[0]


def _learn_words(texts, units, classes, grid, n_tokens, n_words, rounds):
    """(table (word, cls, n, own: is it of the units' table) of all words of the texts, from the start classes of the units; what they
    sum up to in each class: tokens, words, words seen once, words seen twice).

    Sets the classes of the table's words in ``units`` round by round; ``classes`` covers units and classes.
    """
    spark = texts.sparkSession
    n_classes = len(grid)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // BUCKET_TOKENS))
    for k in range(rounds):
        last = k + 1 == rounds
        shared = spark.sparkContext.broadcast((units, classes))
        cells = (texts.mapInArrow(lambda it, s=shared, w=last: C.trimmed(_cell_rows(it, *s.value, n_classes, buckets, w)), _PACKED)
                 .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: C.trimmed(_merged_rows(it)), _PACKED))
        cells = C.checkpointed(cells)
        if last and n_words > len(units.own[0]):
            # words outside the table move at once: all of them, in groups one by one, show where they will be
            grid = _settled(cells.select("data").mapInArrow(lambda it, s=shared: C.trimmed(_group_rows(it, s.value[0], n_classes)), "cell long, n long")
                            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas(), grid)              # bounded by the classes alone
        now = np.maximum(grid, 0)
        moved = C.checkpointed(cells.select("data").mapInArrow(lambda it, s=shared, g=now: C.trimmed(_move_rows(it, s.value[0], g, n_classes)), _MOVED))
        _release(spark)
        got = moved.filter(F.col("kind") == OWN).select("key", "value").toPandas()                    # the table's words at most
        units.own = _by_word(got.key.to_numpy(np.int64).view(np.uint64), got.value.to_numpy())
        sums = {CELL: np.zeros(n_classes ** 2), TOTAL: np.zeros(4 * n_classes)}
        for r in moved.filter(F.col("kind") >= CELL).groupBy("kind", "key").agg(F.sum("value").alias("sum")).collect():       # a row a cell
            sums[r["kind"]][r["key"]] = r["sum"]
        if not last:
            grid += sums[CELL].reshape(grid.shape)
    words = moved.filter(F.col("kind") <= OWN).select(F.col("key").alias("word"), F.col("value").cast("int").alias("cls"), "n", (F.col("kind") == OWN).alias("own"))
    return words, sums[TOTAL].reshape(-1, 4)


def _release(spark):
    """Ask for a collection, so that Spark's cleaner drops the shuffles of finished steps meanwhile."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- scoring

def _rare_rows(batches, words):
    """(key, word) of the words of each text that are not in the broadcast table."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        key = batch.column("key").to_numpy()
        for i, j in C.blocks(offsets):
            word, _, number, row = _block(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            rare = ~_find(words, word, 0, 0)[0][number]
            row, number = np.divmod(np.unique(row[rare] * max(len(word), 1) + number[rare]), max(len(word), 1))
            yield pa.RecordBatch.from_arrays([pa.array(key[i:j][row]), pa.array(C.signed(word[number]))], names=["key", "word"])


_PARTS = "doc_id long, flag boolean, n_tokens long, n_known long, base_score double, emitted double, pairs binary"


def _part_rows(batches, model):
    """One row per text: its emission score and the counts of its class pairs; ``rare`` has the counted words beside the frequent ones."""
    size = len(model.grid)
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        for i, j in C.blocks(offsets):
            n = j - i
            rare = batch.column("rare").slice(i, n)
            rare = rare.flatten() if isinstance(rare, pa.Array) else rare.combine_chunks().flatten()
            rare_word, rare_n, rare_cls = (rare.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            known, first = _firsts(rare_word.astype(np.int64).view(np.uint64))
            word, ending, number, row = _block(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            # class, count and scores of each distinct word; the end is number 0
            ends = np.array([END])
            cls = np.append(0, model.classes[model.units.of(word, ending, (known, rare_cls[first].astype(np.int64)))])
            word = np.append(ends, word)
            hit, at = _find(model.words, word, 0, 0)
            count = np.where(hit, model.counts[at], 0)
            if len(known):
                hit, at = _find(known, word, 0, 0)
                count = np.where(hit, rare_n[first][at], count)
            cls[0] = model.classes[0]
            sequence, owner, _ = _chain(number + 1, row, n)
            sums = [np.bincount(owner, weights=x[sequence], minlength=n) for x in (np.ones(len(word)), count > 0, model.base(count), model.emission(count, cls))]
            cls = cls[sequence]
            pair, times = np.unique(owner * size ** 2 + _pairs(cls, model.classes[0]) * size + cls, return_counts=True)
            owner, pair = np.divmod(pair, size ** 2)
            edge = np.searchsorted(owner, np.arange(n + 1))
            blobs = [pair[x:y].astype("<u4").tobytes() + times[x:y].astype("<u4").tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc").slice(i, n), batch.column("flag").slice(i, n), *(pa.array(x.astype(np.int64)) for x in sums[:2]),
                                              *(pa.array(x) for x in sums[2:]), pa.array(blobs, pa.binary())], names=[c.split()[0] for c in _PARTS.split(", ")])


def _opened(batch):
    """(row, pair, times) of all texts of a batch."""
    data, offsets = C.texts_of(batch.column("pairs").cast(pa.large_binary()).view(pa.large_string()))
    count = np.diff(offsets) // 8
    values = data.view("<u4") if len(data) else np.zeros(0, "<u4")
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(row)) + np.repeat(np.cumsum(count) - count, count)      # a text's pairs, then as many times
    return row, values[place].astype(np.int64), values[place + count[row]].astype(np.int64)


def _grid_rows(batches, size):
    """(cell, n): class pairs summed over a task's texts."""
    total = np.zeros(size ** 2, np.int64)
    for batch in batches:
        _, pair, times = _opened(batch)
        np.add.at(total, pair, times)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])


_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score_rows(batches, step):
    flat = step.ravel()
    for batch in batches:
        row, pair, times = _opened(batch)
        moved = np.bincount(row, weights=flat[pair] * times, minlength=batch.num_rows)
        score = batch.column("emitted").to_numpy() + moved
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_tokens", "n_known", "base_score")), pa.array(score)],
                                         names=[c.split()[0] for c in _SCORES.split(", ")])


def _parts(docs, model, counts, flag, id_col, text_col):
    """A row a text, see ``_PARTS``; rare words are joined with the table of counts and brought to their texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # rows of one key have one id and text; a key that others share only brings them words they do not ask for
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), flag.alias("flag"), F.xxhash64(id_col, text_col).alias("key"))
    rare = (source.select("key", "text").mapInArrow(lambda it: _rare_rows(it, shared.value.words), "key long, word long")
            .join(counts.select("word", "n", F.col("cls").cast("long").alias("cls")), "word")
            .groupBy("key").agg(F.collect_list(F.struct("word", "n", "cls")).alias("rare")))
    return (source.join(rare, "key", "left").select("doc", "flag", "text", "rare")
            .mapInArrow(lambda it: C.trimmed(_part_rows(it, shared.value)), _PARTS))


def _counted(parts, size):
    """The class grid of the flagged texts."""
    grid = np.zeros(size ** 2)
    for r in parts.filter("flag").select("pairs").mapInArrow(lambda it: _grid_rows(it, size), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        grid[r.cell] = r.n                                              # a row a cell
    return grid.reshape(size, size)


def _finished(parts, model):
    step = model.step
    return parts.drop("flag").mapInArrow(lambda it: _score_rows(it, step), _SCORES)


def _learn(train, text_col, n_classes, cluster_words, suffixes, table_words, rounds, word_rounds) -> tuple[Model, DataFrame, DataFrame]:
    """The model without its class pairs, the table of all word counts (word, ending, n, cls), and (word, n, cls) of the words outside the broadcast table."""
    spark = train.sparkSession
    texts = train.select(F.col(text_col).alias("text"))
    counts = C.checkpointed(texts.mapInArrow(_count_rows, "word long, ending long, n long")
                            .groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")))
    _release(spark)
    # the most frequent words that fit the table: a threshold from a histogram of logarithms
    level = F.floor(F.log2("n") * BUCKETS_PER_DOUBLING)
    histogram = sorted(counts.groupBy(level.alias("b")).agg(F.count("*"), F.sum("n"), F.sum(F.when(F.col("word") == int(END), F.col("n")).otherwise(0))).collect(), reverse=True)
    v, n, ends = (sum(r[k] for r in histogram) for k in (1, 2, 3))
    least, total = math.inf, 0
    for b, size, *_ in histogram:
        total += size
        if total > table_words:
            break
        least = b
    table = counts.filter(level >= (least if least < math.inf else 1 << 40)).select("word", "ending", "n").toPandas().sort_values(["n", "word"], ascending=[False, True])
    words, seen = table.word.to_numpy(np.int64).view(np.uint64), table.n.to_numpy(np.int64)
    frequent = words[words != END][:cluster_words]
    chosen = spark.createDataFrame([(int(x),) for x in C.signed(frequent.copy())], "word long")
    tails = (counts.filter(F.col("word") != int(END)).join(F.broadcast(chosen), "word", "left_anti").groupBy("ending").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "ending").limit(suffixes).toPandas())
    units = Units(frequent, tails.ending.to_numpy(np.int64).view(np.uint64))

    bigrams = C.checkpointed(_unit_pairs(texts, units))
    _release(spark)
    frequency = _neighbours(bigrams, np.zeros(units.size, np.int64), 1)[1].ravel()
    order = np.argsort(-frequency, kind="stable")
    classes, grid = learn_classes(bigrams, units.size, n_classes, rounds, order)

    # the table's words start in the classes of their units
    in_table = words[words != END]
    endings = dict(zip(words.tolist(), table.ending.to_numpy(np.int64).view(np.uint64).tolist(), strict=True))
    start = classes[units.of(in_table, np.array([endings[w] for w in in_table.tolist()], np.uint64))]
    units.own = _by_word(in_table, start)
    classes = np.concatenate([classes, np.arange(n_classes)])
    known, totals = _learn_words(texts, units, classes, grid, int(n), int(v), word_rounds)
    units.table = known
    totals[0] = ends, ends > 0, ends == 1, ends == 2              # the end token is alone in its class
    counts = counts.join(known.select("word", "cls"), "word", "left").withColumn("cls", F.coalesce("cls", F.lit(0)))
    if not len(words):
        words, seen = np.array([END]), np.array([0])
    by_word = np.argsort(words)
    return Model(units, classes, grid, totals, words[by_word], seen[by_word], int(n), int(v)), counts, known.filter("NOT own")


def learn(train: DataFrame, text_col: str = "text", n_classes: int = 48, cluster_words: int = 2048, suffixes: int = 2048,
          table_words: int = 1 << 18, rounds: int = 6, word_rounds: int = 2) -> tuple[Model, DataFrame]:
    """(model, table of all word counts: word, ending, n, cls; joined when it is read) learnt from the texts of ``train``."""
    model, counts, rare = _learn(train, text_col, n_classes, cluster_words, suffixes, table_words, rounds, word_rounds)
    parts = _parts(train.select(text_col).withColumn("__id", F.lit(0)), model, rare, F.lit(True), "__id", text_col)
    model.set_grid(_counted(parts, n_classes))
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10) of every text."""
    return _finished(_parts(docs, model, counts, F.lit(False), id_col, text_col), model)


def learn_and_score(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", n_classes: int = 48, cluster_words: int = 2048,
                    suffixes: int = 2048, table_words: int = 1 << 18, rounds: int = 6, word_rounds: int = 2) -> tuple[Model, DataFrame]:
    """(model of the rows where ``train`` holds, scores of all rows): ``learn`` and ``score`` in one last pass."""
    model, _, rare = _learn(docs.filter(train), text_col, n_classes, cluster_words, suffixes, table_words, rounds, word_rounds)
    parts = C.checkpointed(_parts(docs, model, rare, train, id_col, text_col))
    model.set_grid(_counted(parts, n_classes))
    return model, _finished(parts, model)


def perplexity(scored: DataFrame) -> DataFrame:
    """One row: perplexity of the model and of the base over all tokens scored."""
    ppl = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.agg(F.sum("n_tokens").alias("n_tokens"), ppl("score").alias("perplexity"), ppl("base_score").alias("base_perplexity"))
