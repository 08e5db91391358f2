"""Ranked lexical search: best-first over document intervals bounded by range maxima.

Documents are scored for a query by the sum of integer impacts of its terms
(a BM25 form, see ``impacts``).  The search is exact:

* *Shards.*  One scan finds the query terms in every document.  Each task cuts its
  documents into shards of at most ``SHARD_POSTINGS`` postings (or one document) and
  writes them to a checkpoint, so texts are read once; document frequencies and the two
  corpus totals are sums over the shards.
* *Sparse tables.*  In a shard the posting lists lie behind one another, sorted by term
  and document.  A table for each power of two holds the place of the largest impact of that
  many postings, so the maximum of a list inside any document interval takes two look-ups.
* *Best first.*  The bound of an interval is the sum of its terms' maxima.  The intervals
  with the highest bounds are opened first: the document that holds the largest single
  impact is scored exactly and splits its interval in two.  The search ends when no bound
  reaches the k-th best score, so documents outside the result are never missed.
* *Thresholds.*  Some shards are searched first; their k-th scores let the others skip
  every interval below, which changes no result.  Spark then merges k rows a query and task.

Documents of a shard lie in the order of their commonest query term and length, so
that neighbours have similar impacts and bounds are tight.

Queries are handled in blocks of bounded size, each one scan; a block's terms are broadcast.

Defined cases: a null or empty text has no terms and is never found; a query without
terms, or whose terms no document holds, has no rows; repeated rows of documents take
a rank each, repeated queries are answered each; equal scores rank by ascending id,
a null id last; columns beside id and text are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Postings of a shard; its sparse tables take about 70 bytes each.
SHARD_POSTINGS = 500_000
#: Bytes of query text answered in one scan of the documents.
QUERY_BYTES = 8 << 20
#: Intervals opened together, and shards searched before the others to learn thresholds.
OPENED, FIRST_SHARDS = 64, 12
#: Stands for a null id, behind all others.
NO_ID = np.iinfo(np.int64).max

_IN_TERM = np.zeros(256, bool)
_IN_TERM[48:58] = _IN_TERM[65:91] = _IN_TERM[97:123] = _IN_TERM[128:] = True


def query_terms(text: str | None) -> list[bytes]:
    """The terms of a text with repeats, only A-Z lower-cased."""
    return TERM.findall((text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))


class Queries:
    """A block of queries: their distinct terms (by hash, with their bytes) and each query's terms and repeats."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        found = [(number, query_terms(text)) for number, text in rows]
        words = sorted({w for _, terms in found for w in terms})
        raw = np.frombuffer(b"".join(words), np.uint8)
        edge = np.cumsum([0] + [len(w) for w in words])
        hashes = C.span_hash(C.prefix_hash(raw), edge[:-1], edge[1:])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.words = hashes[order], [words[k] for k in order]
        self.raw = np.frombuffer(b"".join(self.words), np.uint8)
        self.edge = np.cumsum([0] + [len(w) for w in self.words])
        number_of = {w: k for k, w in enumerate(self.words)}
        self.queries = []
        for number, terms in found:
            term, times = np.unique(np.array([number_of[w] for w in terms], np.int64), return_counts=True)
            if len(term):
                self.queries.append((number, term, times))

    def places(self, raw, start, end):
        """Number of the term at each span, -1 where it is none; equal hashes are compared byte by byte."""
        if not len(self.hashes):
            return np.full(len(start), -1)
        prefix = C.prefix_hash(raw)
        key = C.span_hash(prefix, start, end)
        at = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
        size = end - start
        hit = np.flatnonzero((self.hashes[at] == key) & (np.diff(self.edge)[at] == size))
        # the bytes of all hits, and of the terms they should be
        total = size[hit]
        inside = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
        same = raw[np.repeat(start[hit], total) + inside] == self.raw[np.repeat(self.edge[at[hit]], total) + inside]
        good = np.logical_and.reduceat(same, np.cumsum(total) - total) if len(hit) else np.zeros(0, bool)
        out = np.full(len(start), -1)
        out[hit[good]] = at[hit[good]]
        return out


# ---------------------------------------------------------------- shards

def _compressed(arrays: list[np.ndarray]) -> tuple[bytes, int]:
    data = b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)
    return pa.compress(data, codec="zstd", asbytes=True), len(data)


def _shard(held, n_terms_of_query):
    """One row: document ids, lengths and postings of a run of documents."""
    doc, n, owner, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
    # the order of the documents: commonest query term, length, id
    top = np.zeros(len(doc), np.int64)
    by = np.lexsort((term, tf, owner))
    last = np.flatnonzero(np.append(owner[by][1:] != owner[by][:-1], True)) if len(by) else by
    top[owner[by][last]] = term[by][last]
    order = np.lexsort((doc, n, top))
    place = np.empty(len(doc), np.int64)
    place[order] = np.arange(len(doc))
    owner = place[owner]
    by = np.lexsort((owner, term))
    term, owner, tf = term[by], owner[by], tf[by]
    df = np.bincount(term, minlength=n_terms_of_query)
    data, size = _compressed([doc[order], n[order], term.astype(np.int32), owner.astype(np.int32), tf.astype(np.int64)])
    some = np.flatnonzero(df)
    return len(doc), len(term), data, size, some, df[some]


_SHARD = "docs long, terms long, held long, postings long, data binary, size long, term array<int>, df array<long>"


def _shard_rows(batches, queries):
    held, postings, rows, docs, terms = [], 0, 0, 0, 0

    def flush():
        kept, found, data, size, term, df = _shard(held, len(queries.words))
        return pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in (docs, terms, kept, found)]
            + [pa.array([data], pa.binary()), pa.array([size], pa.int64()), pa.array([term.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int64()))],
            names=[c.split()[0] for c in _SHARD.split(", ")])

    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        ids = batch.column("doc").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        for i, j in C.blocks(offsets):
            part = C.lower_bytes(raw[offsets[i]:offsets[j]])
            start, end, row = C.word_spans(part, offsets[i:j + 1] - offsets[i], _IN_TERM[part])
            n = np.bincount(row, minlength=j - i)
            term = queries.places(part, start, end)
            hit = term >= 0
            pair, tf = np.unique(row[hit] * max(len(queries.words), 1) + term[hit], return_counts=True)
            owner, term = np.divmod(pair, max(len(queries.words), 1))
            if held and postings + len(pair) > SHARD_POSTINGS:
                yield flush()
                held, postings, rows, docs, terms = [], 0, 0, 0, 0
            docs += int((n > 0).sum())
            terms += int(n.sum())
            some, owner = np.unique(owner, return_inverse=True)          # documents without a query term are only counted
            held.append((ids[i:j][some], n[some].astype(np.int64), owner + rows, term, tf))
            postings += len(pair)
            rows += len(some)
    if held:
        yield flush()


# ---------------------------------------------------------------- search

def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impacts(weight, tf, n, n_docs: int, n_terms: int) -> np.ndarray:
    """weight * ((10^9 tf) div (1000 tf + 8m)), m = 25 + (75 n N) div L, in 64-bit integers."""
    if 75 * int(n.max(initial=0)) * n_docs < 1 << 63:
        m = 25 + (75 * n * n_docs) // max(n_terms, 1)
    else:                                   # the product alone may exceed 64 bits
        m = np.array([25 + (75 * int(x) * n_docs) // n_terms for x in n], np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Posting lists of a run of documents with the sparse tables of their impacts."""

    def __init__(self, data: bytes, size: int, held: int, postings: int, weight: np.ndarray, n_docs: int, n_terms: int):
        raw = pa.decompress(data, size, codec="zstd", asbytes=True)
        self.doc = np.frombuffer(raw, np.int64, held)
        n = np.frombuffer(raw, np.int64, held, 8 * held)
        term = np.frombuffer(raw, np.int32, postings, 16 * held).astype(np.int64)
        owner = np.frombuffer(raw, np.int32, postings, 16 * held + 4 * postings).astype(np.int64)
        tf = np.frombuffer(raw, np.int64, postings, 16 * held + 8 * postings)
        self.held = max(held, 1)
        self.key = term * self.held + owner
        self.impact = impacts(weight[term], tf, n[owner], n_docs, n_terms)
        self.owner = owner
        longest = int(np.bincount(term).max(initial=1))
        levels = longest.bit_length()
        self.best = np.tile(np.arange(postings, dtype=np.int32), (levels, 1))
        for k in range(1, levels):
            half = 1 << (k - 1)
            near, far = self.best[k - 1, :postings - half], self.best[k - 1, half:]
            self.best[k, :postings - half] = np.where(self.impact[near] >= self.impact[far], near, far)

    def bounds(self, term, times, lo, hi):
        """(bound, splitting document) of document intervals [lo, hi): sums of their terms' range maxima."""
        base = term * self.held
        a = np.searchsorted(self.key, base + lo[:, None])
        b = np.searchsorted(self.key, base + hi[:, None])
        some = b > a
        size = np.maximum(b - a, 1)
        k = np.frexp(size.astype(np.float64))[1] - 1
        a, b = np.where(some, a, 0), np.where(some, b - (1 << k), 0)
        near, far = self.best[k, a], self.best[k, b]
        place = np.where(self.impact[near] >= self.impact[far], near, far)
        value = np.where(some, self.impact[place] * times, 0)
        top = np.argmax(value, axis=1)
        return value.sum(1), self.owner[place[np.arange(len(lo)), top]]

    def scores(self, term, times, places):
        key = term * self.held + places[:, None]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.impact[at] * times, 0).sum(1)

    def search(self, term, times, k: int, least: int = 1) -> list[tuple[int, int]]:
        """The k best (score, place), ties by id, among the documents scored ``least`` or more."""
        if not len(self.key):
            return []
        first = np.searchsorted(self.key, term * self.held)
        present = np.searchsorted(self.key, (term + 1) * self.held) > first
        term, times = term[present], times[present]
        if not len(term):
            return []
        bound, split = self.bounds(term, times, np.array([0]), np.array([self.held]))
        heap = [(-int(bound[0]), 0, self.held, int(split[0]))]
        found: list[tuple[int, int, int]] = []          # (score, -id, place): the worst one first
        opened = 4
        while heap and -heap[0][0] >= least:
            taken = []
            while heap and len(taken) < opened and -heap[0][0] >= least:
                taken.append(heapq.heappop(heap))
            opened = min(opened * 2, OPENED)
            _, lo, hi, mid = (np.array(x, np.int64) for x in zip(*taken, strict=True))
            for score, place in zip(self.scores(term, times, mid).tolist(), mid.tolist(), strict=True):
                if score >= least:
                    entry = (score, -int(self.doc[place]), place)
                    if len(found) < k:
                        heapq.heappush(found, entry)
                    else:
                        heapq.heappushpop(found, entry)
            if len(found) == k:
                least = max(least, found[0][0])
            lo, hi = np.concatenate([lo, mid + 1]), np.concatenate([mid, hi])
            some = lo < hi
            lo, hi = lo[some], hi[some]
            if len(lo):
                bound, split = self.bounds(term, times, lo, hi)
                good = np.flatnonzero(bound >= least)
                for x in zip((-bound[good]).tolist(), lo[good].tolist(), hi[good].tolist(), split[good].tolist(), strict=True):
                    heapq.heappush(heap, x)
        return [(score, place) for score, _, place in found]


_FOUND = "query int, doc long, score long"


def _search_rows(batches, queries, weight, n_docs, n_terms, k, least):
    """At most k rows a query and task: its shards' results, each searched above what the ones before gave."""
    kept: dict[int, list[tuple[int, int]]] = {}
    for batch in batches:
        for r in range(batch.num_rows):
            held, postings, data, size = (batch.column(c)[r].as_py() for c in ("held", "postings", "data", "size"))
            shard = Shard(data, size, held, postings, weight, n_docs, n_terms)
            for number, term, times in queries.queries:
                best = kept.setdefault(number, [])
                floor = best[-1][0] if len(best) == k else 1
                more = shard.search(term, times, k, max(1, floor, least.get(number, 1)))
                best.extend((s, int(shard.doc[p])) for s, p in more)
                best.sort(key=lambda x: (-x[0], x[1]))
                del best[k:]
    rows = [(number, doc, score) for number, best in kept.items() for score, doc in best]
    number, doc, score = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
    yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(doc, mask=doc == NO_ID), pa.array(score)], names=["query", "doc", "score"])


def _answered(docs: DataFrame, rows: list[tuple[int, str | None]], k: int) -> DataFrame:
    """query, rank, doc, score of one block of queries."""
    spark = docs.sparkSession
    queries = Queries(rows)
    shared = spark.sparkContext.broadcast(queries)
    shards = C.checkpointed(docs.mapInArrow(lambda it: C.trimmed(_shard_rows(it, shared.value)), _SHARD))
    total = shards.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("terms"), F.lit(0)).alias("t")).first()
    n_docs, n_terms = int(total.d), int(total.t)
    df = np.zeros(len(queries.words), np.int64)
    by_term = shards.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df"))
    for r in by_term.collect():                        # a row for each term of this block's queries at most
        df[r.term] = r.df
    weight = weights(n_docs, df)

    def found(part: DataFrame, least: dict[int, int]) -> DataFrame:
        rows = part.select("held", "postings", "data", "size").mapInArrow(
            lambda it: C.trimmed(_search_rows(it, shared.value, weight, n_docs, n_terms, k, least)), _FOUND)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = shards.limit(FIRST_SHARDS).repartition(FIRST_SHARDS)
    least = {r["query"]: r.score for r in found(first, {}).filter(F.col("rank") == k).collect()}     # a row for each query at most
    return found(shards, least).select("query", "rank", "doc", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item, rank (from 1), doc, score of the ``k`` best documents above 0 for each row of ``items``."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    asked = C.checkpointed(items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
                           .withColumn("query", F.monotonically_increasing_id()))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // QUERY_BYTES))
    out = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        rows = part.select("query", "item", "text").collect()            # about QUERY_BYTES of text
        names = docs.sparkSession.createDataFrame([(n, r["query"]) for n, r in enumerate(rows)], "query int, row long")
        answers = (_answered(source, [(n, r.text) for n, r in enumerate(rows)], k).join(F.broadcast(names), "query")
                   .join(part.select(F.col("query").alias("row"), "item"), "row").select("item", "rank", "doc", "score"))
        out = answers if out is None else out.unionByName(answers)
    return out
