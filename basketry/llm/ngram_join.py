"""Exact Jaccard self-join on word shingles through a token-group matrix.

Documents link when ``100 * |x & y| >= percent * |x | y|`` for their sets of
word shingles; the result is each document's component of links.

* Equal sets are one node, so copies are never compared with one another.
* *Tokens of the matrix.*  A shared shingle says little (a passage found in
  many documents joins them all), so the matrix is kept over coarser tokens:
  a set is dealt by hash over B parts and the content of a part is one token.
  Sets that link differ in at most D = floor((100-percent)/percent * size)
  shingles, hence in at most D parts; with B = D + 1 + spare they agree in at
  least 1 + spare.  Sizes fall into classes so narrow that linked
  sets are in one class or in neighbouring ones; a set deals itself for its
  own class and for the one below.  An empty part is no token unless a set has
  more than ``spare`` of them.
* *Groups.*  Nodes that share a token are put into groups of about
  ``group_size`` similar nodes (smallest shared token, spread once over the
  tokens), fewer if their sets are large (``group_shingles`` together); the
  matrix holds the union of each group's tokens.
* *Bound.*  A node can only link with a member of a group whose union holds at
  least 1 + spare - (its own empty parts) of its tokens of one class.  Only
  those groups are opened: there the node is compared exactly, on whole
  sets, with every member.
* Each opened pair of groups returns a spanning forest of its links, and the
  components are found by star contraction.

No cap anywhere: large groups of near copies are cut into groups, not
dropped, and a pair of groups is a bounded task.

Defined cases: a text without words has an empty set and links with nothing;
a null id takes part in no link and has a null component; rows that share an
id and text are one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C
from basketry.llm.components import connected_components

#: Ids of nodes to be opened are broadcast up to this many rows (16 bytes each), else joined by shuffle.
BROADCAST_ROWS = 1_000_000
COLUMNS_AT_ONCE = 4096


class SizeClasses:
    """Lower bounds, differing shingles D, parts B and spare parts of each size class."""

    def __init__(self, percent: int, largest: int):
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, (low[-1] - 1) * 100 // percent + 1))
        self.low = np.array(low, np.int64)
        high = np.append(self.low[1:], self.low[-1] * 2) - 1
        self.differ = (100 - percent) * high // percent
        self.spare = 2 + self.differ // 25
        self.parts = self.differ + 1 + self.spare

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int):
    """Distinct shingle hashes of texts laid end to end: (row, hash), sorted by both.

    A text of fewer words than a shingle has one, its whole word sequence.
    """
    raw = C.lower_bytes(raw)
    start, end, row = C.word_spans(raw, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = C.span_hash(C.prefix_hash(raw), start, end)
    weights = C.mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(C.BASE)) | np.uint64(1)
    n = max(len(word) - words + 1, 0)
    total = np.zeros(n, np.uint64)
    for j in range(words):
        total += C.mix(word[j:j + n] + weights[j])  * weights[j]
    same = row[:n] == row[words - 1:words - 1 + n]
    rows, grams = [row[:n][same]], [C.mix(total[same])]
    count = np.bincount(row, minlength=len(offsets) - 1)
    begin = np.cumsum(count) - count
    for i in np.flatnonzero((count > 0) & (count < words)):
        w = word[begin[i]:begin[i] + count[i]]
        rows.append(np.array([i]))
        grams.append(C.mix((C.mix(w + weights[:len(w)]) * weights[:len(w)]).sum(keepdims=True) + np.uint64(len(w))))
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new]


def _nodes(row, gram, n):
    """(set size, 64-bit hash of the set) of each of n texts."""
    size = np.bincount(row, minlength=n)
    total = np.zeros(n, np.uint64)
    if len(row):
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        total[row[starts]] = np.add.reduceat(C.mix(gram + np.uint64(C.BASE)), starts)
    return size, C.mix(total + C.mix(size.astype(np.uint64) + np.uint64(1)))


def _doc_rows(batches, words):
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        sizes, nodes = [], []
        for i, j in C.blocks(offsets):
            row, gram = shingle_sets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
            size, node = _nodes(row, gram, j - i)
            sizes.append(size)
            nodes.append(node)
        size = np.concatenate(sizes or [np.zeros(0, np.int64)])
        node = np.concatenate(nodes or [np.zeros(0, np.uint64)])
        empty = (size == 0) | batch.column("doc").is_null().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(size, pa.int64()), pa.array(C.signed(node), mask=empty)],
            names=["doc", "n_shingles", "node"])


def _token_rows(batches, words, percent):
    """Matrix tokens (token, node, class and needed overlap) of each batch's distinct nodes."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        seen = np.zeros(0, np.uint64)
        for i, j in C.blocks(offsets):
            row, gram = shingle_sets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
            size, node = _nodes(row, gram, j - i)
            first = np.zeros(j - i, bool)
            first[np.unique(node, return_index=True)[1]] = True
            first &= (size > 0) & ~np.isin(node, seen)
            seen = np.concatenate([seen, node[first]])
            keep = first[row]
            out = _tokens(row[keep], gram[keep], size, node, percent)
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(C.signed(out[0])), pa.array(C.signed(out[1])), pa.array(out[2])],
                                                 names=["token", "node", "tag"])


def _tokens(row, gram, size, node, percent):
    classes = SizeClasses(percent, int(size.max(initial=1)))
    tokens, nodes, tags = [], [], []
    for below in (0, 1):
        cls = classes.of(np.maximum(size, 1)) - below
        dealt = (cls >= 0) & (classes.differ[np.maximum(cls, 0)] > 0)   # without room to differ, linked sets are equal
        keep = dealt[row]
        r, g = row[keep], gram[keep]
        if not len(r):
            continue
        part = ((g >> np.uint64(32)) * classes.parts[cls[r]].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        content = np.add.reduceat(C.mix(g ^ np.uint64(C.BASE)), starts)
        r, part = r[starts], part[starts]
        empty = classes.parts[np.maximum(cls, 0)] - np.bincount(r, minlength=len(size))
        need = np.maximum(1, 1 + classes.spare[np.maximum(cls, 0)] - empty)
        place = C.mix((cls[r].astype(np.uint64) << np.uint64(32)) | part.astype(np.uint64))
        tokens.append(C.mix(content + place))
        nodes.append(node[r])
        tags.append(cls[r] << 20 | need[r])
        for i in np.flatnonzero(dealt & (np.bincount(r, minlength=len(size)) > 0) & (empty > classes.spare[np.maximum(cls, 0)])):
            void = np.setdiff1d(np.arange(classes.parts[cls[i]]), part[r == i])
            tokens.append(C.mix(C.mix((np.uint64(cls[i]) << np.uint64(32)) | void.astype(np.uint64))))
            nodes.append(np.full(len(void), node[i]))
            tags.append(np.full(len(void), cls[i] << 20 | need[i]))
    if not tokens:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(tokens), np.concatenate(nodes), np.concatenate(tags).astype(np.int64)


def _shared(batches):
    """Of rows sorted by (token, node): those whose token two nodes have, each once.

    Only the last row is held from one batch to the next, so a token's rows may be many."""
    held, before = None, False        # the last row, and whether the row before it has its token
    for batch in batches:
        token, node, tag = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "node", "tag"))
        if held is not None:
            token, node, tag = (np.concatenate([[h], x]) for h, x in zip(held, (token, node, tag), strict=True))
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node, tag = token[new], node[new], tag[new]
        same = token[1:] == token[:-1]
        keep = np.zeros(len(token), bool)
        keep[1:] = same
        keep[:-1] |= same
        keep[0] |= before
        held, before = (token[-1], node[-1], tag[-1]), bool(keep[-1])
        yield _token_batch(token[:-1][keep[:-1]], node[:-1][keep[:-1]], tag[:-1][keep[:-1]])
    if before:
        yield _token_batch(*(np.array([x]) for x in held))


def _token_batch(token, node, tag):
    return pa.RecordBatch.from_arrays([pa.array(token), pa.array(node), pa.array(tag)], names=["token", "node", "tag"])


def _set_rows(batches, words):
    """(node, set as bytes) of the documents asked for."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        wanted = batch.column("wanted").to_numpy(zero_copy_only=False).view(np.uint64)
        for i, j in C.blocks(offsets):
            row, gram = shingle_sets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
            _, node = _nodes(row, gram, j - i)
            edge = np.searchsorted(row, np.arange(j - i + 1))
            ok = np.flatnonzero(node == wanted[i:j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(C.signed(node[ok])), pa.array([gram[edge[r]:edge[r + 1]].tobytes() for r in ok], pa.binary())],
                names=["node", "grams"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by blocked matrix products."""
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)))
    width = int((count > 1).sum())
    for lo in range(0, width, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS_AT_ONCE])
        hit = np.zeros((len(sets), min(COLUMNS_AT_ONCE, width - lo)), np.float32)
        hit[owner[a:b], column[a:b] - lo] = 1
        out += hit[:len(left)] @ hit[len(left):].T
    return out


def _open_groups(key, rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Exact comparison inside one opened pair of groups; a spanning forest of the links."""
    rows = rows.drop_duplicates(["node", "side"])
    asked, members = rows[rows.side == 0], rows[rows.side == 1]
    left = [np.frombuffer(g, np.uint64) for g in asked.grams]
    right = [np.frombuffer(g, np.uint64) for g in members.grams]
    edges = []
    if left and right:
        shared = overlaps(left, right)
        union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - shared
        a, b = np.nonzero(100 * shared >= percent * union)
        parent: dict[int, int] = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(asked.node.to_numpy()[a].tolist(), members.node.to_numpy()[b].tolist(), strict=True):
            p, q = root(x), root(y)
            if p != q:
                parent[q] = p
                edges.append((x, y))
    if len(rows) > 1000:
        C.trim()
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                          percent: int = 85, group_size: int = 768, group_shingles: int = 400_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    table = C.checkpointed(source.mapInArrow(lambda it: C.trimmed(_doc_rows(it, words)), "doc long, n_shingles long, node long"))
    nodes = table.filter("node is not null").groupBy("node").agg(F.min("doc").alias("doc"), F.max("n_shingles").alias("size"))

    tokens = source.filter("doc is not null").mapInArrow(lambda it: C.trimmed(_token_rows(it, words, percent)), "token long, node long, tag long")
    shared = C.checkpointed(tokens.repartition("token").sortWithinPartitions("token", "node")
                            .mapInArrow(lambda it: C.trimmed(_shared(it)), "token long, node long, tag long"))
    C.release(docs.sparkSession)

    # groups: smallest shared token, spread once over the tokens, cut to the group size
    own = shared.groupBy("node").agg(F.min("token").alias("least"))
    spread = shared.join(own, "node").groupBy("token").agg(F.min("least").alias("least"))
    near = C.checkpointed(shared.join(spread, "token").groupBy("node").agg(F.min("least").alias("least")))
    sized = near.join(nodes.select("node", "size"), "node")
    cuts = sized.groupBy("least").agg(F.ceil(F.greatest(F.count("*") / group_size, F.sum("size") / group_shingles)).alias("cuts"))
    # only families larger than a group are cut, so few rows tell how; the rest are one group each
    cuts = C.join_side(cuts.filter("cuts > 1"))
    grouped = C.checkpointed(near.join(cuts, "least", "left").select(
        "node", F.xxhash64("least", F.pmod(F.xxhash64("node"), F.coalesce("cuts", F.lit(1)))).alias("grp")))

    # the matrix, and the groups each node has to open (only upwards: a pair is opened once)
    held = shared.join(grouped, "node")
    matrix = held.select("token", F.col("grp").alias("of")).distinct()
    opened = (held.join(matrix, "token").filter("of > grp").groupBy("grp", "of", "node", "tag").agg(F.count("*").alias("n"))
              .filter("n >= (tag & 1048575)").select("grp", "of", "node").distinct())
    alone = grouped.groupBy("grp").agg(F.count("*").alias("n")).filter("n > 1").select("grp")
    opened = C.checkpointed(opened.unionAll(grouped.join(alone, "grp").select("grp", F.col("grp").alias("of"), "node")))

    wanted = C.join_side(grouped.select("node").join(nodes, "node").select("doc", F.col("node").alias("wanted")), BROADCAST_ROWS)
    sets = C.checkpointed(source.join(wanted, "doc").select("text", "wanted")
                          .mapInArrow(lambda it: C.trimmed(_set_rows(it, words)), "node long, grams binary").dropDuplicates(["node"]))

    pairs = opened.select("grp", "of").distinct()
    members = pairs.join(grouped.withColumnRenamed("grp", "of"), "of").select("grp", "of", "node", F.lit(1).alias("side"))
    sides = opened.select("grp", "of", "node", F.lit(0).alias("side")).unionAll(members).join(sets, "node")
    links = sides.groupBy("grp", "of").applyInPandas(lambda key, rows: _open_groups(key, rows, percent), "a long, b long")

    first = nodes.select("node", F.col("doc").alias("to"))
    edges = (links.join(first, links.a == first.node).select(F.col("to").alias("x"), "b")
             .join(first, F.col("b") == first.node).select(F.col("x").alias("a"), F.col("to").alias("b")))
    found = connected_components(edges).withColumnRenamed("node", "doc")
    root = nodes.join(found, "doc", "left").select("node", F.coalesce("component", "doc").alias("component"))
    return table.join(root, "node", "left").select(
        F.col("doc").alias("doc_id"), "n_shingles", F.coalesce("component", "doc").alias("component_id"))


def _told_apart(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``__own``, a number that tells documents apart where ids do not.

    It is the id, unless that is null or has several texts: then a number from id and text (2**62
    and more, so they come last in ties).  Of rows with equal numbers only one stays.
    """
    own, tag = F.col(id_col).cast("long"), F.xxhash64(text_col)
    texts = docs.select(own.alias("__id"), tag.alias("__tag")).groupBy("__id", "__tag").agg(F.count("*").alias("n"))
    odd = C.join_side(texts.groupBy("__id").agg(F.count("*").alias("__texts"), F.max("n").alias("n"))
                      .filter("__texts > 1 or n > 1 or __id is null").select("__id", "__texts"))
    same = own.eqNullSafe(F.col("__id"))
    number = F.xxhash64(id_col, text_col).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    even = docs.join(odd, same, "left_anti").withColumn("__own", own)
    rest = docs.join(odd, same).withColumn("__own", F.when((F.col("__texts") > 1) | F.col("__id").isNull(), number).otherwise(own))
    return even.unionByName(rest.drop("__id", "__texts").dropDuplicates(["__own"]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row (all columns) of each component: that of the smallest id, null ids last.

    Rows that repeat an id with the same text are one document; an id with several texts, and a null
    id, stand for as many documents as they have texts.  Empty texts are linked with nothing: all
    stay but repeats of one row.
    """
    apart = _told_apart(docs, id_col, text_col)
    found = similarity_components(apart, "__own", text_col, **options)
    lost = C.join_side(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("__lost")))
    return apart.join(lost, F.col("__own") == F.col("__lost"), "left_anti").drop("__own")
