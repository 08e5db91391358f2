"""Removal of repeated byte strings by hashing at sampled positions.

A byte goes if a string of ``threshold`` (50) bytes that covers it also starts
in a document with a smaller id.  A suffix array over all bytes would sort
several hundred bytes per input byte.  Here, in place of the prefix doubling, two
fixed sorts run over sampled positions, and a position drops out as soon as its rank is unique
or the threshold is passed:

* *Positions.*  Every window of ``threshold`` bytes picks the smallest hash
  among its ``k``-byte strings (its minimizer).  Equal windows pick equal
  positions, so only picked positions need a rank: about 2/(threshold-k+2)
  of all bytes.  The windows which pick one position form a segment.
* *Rank at length k, then at segment length.*  Spark sorts rows (rank of the
  k bytes, rank of the whole segment, document).  A k-rank held by one
  document only is unique: its windows cannot repeat and drop out.  A segment
  whose rank a smaller document shares is past the threshold: all its windows
  go.
* *Rank at the threshold.*  Where a k-rank continues in different ways (the
  edges of a repeated passage), the smallest document of each segment sends
  one row (rank of the window, document) per window; sorting those
  settles every window left.

Ranks are 64-bit hashes of the bytes, so no global renumbering is needed.
Hot ranks: within a block of documents only the smallest holder of a rank is
sent to be sorted; the others are known to repeat and travel under a key of
their own.  A k-rank that continues differently inside one block sends a single
marker; its segments are spread by the segment's rank.  So a rank is sent at
most once per block whatever its share of the rows.

Defined cases: null and short texts lose nothing; a null id neither removes
nor loses bytes; rows which share id and text get the same result each; rows
which share an id but not the text count as one document for "smaller id" and
are kept apart by a number (65,535 different texts of one id at most, else an error).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

#: Bytes handled at once; a longer text is cut into overlapping pieces.
PIECE = 1 << 20
FULL, SPREAD, SORTED = 1, 2, 0
_POS_SHIFT = 30   # position | window count (12 bits) | flag (2 bits) | text tag (16 bits)
_MOST = 4095      # windows one row can name; longer runs take several rows


def _slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n, step, out = len(values) - width + 1, 1, values
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    if step < width:
        out = np.minimum(out[:n], out[width - step:width - step + n])
    return out[:n]


def _segments(raw, bounds, k, threshold):
    """Segments of texts laid end to end (all shorter than 2**24 bytes together).

    Returns (row, first window, windows, k-rank, segment rank); windows never
    cross a text's end.
    """
    prefix = C.prefix_hash(raw)
    n = len(raw)
    at = np.arange(n - k + 1)
    grams = C.span_hash(prefix, at, at + k)
    low = np.uint64((1 << 24) - 1)
    picked = _slide_min((grams & ~low) | at.astype(np.uint64), threshold - k + 1)
    anchor = (picked & low).astype(np.int64)
    row = np.searchsorted(bounds, np.arange(len(anchor)), side="right") - 1
    whole = np.arange(len(anchor)) + threshold <= bounds[row + 1]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    good = whole[first]
    first, last = first[good], last[good]
    pick = anchor[first]
    shape = ((pick - first).astype(np.uint64) << np.uint64(8)) | (last - first).astype(np.uint64)
    rank = C.mix(C.span_hash(prefix, first, last + threshold) + C.mix(shape))
    return row[first], first, last - first + 1, grams[pick], rank


def _pieces(offsets, threshold):
    """Cut long texts: arrays (row, base, start, end) of pieces that overlap by threshold - 1."""
    size = np.diff(offsets)
    if not len(size) or size.max() <= PIECE:
        row = np.arange(len(size))
        return row, np.zeros(len(size), np.int64), offsets[:-1], offsets[1:]
    rows, bases = [], []
    for i, s in enumerate(size):
        b = np.arange(0, max(int(s), 1), PIECE)
        rows.append(np.full(len(b), i))
        bases.append(b)
    row, base = np.concatenate(rows), np.concatenate(bases)
    start = offsets[row] + base
    return row, base, start, np.minimum(start + PIECE + threshold - 1, offsets[row + 1])


def _told_apart(source: DataFrame) -> DataFrame:
    """``source`` with ``tag``: 0, or the number of a text among the different texts of an id that has several."""
    own = F.xxhash64("text")
    texts = source.filter("doc is not null").select("doc", own.alias("own")).distinct()
    several = C.checkpointed(texts.join(texts.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1").select("doc"), "doc"))
    if several.isEmpty():
        return source.withColumn("tag", F.lit(0).cast("long"))
    numbered = several.withColumn("tag", F.row_number().over(Window.partitionBy("doc").orderBy("own")).cast("long"))
    if numbered.agg(F.max("tag")).first()[0] > 0xFFFF:
        raise ValueError("an id stands for more than 65,535 different texts")
    return source.withColumn("own", own).join(numbered, ["doc", "own"], "left").select("doc", "text", F.coalesce("tag", F.lit(0)).alias("tag"))


_RANKS = pa.schema([("key", pa.int64()), ("seg", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])


def _rank_rows(batches, k, threshold):
    """Rows (key, segment rank, document, packed place) of every picked position."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        docs = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
        tags = batch.column("tag").to_numpy(zero_copy_only=False)
        prow, pbase, pstart, pend = _pieces(offsets, threshold)
        long_enough = pend - pstart >= threshold
        prow, pbase, pstart, pend = (x[long_enough] for x in (prow, pbase, pstart, pend))
        parts = []
        edge = np.concatenate([[0], np.cumsum(pend - pstart)])
        for i, j in C.blocks(edge, PIECE):
            chunk = np.concatenate([raw[a:b] for a, b in zip(pstart[i:j], pend[i:j], strict=True)])
            bounds = edge[i:j + 1] - edge[i]
            row, first, count, gram, rank = _segments(chunk, bounds, k, threshold)
            place = first - bounds[row] + pbase[i + row]
            parts.append((gram, rank, docs[prow[i + row]], place, count, tags[prow[i + row]]))
            if sum(len(p[0]) for p in parts) > 1_000_000:
                yield _combine(parts)
                parts = []
        if parts:
            yield _combine(parts)


def _combine(parts):
    """Inside a block of documents send each rank once (see the module's note on hot ranks)."""
    gram, rank, doc, place, count, tag = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((doc, rank, gram))
    gram, rank, doc, place, count, tag = (x[order] for x in (gram, rank, doc, place, count, tag))
    new_gram = np.ones(len(gram), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new_rank = new_gram.copy()
    new_rank[1:] |= rank[1:] != rank[:-1]
    group = np.cumsum(new_rank) - 1
    later = doc > doc[np.flatnonzero(new_rank)][group]
    several = np.bincount(np.cumsum(new_gram) - 1, weights=new_rank)[np.cumsum(new_gram) - 1] > 1
    flag = np.full(len(gram), SORTED)
    flag[several] = SPREAD
    flag[later] = FULL
    key = gram.copy()
    spread = several & ~new_gram
    key[spread] = C.mix(gram[spread] ^ rank[spread])
    key[later] = C.mix((doc[later].astype(np.uint64) << np.uint64(32)) + place[later].astype(np.uint64))
    packed = (place << _POS_SHIFT) | (count << 18) | (flag << 16) | tag
    # 48 bits of each rank tell segments apart; the zeros stand next to bytes that compress, so a row shrinks by them
    short = [pa.array(C.signed(key & ~np.uint64(0xFFFF))), pa.array(C.signed(rank >> np.uint64(16)))]
    return pa.record_batch([*short, pa.array(doc), pa.array(packed)], schema=_RANKS)


def _runs(batches, columns):
    """Sorted batches again, cut so that a key never spans two of them.

    Carried rows are those of one key; every block of documents sends a key at
    most once, so a run has far fewer rows than there are documents.
    """
    held: list[list[np.ndarray]] = []
    for batch in batches:
        arrays = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if not len(arrays[0]):
            continue
        first, last = arrays[0][0], arrays[0][-1]
        if held and held[0][0][0] != first:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held = []
        if first == last:
            held.append(arrays)
            continue
        cut = int(np.searchsorted(arrays[0], last, side="left"))
        held.append([a[:cut] for a in arrays])
        yield [np.concatenate(x) for x in zip(*held, strict=True)]
        held = [[a[cut:] for a in arrays]]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


_PLACES = pa.schema([("doc", pa.int64()), ("at", pa.int64())])


def _judge_segments(batches):
    """Of rows sorted by (key, segment rank, document): the repeated and the open segments."""
    for key, seg, doc, at in _runs(batches, ("key", "seg", "doc", "at")):
        flag = (at >> 16) & 3
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_seg = new_key.copy()
        new_seg[1:] |= seg[1:] != seg[:-1]
        group = np.cumsum(new_seg) - 1
        later = (doc > doc[np.flatnonzero(new_seg)][group]) | (flag == FULL)
        of_key = np.cumsum(new_key) - 1
        starts = np.flatnonzero(new_key)
        segs = np.bincount(of_key, weights=new_seg)[of_key] > 1
        docs = (np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts))[of_key]
        marked = np.maximum.reduceat((flag == SPREAD).astype(np.int8), starts)[of_key] > 0
        opened = ~later & (marked | (segs & docs))
        keep = later | opened
        out = (at[keep] & ~np.int64(3 << 16)) | (np.where(later[keep], FULL, SORTED) << 16)
        yield pa.record_batch([pa.array(doc[keep]), pa.array(out)], schema=_PLACES)


_WINDOWS = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])


def _window_rows(batches, threshold):
    """Rows (window rank, document, place) of the windows of open segments."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        docs = batch.column("doc").to_numpy(zero_copy_only=False)
        places = batch.column("places")
        tags = batch.column("tag").to_numpy(zero_copy_only=False)
        base = places.offsets.to_numpy()
        flat = places.flatten().to_numpy(zero_copy_only=False)
        base = base - base[0]
        for i in range(len(docs)):
            at = flat[base[i]:base[i + 1]]
            at = at[(at & 0xFFFF) == tags[i]]
            if not len(at):
                continue
            text = raw[offsets[i]:offsets[i + 1]]
            count = (at >> 18) & _MOST
            start = at >> _POS_SHIFT
            first = np.repeat(start, count)
            window = first + np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
            key = np.empty(len(window), np.uint64)
            for lo in range(0, len(text), PIECE):
                here = (window >= lo) & (window < lo + PIECE)
                if here.any():
                    prefix = C.prefix_hash(text[lo:lo + PIECE + threshold])
                    key[here] = C.span_hash(prefix, window[here] - lo, window[here] - lo + threshold)
            # the same window twice in one text: one row is enough to be compared with others
            flag = np.full(len(window), SORTED)
            packed = (window << _POS_SHIFT) | (1 << 18) | (flag << 16) | tags[i]
            yield pa.record_batch([pa.array(C.signed(key)), pa.array(np.full(len(key), docs[i], np.int64)), pa.array(packed)], schema=_WINDOWS)


def _combine_windows(batches):
    """Send the windows of a block with known repeats under keys of their own."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > 1_000_000:
            yield _mark(held)
            held, rows = [], 0
    if held:
        yield _mark(held)


def _mark(held):
    key, doc, at = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("key", "doc", "at"))
    order = np.lexsort((doc, key))
    key, doc, at = key[order], doc[order], at[order].copy()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    later = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    # known repeats: neighbouring windows of a text become one row
    known_doc, known_at = _merged(doc[later], at[later])
    known_at |= FULL << 16
    known_key = C.signed(C.mix(known_doc.astype(np.uint64) * np.uint64(C.BASE) + known_at.astype(np.uint64)))
    return pa.record_batch([pa.array(np.concatenate(x)) for x in ((key[~later], known_key), (doc[~later], known_doc), (at[~later], known_at))],
                           schema=_WINDOWS)


def _merged(doc, at):
    """Single windows (one per row) as runs of up to _MOST windows."""
    order = np.lexsort((at, at & 0xFFFF, doc))
    doc, at = doc[order], at[order]
    if not len(doc):
        return doc, at
    place, tag = at >> _POS_SHIFT, at & 0xFFFF
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (place[1:] > place[:-1] + 1)
    run = np.flatnonzero(new)[np.cumsum(new) - 1]
    new |= (np.arange(len(doc)) - run) % _MOST == 0
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], (place[first] << _POS_SHIFT) | ((place[last] - place[first] + 1) << 18) | tag[first]


def _judge_windows(batches):
    for key, doc, at in _runs(batches, ("key", "doc", "at")):
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        keep = (doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]) | (((at >> 16) & 3) == FULL)
        yield pa.record_batch([pa.array(doc[keep]), pa.array(at[keep])], schema=_PLACES)


def _kept(batches, threshold, with_text):
    """Apply the removed places: counts, spans and the remaining bytes."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        places = batch.column("places")
        tags = batch.column("tag").to_numpy(zero_copy_only=False)
        n_removed, n_spans, shas, kept = [], [], [], []
        for i, row in enumerate(places):
            text = raw[offsets[i]:offsets[i + 1]]
            at = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.zeros(0, np.int64)
            at = at[(at & 0xFFFF) == tags[i]]
            change = np.zeros(len(text) + 1, np.int32)
            if len(at):
                start = at >> _POS_SHIFT
                np.add.at(change, start, 1)
                np.add.at(change, start + ((at >> 18) & _MOST) - 1 + threshold, -1)
            gone = np.cumsum(change)[:-1] > 0
            left = text[~gone].tobytes() if len(at) else text.tobytes()
            n_removed.append(int(gone.sum()))
            n_spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
            shas.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        out = [batch.column("doc"), pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(shas, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            out.append(pa.array(kept, pa.binary()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(out, names=names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: int = 50, k: int = 24, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    ``with_text`` adds ``kept``, the remaining bytes (binary: a cut may fall
    inside a character).  ``k`` < ``threshold`` trades rows against needless
    comparisons; the result does not depend on it.
    """
    spark = docs.sparkSession
    source = _told_apart(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")))
    known = source.filter("doc is not null and octet_length(text) >= %d" % threshold)

    ranks = known.mapInArrow(lambda it: _rank_rows(it, k, threshold), "key long, seg long, doc long, at long")
    judged = (ranks.repartition("key").sortWithinPartitions("key", "seg", "doc")
              .mapInArrow(_judge_segments, "doc long, at long"))
    judged = C.checkpointed(judged)
    C.release(spark)

    is_open = F.expr("(at >> 16) & 3").eqNullSafe(SORTED)
    opened = judged.filter(is_open).groupBy("doc").agg(F.collect_list("at").alias("places"))
    windows = (known.join(opened, "doc").select("doc", "text", "tag", "places")
               .mapInArrow(lambda it: _combine_windows(_window_rows(it, threshold)), "key long, doc long, at long"))
    settled = (windows.repartition("key").sortWithinPartitions("key", "doc")
               .mapInArrow(_judge_windows, "doc long, at long"))
    settled = C.checkpointed(settled)
    C.release(spark)

    gone = judged.filter(~is_open).unionAll(settled).groupBy("doc").agg(F.collect_list("at").alias("places"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return (source.join(gone, "doc", "left").select("doc", "text", "tag", "places")
            .mapInArrow(lambda it: _kept(it, threshold, with_text), schema))


# ---------------------------------------------------------------- the dealt method, as it is

_FIRST = 8          # bytes compared as one number


def _position_rows(batches):
    """(doc, tag, at, r): every position with its first eight bytes as a number."""
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        docs, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            for lo in range(int(a), int(b) - _FIRST + 1, PIECE):
                n = min(PIECE, int(b) - _FIRST + 1 - lo)
                r = np.lib.stride_tricks.sliding_window_view(raw[lo:lo + n + _FIRST - 1], _FIRST).copy().view(np.int64)[:, 0]
                at = np.arange(lo - a, lo - a + n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, x, np.int64)) for x in (docs[i], tags[i])] + [pa.array(at), pa.array(r)],
                                                 names=["doc", "tag", "at", "r"])


def remove_repeats_by_doubling(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                               threshold: int = 50, with_text: bool = False) -> DataFrame:
    """``remove_repeats`` by distributed prefix doubling over all positions: same rows, at many times the disk.

    A position's rank at 2h bytes is the first position with the same pair (rank at i, rank at i + h); pairs
    that occur once drop out, so partners of dropped positions drop too.  h doubles from 8 bytes and the
    last step ends at ``threshold``.  Ranks are positions, so nothing depends on a hash.
    """
    source = _told_apart(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")))
    known = source.filter("doc is not null and octet_length(text) >= %d" % threshold).dropDuplicates(["doc", "tag"])
    ranked = known.mapInArrow(_position_rows, "doc long, tag long, at long, r long")
    length = _FIRST
    while length < threshold:
        h = min(length, threshold - length)
        partner = ranked.select("doc", "tag", (F.col("at") - h).alias("at"), F.col("r").alias("s"))
        pairs = ranked.join(partner, ["doc", "tag", "at"])
        first = pairs.groupBy("r", "s").agg(F.min(F.struct("doc", "tag", "at")).alias("f"), F.count("*").alias("n")).filter("n > 1")
        ranked = C.checkpointed(pairs.join(first.select("r", "s", "f"), ["r", "s"]).select("doc", "tag", "at", F.col("f").alias("r")))
        C.release(docs.sparkSession)
        length += h
    packed = F.shiftleft("at", _POS_SHIFT).bitwiseOR(F.lit((1 << 18) | (FULL << 16))).bitwiseOR(F.col("tag"))
    gone = ranked.filter("doc > r.doc").select("doc", packed.alias("at")).groupBy("doc").agg(F.collect_list("at").alias("places"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return (source.join(gone, "doc", "left").select("doc", "text", "tag", "places")
            .mapInArrow(lambda it: _kept(it, threshold, with_text), schema))
