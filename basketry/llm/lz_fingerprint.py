"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the
shortest string, from where the last one ended, that is not yet in the
dictionary (so the longest known phrase and one more byte).  The set of
phrases is what a compressor would have learnt of the text; the fingerprint is
the ``size`` smallest hashes of the set, and the likeness of two fingerprints
estimates the Jaccard similarity of the phrase sets (exactly, for small sets).

Every text is also fingerprinted after an edit that needs its neighbour in
descending id order.  For this, rows are dealt to ranges of ids; each range also
receives the first row of the range below it, so neighbours meet in one
task and nothing is sorted globally in one place.  Ranges are cut at quantiles of
the ids; a text is read and shuffled once.

Defined cases: a null or empty text has the empty fingerprint (two of them are
alike, 1.0; an empty and another one are not, 0.0); rows are ordered by id
descending, nulls last, then by text hash, so ties have a fixed order; a
table of one row is its own neighbour.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F




def parse(data: bytes, at: int, known: set[bytes], stop: int) -> tuple[list[bytes], int]:
    """Phrases of ``data`` from ``at`` on that end by ``stop``, and where the last one ends.

    ``known`` is the dictionary and grows.  Every prefix of a phrase is a
    phrase, so two bytes are looked up before one.
    """
    phrases: list[bytes] = []
    add, note, n = known.add, phrases.append, len(data)
    while at < n:
        end = at + 2
        phrase = data[at:end]
        if phrase in known:
            while phrase in known and end < n:
                end += 1
                phrase = data[at:end]
        elif data[at:at + 1] not in known:
            end = at + 1
            phrase = data[at:end]
        if end > n:             # the last phrase may be a known one
            end = n
        if end > stop:
            break
        add(phrase)
        note(phrase)
        at = end
    return phrases, at


def phrase_hashes(phrases: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, phrases), np.uint32, len(phrases))


def smallest(hashes: np.ndarray, size: int) -> np.ndarray:
    """The signature: the ``size`` smallest distinct values after mixing (odd factors: a bijection)."""
    mixed = hashes * np.uint32(0x9E3779B1)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)
    return np.unique(mixed ^ (mixed >> np.uint32(13)))[:size]


def signature(text: str, size: int) -> np.ndarray:
    data = text.encode("utf-8", "surrogatepass")
    return smallest(phrase_hashes(parse(data, 0, set(), len(data))[0]), size)


def likeness(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """Jaccard estimate of two signatures: shared hashes among the smallest of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    left, right = set(a.tolist()), set(b.tolist())
    both = left & right
    least = sorted(left | right)[:size]
    return sum(x in both for x in least) / len(least)


def encode(sig: np.ndarray) -> str:
    return base64.b64encode(sig.astype("<u4").tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of ``following``."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


def _fingerprints(text: str, following: str, size: int):
    """Signature of the text, its edited text as bytes, and that one's signature.

    Both begin alike, so they are parsed once up to the cut: a phrase that ends
    there or before is the same in both."""
    data = text.encode("utf-8", "surrogatepass")
    m = len(text) // 3
    if not m:
        own = signature(text, size)
        return own, data, own
    cut = len(text[:len(text) - m].encode("utf-8", "surrogatepass"))
    changed = data[:cut] + following[:m].encode("utf-8", "surrogatepass")
    known: set[bytes] = set()
    first, at = parse(data, 0, known, cut)
    hashes = phrase_hashes(first)
    both = []
    for whole, seen in ((data, known.copy()), (changed, known)):
        rest, _ = parse(whole, at, seen, len(whole))
        both.append(smallest(np.concatenate([hashes, phrase_hashes(rest)]), size))
    return both[0], changed, both[1]


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _rows(batches, size):
    """Rows sorted by (range, order): each but a range's last is paired with the row after it."""
    held = None            # (range, halo, doc, text)
    out = []

    def result(row, following):
        _, _, doc, text = row
        own, changed, other = _fingerprints(text, following[3], size)
        return doc, text, own, changed, other

    pending = None         # result whose neighbour's signature is still to come
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "halo", "doc", "text")]
        for part, halo, doc, text in zip(*columns, strict=True):
            row = (part, halo, doc, text or "")
            if held is not None and held[0] == part:
                here = result(held, row)
                if pending is not None:
                    out.append(_finish(pending, here[2], size))
                pending = here
            elif pending is not None:      # a new range: the held row was the last, the halo of the range before
                out.append(_finish(pending, signature(held[3], size), size))
                pending = None
            held = row
            if len(out) >= 500:
                yield _batch(out)
                out = []
    if pending is not None:
        out.append(_finish(pending, signature(held[3], size), size))
    if out:
        yield _batch(out)


def _finish(row, following, size):
    doc, text, own, changed, other = row
    return (doc, len(text), hashlib.sha256(changed).hexdigest(), encode(own), encode(other),
            likeness(own, other, size), likeness(own, following, size))


def _batch(rows):
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 96) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = source.agg(F.percentile_approx("doc", [k / parts for k in range(1, parts)], 10 * parts)).first()[0] or []
    splits = [-float("inf"), *sorted({float(c) for c in cuts} or {0.0}), float("inf")]
    # nulls come after all ids, so they are the lowest range
    ranged = Bucketizer(splits=splits, inputCol="at", outputCol="part").transform(
        source.withColumn("at", F.col("doc").cast("double")).na.fill({"at": -1.7e308}))
    order = [F.desc_nulls_last("doc"), F.xxhash64("text")]
    keyed = ranged.select(F.when(F.col("doc").isNull(), F.lit(-1)).otherwise(F.col("part")).cast("int").alias("part"), "doc", "text")
    # the first row of each range, by order; as many rows as there are ranges
    top = keyed.select("part", "doc", F.xxhash64("text").alias("tag")).groupBy("part").agg(
        F.max("doc").alias("doc"), F.min_by("tag", F.struct(-F.coalesce("doc", F.lit(0)), "tag")).alias("tag"), F.count("*").alias("n")).collect()
    if not top:
        return spark.createDataFrame([], _SCHEMA)
    top = sorted(top, key=lambda r: -r.part)
    # the row which follows a range is the first one of the range below; after the last comes the first
    after = [(below.part, below.doc, below.tag, r.part) for r, below in zip(top, top[1:] + top[:1], strict=True)]
    halo = F.broadcast(spark.createDataFrame(after, "part int, doc long, tag long, for_part int"))
    tagged = keyed.withColumn("tag", F.xxhash64("text"))
    extra = (tagged.join(halo, (tagged.part == halo.part) & tagged.doc.eqNullSafe(halo.doc) & (tagged.tag == halo.tag))
             .select(halo.for_part.alias("part"), F.lit(1).alias("halo"), tagged.doc.alias("doc"), "text").dropDuplicates(["part"]))
    rows = keyed.select("part", F.lit(0).alias("halo"), "doc", "text").unionAll(extra)
    return (rows.repartition("part").sortWithinPartitions(F.desc("part"), "halo", *order)
            .mapInArrow(lambda it: _rows(it, size), _SCHEMA))
