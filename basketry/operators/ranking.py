"""Global ranks, NTILE, qcut and running totals without a single-partition window.

``ntile(5).over(Window.orderBy(x))`` plans an ``Exchange SinglePartition``:
every row of the table goes through one task.  Here the same numbers come
from a distributed sort instead (survey N1, N2):

1. ``repartitionByRange`` on the full order key (value, then the id), so even
   a value held by a third of all rows is split across range partitions;
2. ``sortWithinPartitions`` + ``monotonically_increasing_id`` gives each row
   its position inside its partition;
3. the frame is checkpointed (reliable storage, lineage cut) so positions
   and partition sizes are computed from the very same rows even if an
   executor is lost and tasks are re-run;
4. per-partition sizes -> prefix offsets: one row per partition, a table
   whose size is bounded by the partition count, so it is broadcast.

The result equals ``row_number()`` over the order key, with ties broken by
the key columns themselves (callers always end the key with a unique id).

Only callers that need a rank for every row sort (``global_row_number``).  A few ranks,
NTILE cuts and quantile edges are selected without a sort (``selection``), and running
totals come from two levels of sums (``prefix_sums``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators import selection
from basketry.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | row position


def _num_parts(df: DataFrame, parts: int | None) -> int:
    if parts:
        return parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rn",
                      total: str | None = None, parts: int | None = None) -> DataFrame:
    """Append ``out`` = 1-based row number over ``order`` (and optionally the row count)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _num_parts(df, parts)
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    pid = F.shiftrightunsigned(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    sizes = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per range partition: a size bound of spark.sql.shuffle.partitions.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"))
    ranked = (ranged.withColumn("_pid", pid).withColumn("_pos", pos)
              .join(F.broadcast(offsets), "_pid")
              .withColumn(out, F.col("_offset") + F.col("_pos") + 1))
    if total:
        ranked = ranked.withColumnRenamed("_total", total)
    return ranked.drop("_mid", "_pid", "_pos", "_offset", "_total")


def ntile_from_rank(rank: Column, total: Column, buckets: int) -> Column:
    """SQL ``NTILE(buckets)`` given a 1-based row number and the row count."""
    q = F.floor(total / buckets)
    big = total % buckets            # the first ``big`` buckets hold q + 1 rows
    cut = big * (q + 1)
    return F.when(rank <= cut, F.floor((rank - 1) / (q + 1)) + 1) \
        .otherwise(big + F.floor((rank - cut - 1) / q) + 1).cast("int")


def global_ntile(df: DataFrame, order: Sequence[Column], buckets: int, out: str,
                 parts: int | None = None) -> DataFrame:
    ranked = global_row_number(df, order, out="_rn", total="_n", parts=parts)
    return ranked.withColumn(out, ntile_from_rank(F.col("_rn"), F.col("_n"), buckets)) \
        .drop("_rn", "_n")


def global_ntiles(df: DataFrame, id_col: str, specs, buckets: int, limit: int | None = None) -> DataFrame:
    """Several SQL ``NTILE(buckets)`` columns by cut keys: no row is ranked or joined.

    ``specs`` = [(out, column, descending)]; every ordering ends with ``id_col`` ascending,
    which must be unique.  The last (key, id) of each bucket is selected exactly and rows are
    compared with these cuts.  NULL keys sort first for ascending and last for
    descending specs, as in Spark and SQL.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)                 # cuts and buckets read the very same rows
    dims = [selection.Dimension(-F.col(c) if desc else F.col(c), nulls_first=not desc) for _, c, desc in specs]
    cuts = selection.cut_keys(df, id_col, dims, lambda n: selection.ntile_ends(n, buckets), limit)
    labels = [selection.buckets_from_cuts(df, id_col, d, own).cast("int").alias(out) for (out, _, _), d, own in zip(specs, dims, cuts, strict=True)]
    return df.select("*", *labels)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """One-row frame of linear-interpolated quantiles (no row without values), selected exactly."""
    found = selection.quantiles(df, [value], probs).get(value)
    schema = ", ".join(f"{prefix}{i} double" for i in range(len(probs)))
    return df.sparkSession.createDataFrame([tuple(found)] if found else [], schema)


def qcut_expr(value: str, edges, descending: bool = False):
    """Label 1..bins of a right-closed qcut with the given (unique) edges."""
    v = F.col(value).cast("double")
    label = F.lit(1)
    for e in edges[1:-1]:
        label = label + F.when(v > F.lit(e), 1).otherwise(0)
    if descending:
        label = F.lit(len(edges)) - label
    return F.when(v.isNotNull(), label).cast("int")


def prefix_sums(df: DataFrame, key: str, cols: Sequence[str], descending: bool = False, buckets: int = 256,
                prefix: str = "cum_", with_totals: bool = False) -> DataFrame:
    """Running totals of ``cols`` over the numeric ``key`` (distinct, not null), on two levels.

    A sketch cuts the keys into ``buckets`` ranges of about as many rows.  The first level sums
    each range, a table of ``buckets`` rows on the driver; the second runs inside the ranges, which one
    exchange by range number brings together.  Nulls count as 0.  ``with_totals`` adds ``total_<col>``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)                 # edges, sums and rows of the very same table
    share = [(i + 1) / buckets for i in range(buckets - 1)]
    sketch = df.agg(F.percentile_approx(F.col(key).cast("double"), share, max(10_000, 20 * buckets)).alias("e")).first()["e"]
    edges = sorted({float(e) for e in sketch or []})
    order = F.col(key).desc() if descending else F.col(key).asc()
    own = F.col(key).cast("double")
    where = F.size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<double>"), lambda e: own < e if descending else own > e))
    ranged = df.withColumn("_range", where)
    sums = {r["_range"]: r for r in ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in cols]).collect()}
    out = ranged
    w = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        kind = ranged.agg(F.sum(c).alias("s")).schema["s"].dataType
        before, total = [], None
        for k in range(len(edges) + 1):
            before.append(total or 0)
            step = sums[k][c] if k in sums else None
            total = total if step is None else step + (total or 0)
        starts = F.array(*[F.lit(x) for x in before]).cast(f"array<{kind.simpleString()}>")
        out = out.withColumn(f"{prefix}{c}", F.coalesce(F.sum(c).over(w), F.lit(0)) + F.element_at(starts, F.col("_range") + 1))
        if with_totals:
            out = out.withColumn(f"total_{c}", F.lit(total).cast(kind))
    return out.drop("_range")


def qcut_labels(df: DataFrame, value: str, out: str, q: int = 5, descending: bool = False,
                duplicates: str = "raise") -> DataFrame:
    """pandas ``qcut(value, q, labels=1..q)`` (reversed when ``descending``)."""
    return qcut_many(df, [(value, out, descending)], q, duplicates)


def qcut_many(df: DataFrame, specs, q: int = 5, duplicates: str = "raise") -> DataFrame:
    """Several ``qcut`` columns at once; ``specs`` = [(value, out, descending)].

    Bins are right-closed with the first bin including the minimum, so the
    label is 1 + the number of inner edges strictly below the value.  The
    edges of all columns are selected together; duplicate edges raise like pandas does.
    """
    edges = qcut_edges_many(df, [v for v, _, _ in specs], q, duplicates)
    for value, out, descending in specs:
        # duplicates="drop" (pandas) merges equal edges: fewer, wider bins.
        e = sorted(set(edges[value])) if duplicates == "drop" else edges[value]
        df = df.withColumn(out, qcut_expr(value, e, descending))
    return df


def qcut_edges_many(df: DataFrame, values, q: int = 5, duplicates: str = "raise") -> dict[str, list[float]]:
    """The q + 1 edges (min, inner quantiles, max) of each column as driver-side floats."""
    edges = selection.quantiles(df, list(values), [i / q for i in range(q + 1)])
    for v in values:
        e = edges.get(v)
        if e is None:
            raise ValueError(f"qcut: {v} has no non-null values")
        if duplicates == "raise" and len(set(e)) != len(e):
            raise ValueError(f"qcut: bin edges of {v} must be unique: {e}")
    return edges


def qcut_edges(df: DataFrame, value: str, q: int = 5, duplicates: str = "raise") -> list[float]:
    return qcut_edges_many(df, [value], q, duplicates)[value]


def average_rank_desc(df: DataFrame, value: str, out: str) -> DataFrame:
    """pandas ``rank(ascending=False)`` (average ties) truncated to int.

    Only used on per-cluster tables (k <= a few dozen rows), so the
    unpartitioned window runs on a bounded input.
    """
    w = Window.orderBy(F.col(value).desc())
    tie = Window.partitionBy(value)
    avg_rank = F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0
    return df.withColumn(out, F.floor(avg_rank).cast("int"))
