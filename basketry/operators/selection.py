"""Exact selection without sorting the table (survey C2, A4, A5, X11, N1, N2).

A handful of order statistics of n rows needs no order of all rows:

1. *Sketch.*  ``percentile_approx`` brackets each wanted rank by two values; the sketch is merged
   map side, so its exchange carries a summary a task.
2. *Count.*  One aggregation counts exactly what lies below each bracket and inside it.  The
   rank is kept only where the counts prove that it lies inside, so the sketch's error
   costs time, never exactness.
3. *Narrow.*  Brackets that still hold more than ``LIMIT`` rows are sketched again inside; each
   round leaves about 2 / ``ACCURACY`` of them.
4. *Sort the band.*  What is left, at most ``LIMIT`` rows a rank, is grouped by value and
   numbered.  A value held by a third of all rows is one row there.

Should a bracket not narrow any more, its rows alone go through the distributed sort of ``ranking``.
Strings are narrowed by the number that six of their bytes make, which keeps their order.

``cut_keys`` selects compound (value, id) keys: first the value, then the id among its
ties.  Buckets (NTILE, quintiles of a first-rank) are then comparisons with a few cut
keys, without a rank for each row and without a join.

The frame is read once for each step, so callers pass a checkpointed or otherwise cheap one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType, StringType

#: Rows of a band that are sorted at once.
LIMIT = 100_000
#: Accuracy of the sketches: ranks are off by n / ACCURACY at most.
ACCURACY = 10_000
#: Bytes of a string compared as one number (48 bits: exact in a double).
STEP = 6


@dataclass(frozen=True)
class Picked:
    """The value at a rank, the rows with smaller values, and the rows that hold it."""

    value: Any
    before: int
    equal: int


@dataclass
class _Band:
    column: Column
    rank: int
    kind: Any
    index: int
    number: Column = None
    inside_of: Column = field(default_factory=lambda: F.lit(True))
    low: Any = None
    high: Any = None
    below: int = 0
    inside: int = 0
    level: int = 0
    stuck: bool = False

    def literal(self, value) -> Column:
        return F.lit(value).cast(self.kind) if not isinstance(self.kind, StringType) else F.lit(value)

    def holds(self) -> Column:
        return self.inside_of & (self.number >= self.literal(self.low)) & (self.number <= self.literal(self.high))

    def bound(self, value: float, up: bool):
        """A sketch's double as a bound of the column's type, never tighter than the double."""
        if isinstance(self.kind, DecimalType):
            unit = Decimal(1).scaleb(-self.kind.scale)
            return Decimal(value).quantize(unit, rounding=ROUND_CEILING if up else ROUND_FLOOR)
        if self.kind.simpleString() in ("double", "float"):
            return value
        return math.ceil(value) if up else math.floor(value)


def _code(column: Column, level: int) -> Column:
    """Bytes [6 level, 6 level + 6) of a string as a number; missing bytes count as 0."""
    part = F.substring(F.encode(column, "UTF-8"), STEP * level + 1, STEP)
    return F.conv(F.rpad(F.hex(part), 2 * STEP, "0"), 16, 10).cast("long")


def order_statistics(df: DataFrame, wanted: Sequence[tuple[Column, int]], limit: int | None = None) -> list[Picked]:
    """For each (column, rank from 1): the value at that rank among the column's non-null values.

    A rank beyond the values gives ``None``.  Columns are numbers or strings.
    """
    limit = LIMIT if limit is None else limit
    kinds = df.select(*[c.alias(f"c{k}") for k, (c, _) in enumerate(wanted)]).schema.fields
    bands = [_Band(c, rank, kinds[k].dataType, k) for k, (c, rank) in enumerate(wanted)]
    if not bands:
        return []
    for b in bands:
        if not isinstance(b.kind, (NumericType, StringType)):
            raise TypeError(f"order statistics of {b.kind.simpleString()}")
        b.number = _code(b.column, 0) if isinstance(b.kind, StringType) else b.column
    first = df.agg(*[f(x).alias(f"{n}{b.index}") for b in bands for n, f, x in
                     (("n", F.count, b.column), ("a", F.min, b.number), ("z", F.max, b.number))]).first()
    for b in bands:
        b.inside, b.low, b.high = first[f"n{b.index}"], first[f"a{b.index}"], first[f"z{b.index}"]
    live = [b for b in bands if 1 <= b.rank <= b.inside]
    while big := [b for b in live if b.inside > limit and not b.stuck and (b.low != b.high or isinstance(b.kind, StringType))]:
        _narrow(df, big)
    found = _picked(df, live, limit)
    return [found.get(b.index) for b in bands]


def _narrow(df: DataFrame, bands: list[_Band]) -> None:
    for b in bands:
        if b.low == b.high:                       # a string's bytes so far are decided: on to the next ones
            b.inside_of = b.inside_of & (b.number == b.literal(b.low))
            b.level += 1
            b.number, b.low, b.high = _code(b.column, b.level), 0, (1 << 8 * STEP) - 1
            b.stuck = b.level > 64
    bands = [b for b in bands if not b.stuck]
    if not bands:
        return
    slack = {b.index: 2 / ACCURACY + 1 / b.inside for b in bands}
    share = {b.index: (b.rank - b.below) / b.inside for b in bands}
    sketch = df.agg(*[F.percentile_approx(F.when(b.holds(), b.number.cast("double")),
                                          [max(0.0, share[b.index] - slack[b.index]), min(1.0, share[b.index] + slack[b.index])],
                                          ACCURACY).alias(f"q{b.index}") for b in bands]).first()
    tried = {}
    for b in bands:
        low, high = sketch[f"q{b.index}"]
        tried[b.index] = max(b.low, b.bound(low, up=False)), min(b.high, b.bound(high, up=True))
    counts = df.agg(*[F.count_if(b.holds() & test).alias(f"{n}{b.index}") for b in bands for n, test in
                      (("u", b.number < b.literal(tried[b.index][0])),
                       ("i", (b.number >= b.literal(tried[b.index][0])) & (b.number <= b.literal(tried[b.index][1]))))]).first()
    for b in bands:
        under, inside = counts[f"u{b.index}"], counts[f"i{b.index}"]
        proven = under < b.rank - b.below <= under + inside
        unchanged = (b.low, b.high) == tried[b.index]
        if proven and not unchanged:
            b.low, b.high = tried[b.index]
            b.below, b.inside = b.below + under, inside
        else:
            b.stuck = b.low != b.high


def _picked(df: DataFrame, bands: list[_Band], limit: int) -> dict[int, Picked]:
    out = {b.index: Picked(b.low, b.below, b.inside) for b in bands if b.low == b.high and not isinstance(b.kind, StringType)}
    rest = [b for b in bands if b.index not in out]
    for kind in {b.kind.simpleString() for b in rest}:
        alike = [b for b in rest if b.kind.simpleString() == kind]
        rows = df.select(F.explode(F.array_compact(F.array(*[
            F.when(b.holds(), F.struct(F.lit(b.index).alias("band"), b.column.alias("value"))) for b in alike]))).alias("s")).select("s.*")
        values = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("equal"))
        small, wide = ([b for b in alike if (b.inside > limit) == over] for over in (False, True))
        if small:
            values = rows.where(F.col("band").isin([b.index for b in small])).groupBy("band", "value").agg(F.count(F.lit(1)).alias("equal"))
            before = Window.partitionBy("band").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
            counted = values.withColumn("before", F.coalesce(F.sum("equal").over(before), F.lit(0)))
            wanted = F.lit(False)
            for b in small:
                want = b.rank - b.below
                wanted = wanted | ((F.col("band") == b.index) & (F.col("before") < want) & (F.col("before") + F.col("equal") >= want))
            below = {b.index: b.below for b in small}
            for r in counted.where(wanted).collect():                    # one row a rank
                out[r["band"]] = Picked(r["value"], below[r["band"]] + r["before"], r["equal"])
        for b in wide:
            from basketry.operators import ranking                       # its distributed sort is the way out
            own = rows.where(F.col("band") == b.index).withColumn("tie", F.monotonically_increasing_id())
            value = ranking.global_row_number(own, [F.col("value"), F.col("tie")]).where(F.col("rn") == b.rank - b.below).first()["value"]
            n = df.agg(F.count_if(b.column < F.lit(value)).alias("before"), F.count_if(b.column == F.lit(value)).alias("equal")).first()
            out[b.index] = Picked(value, n["before"], n["equal"])
    return out


# ---------------------------------------------------------------- quantiles

def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], limit: int | None = None) -> dict[str, list[float]]:
    """Linear-interpolated quantiles (pandas, ``quantile_cont``) of each column; columns without values are left out.

    For p = a/b the position a (n - 1) / b is taken in exact integer arithmetic; result lo + (hi - lo) * frac.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    sizes = df.agg(*[F.count(v).alias(c) for c, v in values.items()]).first()
    places = {}
    for c in columns:
        n = sizes[c]
        for p in probs:
            whole = Fraction(p).limit_denominator(10 ** 6) * (n - 1)
            low = math.floor(whole) + 1
            if n:
                places[c, p] = low, min(low + 1, n), float((whole - math.floor(whole)).numerator) / float((whole - math.floor(whole)).denominator)
    ranks = sorted({(c, r) for (c, _), (a, b, _) in places.items() for r in (a, b)})
    found = dict(zip(ranks, order_statistics(df, [(values[c], r) for c, r in ranks], limit), strict=True))
    out: dict[str, list[float]] = {}
    for (c, _), (a, b, frac) in places.items():
        low, high = found[c, a].value, found[c, b].value
        out.setdefault(c, []).append(low + (high - low) * frac)
    return out


# ---------------------------------------------------------------- cut keys

@dataclass(frozen=True)
class Dimension:
    """An ordering of rows: by ``key``, nulls first or last, ties by id."""

    key: Column
    nulls_first: bool = True


def cut_keys(df: DataFrame, id_col: str, dims: Sequence[Dimension], ranks, limit: int | None = None) -> list[list[tuple]]:
    """For each dimension the (null flag, key, id) at the ranks that ``ranks(rows)`` names.

    Ids must be unique; a null id sorts first.
    """
    own = F.col(id_col)
    sizes = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(own.isNull()).alias("ids"), *[F.count(d.key).alias(f"k{i}") for i, d in enumerate(dims)]).first()
    wanted = []                                        # (dimension, rank among the keys or None, rank among the nulls)
    for i, d in enumerate(dims):
        keyed, empty = sizes[f"k{i}"], sizes["n"] - sizes[f"k{i}"]
        for r in ranks(sizes["n"]):
            if d.nulls_first:
                wanted.append((i, r - empty if r > empty else None, r))
            else:
                wanted.append((i, r if r <= keyed else None, r - keyed))
    keyed = sorted({(i, r) for i, r, _ in wanted if r is not None})
    at = dict(zip(keyed, order_statistics(df, [(dims[i].key, r) for i, r in keyed], limit), strict=True))
    ties = []                                          # (rows of the tie, rank inside)
    for i, r, null_rank in wanted:
        key = dims[i].key
        ties.append((key == F.lit(at[i, r].value), r - at[i, r].before) if r is not None else (key.isNull(), null_rank))
    if sizes["ids"]:                                   # the null id stands before the others of its tie
        first = df.agg(*[F.count_if(own.isNull() & tie).alias(f"t{k}") for k, (tie, _) in enumerate(ties)]).first()
        ties = [(tie, r - first[f"t{k}"]) for k, (tie, r) in enumerate(ties)]
    ids = order_statistics(df, [(F.when(tie, own), r) for tie, r in ties], limit)
    out: list[list[tuple]] = [[] for _ in dims]
    for (i, r, _), found in zip(wanted, ids, strict=True):
        flag = int(r is not None) if dims[i].nulls_first else int(r is None)
        out[i].append((flag, at[i, r].value if r is not None else None, found.value if found else None))
    return out


def buckets_from_cuts(df: DataFrame, id_col: str, dim: Dimension, cuts: Sequence[tuple]) -> Column:
    """1 + the number of cut keys before a row: the bucket of every row by comparison alone."""
    flag = (dim.key.isNotNull() if dim.nulls_first else dim.key.isNull()).cast("int")
    kinds = df.select(dim.key.alias("k"), F.col(id_col).alias("i")).schema
    own = F.struct(flag.alias("f"), dim.key.alias("k"), F.col(id_col).alias("i"))
    label = F.lit(1)
    for f, k, i in cuts:
        cut = F.struct(F.lit(f).alias("f"), F.lit(k).cast(kinds["k"].dataType).alias("k"), F.lit(i).cast(kinds["i"].dataType).alias("i"))
        label = label + (own > cut).cast("int")
    return label


def ntile_ends(rows: int, buckets: int) -> list[int]:
    """The last rank of each bucket but the last of SQL ``NTILE(buckets)``."""
    size, more = divmod(rows, buckets)
    ends = [i * size + min(i, more) for i in range(1, buckets)]
    return [e for e in ends if e < rows]
