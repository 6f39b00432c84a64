"""Exact median by selection, without shuffling or ordering the column.

``percentile``/``median`` merge every distinct value of a group into one
buffer; for a global median that is one task holding the whole column. Here a
range that holds the middle ranks is narrowed:

1. one pass counts the values and sketches the quantiles just below and above
   the middle (``percentile_approx``: one sketch of fixed size per task);
2. a second pass counts the values under that range in one row per task, and
   the values inside by value; values above are not read on. The sketch's error
   is a share of the rows, so about 1 of 2,500 of them lie inside. The counts are
   written to the shared folder;
3. while more than ``small`` distinct values are left, ``splitters`` quantiles of
   them make buckets, one row per bucket is gathered, and the bucket with the
   middle ranks is kept: each round leaves about a ``splitters``-th;
4. the last at most ``small`` (value, count) rows are ordered.

What reaches the driver is one row of the sketch and one row per bucket, the
same at every size. Ranks are exact: they are counted, and where a range should
not hold them, all values are counted instead. NaN is the greatest value. The
result equals the interpolated median (``quantile_cont(0.5)``).
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.session import scratch_path

ACCURACY = 10_000   # of the sketch: a quantile's rank is off by at most rows / ACCURACY
SMALL = 1_000_000   # distinct values that are ordered in one task
SPLITTERS = 1_000   # of a round
_V, _B = "_v", "_qf_bucket"


def _counts(values: DataFrame, lo: float | None, hi: float | None) -> DataFrame:
    """(_v, _n) of the values from ``lo`` to ``hi`` (None: no limit); those below share one row, its _v is NULL."""
    v = F.col(_V)
    upper = values if hi is None else values.where(v <= F.lit(hi))
    counted = upper.groupBy((v if lo is None else F.when(v >= F.lit(lo), v)).alias(_V)).agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(values.sparkSession, "median")
    counted.write.parquet(path)
    return values.sparkSession.read.schema("_v double, _n long").parquet(path)


def _narrowed(table: DataFrame, below: int, ranks: tuple[int, int], splitters: int) -> tuple[DataFrame, int, int]:
    """The (value, count) rows of the buckets that hold the ranks, the number of
    values below them, and how many rows they are."""
    wanted = [i / splitters for i in range(1, splitters)]
    inner = table.agg(F.percentile_approx(_V, wanted, 10 * splitters).alias("q")).first()["q"]
    splits = [float("-inf"), *sorted({x for x in inner if abs(x) < float("inf")} or {0.0}), float("inf")]
    shown = table.withColumn(_B, F.when(F.isnan(_V), float("inf")).otherwise(F.col(_V)))
    bucketed = Bucketizer(splits=splits, inputCol=_B, outputCol=f"{_B}_at").transform(shown)
    per = bucketed.groupBy(f"{_B}_at").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("rows"))
    keep, under, rows = [], below, 0
    for at, n, held in sorted(per.collect()):
        if under + n <= ranks[0]:
            under += n
            below = under
        elif under <= ranks[1]:
            keep.append(int(at))
            under, rows = under + n, rows + held
    low = F.col(_V) >= F.lit(splits[keep[0]])
    high = F.col(_V) < F.lit(splits[keep[-1] + 1]) if keep[-1] + 2 < len(splits) else F.lit(True)
    return table.where(low & high), below, rows


def middle_values(values: DataFrame, also: dict[str, Column] | None = None, small: int = SMALL, splitters: int = SPLITTERS,
                  accuracy: int = ACCURACY) -> dict:
    """The two middle values ``low`` and ``high`` (None without values) of the
    column ``_v``, NULLs left out, and the aggregates ``also`` of the first pass."""
    values = values.where(F.col(_V).isNotNull())
    margin = 2.0 / accuracy
    also = also or {}
    first = values.agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(_V, [0.5 - margin, 0.5 + margin], accuracy).alias("_q"),
                       *[c.alias(name) for name, c in also.items()]).first()
    out = {name: first[name] for name in also} | {"low": None, "high": None}
    if not first["_n"]:
        return out
    ranks = (first["_n"] - 1) // 2, first["_n"] // 2  # from 0
    for lo, hi in (tuple(first["_q"]), (None, None)):
        table = _counts(values, lo, hi)
        inside = F.col(_V).isNotNull()
        got = table.agg(F.sum(F.when(~inside, F.col("_n"))).alias("below"), F.sum(F.when(inside, F.col("_n"))).alias("inside"),
                        F.count(_V).alias("rows")).first()
        below, rows = got["below"] or 0, got["rows"]
        if below <= ranks[0] and ranks[1] < below + (got["inside"] or 0):
            break
    table = table.where(F.col(_V).isNotNull())
    while rows > small:
        table, below, left = _narrowed(table, below, ranks, splitters)
        if left == rows:
            raise ValueError(f"{splitters} splitters do not part {rows} values")
        rows = left
    up_to = F.sum("_n").over(Window.orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)) + F.lit(below)
    ranked = table.withColumn("_hi", up_to)
    ends = ranked.agg(*[F.min(F.when(F.col("_hi") > r, F.col(_V))).alias(name) for name, r in zip(("low", "high"), ranks)]).first()
    return out | ends.asDict()


def median_of(found: dict) -> float | None:
    """The interpolated median of ``middle_values``."""
    low, high = found["low"], found["high"]
    return low if low is None or low == high else low + (high - low) * 0.5  # equal ones may be infinite


def exact_median(df: DataFrame, column: str, out: str = "median", **limits: int) -> DataFrame:
    """One-row DataFrame ``out`` (NULL when there is no non-NULL value)."""
    found = middle_values(df.select(F.col(column).cast("double").alias(_V)), **limits)
    return df.sparkSession.range(1).select(F.lit(median_of(found)).cast("double").alias(out))
