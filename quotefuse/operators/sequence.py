"""Previous-row lookup per key that does not put a hot key into one task.

``lag(v) over (partition by key order by o)`` hash-partitions on ``key``: a
key holding a third of the rows would sit in one task. Here:

1. rows per key are counted (partial aggregation: skew-safe); keys above
   ``hot_rows`` are hot, so there are at most ``total / hot_rows`` of them.
   Without any hot key the plain window lag is used (one shuffle);
2. for hot keys only, ``percentile_approx`` of the leading order column gives
   ``chunks - 1`` split points per key (a fixed-size sketch per key and task);
3. every row gets ``chunk`` = number of its key's split points strictly below
   its leading order value — a pure function of the row, so any recomputation
   of any branch agrees; cold keys are one chunk. The count is O(1) expected
   per row: split points are pre-bucketed per key into equal-width cells, so
   a row adds its cell's prefix count to the few points inside its cell;
4. the lag runs per (key, chunk); the first row of each chunk takes the last
   value of the previous non-empty chunk of its key. Only hot keys have
   chunks > 0, so that carry table has at most (hot keys) x (chunks - 1) rows.

The hot-key count is measured (step 1), so the side tables have a known size
bound. Under ``broadcast_rows`` both are broadcast and the lag is ONE window
pass over all rows plus a partial aggregate for the carry; above it, the
joins are plain equi-joins (AQE decides, skewed partitions are split) and
the first rows of each chunk are patched in a separate small branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CH, _FIRST, _LAST, _CARRY, _B = "_qf_chunk", "_qf_first", "_qf_last", "_qf_carry", "_qf_bounds"


def _as_long(c: Column, dtype: str) -> Column:
    if dtype.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    if dtype == "date":
        return F.unix_date(c).cast("long")
    return c.cast("double")


def lag_by_key(df: DataFrame, key: str, order: list[str], value: str, out: str,
               hot_rows: int = 1_000_000, chunks: int | None = None,
               broadcast_rows: int = 2_000_000) -> DataFrame:
    """Adds ``out`` = previous ``value`` of the same ``key`` in ``order``
    (which must be unique within a key)."""
    spark = df.sparkSession
    lead_col = order[0]
    lead = _as_long(F.col(lead_col), df.schema[lead_col].dataType.simpleString())
    hot = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_qf_n"))
           .where(F.col("_qf_n") > hot_rows))
    # one small aggregate; gives the number of hot keys and the largest of them
    n_hot, largest = hot.agg(F.count(F.lit(1)), F.max("_qf_n")).first()
    hot = hot.select(F.col(key).alias("_h_key"))
    if n_hot == 0:
        # no key exceeds hot_rows: every window partition fits a task, so the
        # plain single-shuffle lag is already skew-safe. The window reuses the
        # explicit hash partitioning (still one exchange); its width is the
        # session's shuffle partitions, so the output keeps the deployment's
        # parallelism instead of being coalesced into a few large tasks.
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return (df.repartition(n, key)
                .withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy(*order))))
    # chunks per hot key: about hot_rows / 4 rows each, and enough to spread it over the cluster
    m = chunks or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * largest // hot_rows))
    fractions = [i / m for i in range(1, m)]
    # null-safe: a NULL key can be hot like any other
    stats = (df.join(hot, F.col(key).eqNullSafe(F.col("_h_key")), "left_semi").groupBy(key)
             .agg(F.percentile_approx(lead, fractions, max(10000, 4 * m)).alias(_B),
                  F.min(lead).alias("_qf_lo"), F.max(lead).alias("_qf_hi")))
    # Pre-bucket each hot key's split points into m equal-width cells over
    # [lo, hi] (once per key, in this small table), so a row needs only its
    # cell's prefix count and the few split points inside its own cell.
    lo, hi, b_ = F.col("_qf_lo"), F.col("_qf_hi"), F.col(_B)

    def cell_of(x):
        c = F.floor((x - lo) * F.lit(float(m)) / (hi - lo + F.lit(1.0)))
        return F.least(F.greatest(c, F.lit(0)), F.lit(m - 1))

    cells = F.sequence(F.lit(0), F.lit(m - 1))
    bounds = stats.select(
        F.col(key).alias("_b_key"), "_qf_lo", "_qf_hi",
        F.transform(cells, lambda c: F.size(F.filter(b_, lambda b: cell_of(b) < c))).alias("_qf_pre"),
        F.transform(cells, lambda c: F.filter(b_, lambda b: cell_of(b) == c)).alias("_qf_in"))
    cell = cell_of(lead) + 1
    inner = F.element_at(F.col("_qf_in"), cell.cast("int"))
    chunk = F.coalesce(F.element_at(F.col("_qf_pre"), cell.cast("int"))
                       + F.size(F.filter(inner, lambda b: b < lead)), F.lit(0))
    w = Window.partitionBy(key, _CH).orderBy(*order)
    # both side tables grow with (hot keys) x chunks, which is now known
    small = n_hot * (m - 1) <= broadcast_rows
    chunked = df.join(F.broadcast(bounds) if small else bounds, F.col(key).eqNullSafe(F.col("_b_key")), "left").withColumn(
        _CH, chunk).drop("_b_key", "_qf_lo", "_qf_hi", "_qf_pre", "_qf_in")
    if small:
        return _lag_with_carry_broadcast(chunked, key, order, value, out, w)
    local = (chunked
             .withColumn(out, F.lag(value).over(w))
             .withColumn(_FIRST, F.row_number().over(w) == 1)
             .withColumn(_LAST, F.lead(F.lit(1)).over(w).isNull()))
    carry = (local.where(F.col(_LAST))
             .select(F.col(key).alias("_c_key"), F.col(_CH).alias("_c_ch"),
                     F.lag(value).over(Window.partitionBy(key).orderBy(_CH)).alias(_CARRY)))
    firsts = (local.where(F.col(_FIRST)).drop(out)
              .join(carry, F.col(key).eqNullSafe(F.col("_c_key"))
                    & (F.col(_CH) == F.col("_c_ch")), "left")
              .withColumnRenamed(_CARRY, out)
              .drop("_c_key", "_c_ch"))
    rest = local.where(~F.col(_FIRST))
    return rest.unionByName(firsts).drop(_CH, _FIRST, _LAST)


def _lag_with_carry_broadcast(chunked: DataFrame, key: str, order: list[str], value: str,
                              out: str, w: Window) -> DataFrame:
    """One window pass over all rows; the first row of every chunk > 0 then
    takes its carry from a broadcast table. Only hot keys have chunks > 0, so
    the table holds at most (hot keys) x (chunks - 1) rows — the caller has
    checked that bound against ``broadcast_rows``."""
    lagged = (chunked.withColumn(out, F.lag(value).over(w))
              .withColumn(_FIRST, F.row_number().over(w) == 1))
    # last value per (key, chunk): a partial aggregate, then a lag over at
    # most ``chunks`` rows per key
    last = chunked.groupBy(key, _CH).agg(
        F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("_qf_lastv"))
    carry = (last.select(F.col(key).alias("_c_key"), F.col(_CH).alias("_c_ch"),
                         F.lag("_qf_lastv").over(Window.partitionBy(key).orderBy(_CH)).alias(_CARRY))
             .where(F.col("_c_ch") > 0))
    joined = lagged.join(F.broadcast(carry), F.col(key).eqNullSafe(F.col("_c_key"))
                         & (F.col(_CH) == F.col("_c_ch")) & F.col(_FIRST), "left")
    return joined.withColumn(out, F.when(F.col("_c_ch").isNotNull(), F.col(_CARRY))
                             .otherwise(F.col(out))).drop(_CH, _FIRST, "_c_key", "_c_ch", _CARRY)
