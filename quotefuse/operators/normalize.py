"""Bronze normalisation: column aliases, ticker remap, currency rule, defaults.

All of it is a single projection each and nothing shuffles, but for a mapping
that is a table too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.schemas import ENSURE_DEFAULTS
from quotefuse.session import scratch_path


def columns(df: DataFrame, aliases: Iterable[tuple[str, str]] = K.DEFAULT_ALIASES) -> DataFrame:
    """Rename provider columns to canonical names.

    For each canonical name the result is ``coalesce(canonical, alias1,
    alias2, ...)`` over the columns present, so two aliases of one name do
    not produce duplicate columns. Names match case-sensitively ('P' is an
    alias, 'p' is not): columns are addressed by position, never resolved
    by the case-insensitive analyzer.
    """
    names = df.columns
    pos = {}
    for i, n in enumerate(names):
        pos.setdefault(n, i)
    alias_of: dict[str, list[int]] = {}
    for alias, canon in aliases:
        if alias in pos and alias != canon:
            alias_of.setdefault(canon, []).append(pos[alias])
    if not alias_of:
        return df
    tmp = [f"_qf_{i}" for i in range(len(names))]
    safe = df.toDF(*tmp)
    canon_at = {j: canon for canon, idx in alias_of.items() for j in idx}
    out, done = [], set()
    for i, n in enumerate(names):
        target = canon_at.get(i, n)
        if target in done:
            continue
        if target in alias_of:  # first occurrence of the canonical name or an alias
            parts = ([F.col(tmp[pos[target]])] if target in pos else []) + \
                    [F.col(tmp[j]) for j in alias_of[target]]
            out.append(_coalesce_typed(safe, parts).alias(target))
        else:
            out.append(F.col(tmp[i]).alias(n))
        done.add(target)
    return safe.select(out)


def _coalesce_typed(df: DataFrame, cols: list) -> F.Column:
    if len(cols) == 1:
        return cols[0]
    types = {df.select(c).schema[0].dataType.simpleString() for c in cols}
    if len(types) > 1:  # mixed provider types: keep the text form
        cols = [c.cast("string") for c in cols]
    return F.coalesce(*cols)


def tickers(df: DataFrame, mapping: Mapping[str, str] | DataFrame = K.BOURSORAMA_TICKERS,
            broadcast_rows: int = 100_000) -> DataFrame:
    """Exchange-specific symbols -> common tickers, then '.PA' -> EUR.

    ``mapping`` is a small literal map, or a table of any size with the
    columns ``alias`` and ``ticker`` (see ``look_up``). A NULL ticker keeps its
    currency. Without a ``ticker`` column this is a no-op.
    """
    if "ticker" not in df.columns:
        return df
    if isinstance(mapping, DataFrame):
        df = look_up(df, mapping, broadcast_rows)
    elif mapping:
        lut = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        df = df.withColumn("ticker", F.coalesce(F.try_element_at(lut, F.col("ticker")), F.col("ticker")))
    if "devise" not in df.columns:
        df = df.withColumn("devise", F.lit(K.DEFAULT_CURRENCY))
    return df.withColumn("devise", F.when(F.col("ticker").endswith(".PA"), F.lit("EUR"))
                         .otherwise(F.col("devise")))


def look_up(df: DataFrame, mapping: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """``ticker`` replaced by a mapping table's (J7); every row of ``df`` stays, once.

    Of an alias that the table holds more than once the least ticker counts;
    rows with a NULL alias or ticker do not. The table is counted: up to
    ``broadcast_rows`` aliases are broadcast. Of more, those that ``df`` uses
    are kept first (distinct tickers, so a ticker of any share is one row),
    written to the shared folder and counted again; what is still too many is
    joined by a shuffle, where AQE splits a frequent ticker's partition.
    """
    pairs = (mapping.where(F.col("alias").isNotNull() & F.col("ticker").isNotNull())
             .groupBy(F.col("alias").cast("string").alias("_qf_alias"))
             .agg(F.min(F.col("ticker").cast("string")).alias("_qf_to")))
    small = pairs.limit(broadcast_rows + 1).count() <= broadcast_rows
    if not small:
        used = df.select(F.col("ticker").alias("_qf_alias")).distinct()
        path = scratch_path(df.sparkSession, "ticker-map")
        pairs.join(used, "_qf_alias", "left_semi").write.parquet(path)
        pairs = df.sparkSession.read.schema(pairs.schema).parquet(path)
        small = pairs.count() <= broadcast_rows
    joined = df.join(F.broadcast(pairs) if small else pairs, F.col("ticker") == F.col("_qf_alias"), "left")
    return joined.withColumn("ticker", F.coalesce("_qf_to", "ticker")).drop("_qf_alias", "_qf_to")


def ensure(df: DataFrame, defaults: Mapping[str, object] = ENSURE_DEFAULTS) -> DataFrame:
    """Add missing Silver columns with their defaults (P4); existing NULLs stay."""
    missing = [F.lit(v).cast("string").alias(c) for c, v in defaults.items()
               if c not in df.columns]
    return df.select("*", *missing) if missing else df
