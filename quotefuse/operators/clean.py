"""Silver cleaning: safe casts, validity filter, currency rule, projection.

P5-P8 and A17. The filter stays *after* fusion (its predicates apply to the
fused rows, so Catalyst cannot and must not push it below the aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.functions.scalar import nan_to_null
from quotefuse.schemas import BRONZE_COLUMNS, NUMERIC_COLUMNS, SILVER_COLUMNS


def cast_types(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numerics -> DOUBLE via try_cast (junk -> NULL), NaN -> NULL; text -> STRING."""
    out = []
    for c in BRONZE_COLUMNS:
        if c in NUMERIC_COLUMNS:
            out.append(nan_to_null(F.col(c).try_cast("double")).alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return df.select(*out, *keep)


def valid_predicate() -> Column:
    st, p, v = F.col("statut"), F.col("prix"), F.col("variation_pct")
    return (((st == K.STATUS_OK) | st.isNull())
            & p.isNotNull() & (p > 0)
            & v.isNotNull() & v.between(K.CLEAN_MIN_VAR, K.CLEAN_MAX_VAR))


def valid(df: DataFrame) -> DataFrame:
    """Keep successful (or status-less) rows with a positive price and a
    variation within [-100, 100] inclusive (P6)."""
    return df.where(valid_predicate())


def currency_expr() -> Column:
    d = F.col("devise")
    return (F.when(d.isNull() | (d == ""), F.lit(K.DEFAULT_CURRENCY))
            .when(F.col("ticker").like("%.PA"), F.lit("EUR"))
            .otherwise(d))


def currency(df: DataFrame) -> DataFrame:
    """Ordered CASE: blank/NULL -> USD first, then '.PA' -> EUR."""
    return df.withColumn("devise", currency_expr())


def finalize(df: DataFrame, sort: bool = False) -> DataFrame:
    """The 14 Silver columns (P8). ``sort`` adds the global ORDER BY
    categorie, ticker (NULLs last) — only for writing a sorted snapshot."""
    out = df.select(*SILVER_COLUMNS)
    if sort:
        out = out.orderBy(F.col("categorie").asc_nulls_last(), F.col("ticker").asc_nulls_last())
    return out


def clean(df: DataFrame, sort: bool = False) -> DataFrame:
    """P5 -> P6 -> P7 -> P8."""
    return finalize(currency(valid(cast_types(df))), sort=sort)


def counts(df_cast: DataFrame) -> DataFrame:
    """Rows before / after the filter in one pass."""
    return df_cast.agg(F.count(F.lit(1)).alias("nb_avant"),
                       F.count_if(valid_predicate()).alias("nb_apres"))
