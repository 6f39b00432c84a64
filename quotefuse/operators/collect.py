"""Collection: union of source frames and its summaries.

Outer union by name (a missing column is NULL). Unlike pandas, Spark does
not change column types when a frame is empty or all-NULL, so no frame
needs to be dropped first.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotefuse import constants as K


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def summary(df: DataFrame) -> DataFrame:
    """Success / error counts in one pass (A4)."""
    st = F.col("statut")
    return df.agg(F.count_if(st == K.STATUS_OK).alias("nb_succes"),
                   F.count_if(st == K.STATUS_ERROR).alias("nb_erreurs"))


def successes(df: DataFrame) -> DataFrame:
    return df.where(F.col("statut") == K.STATUS_OK)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """pandas value_counts(): NULL dropped, count desc (A5)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col(column).asc()))
