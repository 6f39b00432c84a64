"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotefuse.session import scratch_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts the
    lineage at files that survive the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use yet (compared without case)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def order_key(doc_id: Column, text: Column) -> Column:
    """One number that identifies and orders documents: the id (null last), then 60 bits of the text hash."""
    wide = F.coalesce(doc_id.cast("decimal(19,0)"), F.lit(str(1 << 63)).cast("decimal(19,0)"))
    tail = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 4).cast("decimal(19,0)")
    return (wide.cast("decimal(19,0)") * F.lit(1 << 60).cast("decimal(19,0)") + tail).cast("decimal(38,0)")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body).getItem(0)


def blocks(items: Iterable, size: int) -> Iterator[list]:
    """Lists of at most ``size`` consecutive items."""
    part = []
    for x in items:
        part.append(x)
        if len(part) >= size:
            yield part
            part = []
    if part:
        yield part


def slices(batches: Iterable, rows: int = 512) -> Iterator:
    """The record batches in parts of at most ``rows`` rows, so that a task
    holds the Python values of few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_slices(batches: Iterable, column: str, rows: int = 4096, size: int = 1 << 21) -> Iterator:
    """The record batches in parts of at most ``rows`` rows and about ``size``
    bytes of a string column; a longer text makes a part of its own."""
    for b in batches:
        if b.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            stop = min(max(int(np.searchsorted(ends, before + size, side="right")), at + 1), at + rows)
            yield b.slice(at, stop - at)
            at = min(stop, b.num_rows)
