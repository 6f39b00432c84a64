"""Scalar Column expressions (JVM-side, codegen-friendly; no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From 2**52 on a scaled double has no fraction left, so there is nothing to
# floor (which would also leave the BIGINT range); only the scaling remains.
_WHOLE = float(2**52)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: str | Column, n: int) -> Column:
    """ROUND(x, n) with ties away from zero on the scaled binary value.

    Spark's ``round`` rounds the decimal text of the double (1.005 -> 1.01);
    the SQL engines this pipeline is checked against scale first
    (1.005 -> 1.0). This expression scales first too.
    """
    x = col(c)
    m = F.lit(float(10 ** n))
    scaled = F.abs(x) * m
    # NULL and NaN pass through the arithmetic; a value whose scaling overflows stays
    whole = F.when(scaled < F.lit(_WHOLE), F.floor(scaled + F.lit(0.5)).cast("double")).otherwise(scaled)
    return F.when(scaled == F.lit(float("inf")), x).otherwise(F.signum(x) * whole / m)


def ts_lit(ts) -> Column:
    """A fixed wall-clock instant as TIMESTAMP_NTZ, independent of the session
    and Python time zones (a plain ``lit(datetime)`` is shifted by both)."""
    return F.to_timestamp_ntz(F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")),
                              F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL for a double column (missing is missing, D9)."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def to_double(c: str | Column, n: int | None = 4) -> Column:
    """float(v) rounded to n decimals, NULL when not a number (F1)."""
    d = col(c).try_cast("double")
    return d if n is None else round_half_away(d, n)


def to_long(c: str | Column) -> Column:
    """int(float(v)): truncation toward zero; NULL for junk, NaN, +-inf (F2)."""
    d = col(c).try_cast("double")
    bad = F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(None).cast("long")).otherwise(d.try_cast("long"))


def pct_change(p: str | Column, prev: str | Column, n: int = 2) -> Column:
    """round((p - prev) / prev * 100, n); NULL if prev is NULL/0 or p NULL."""
    p, prev = col(p), col(prev)
    ratio = F.try_divide(p - prev, F.when(prev != 0, prev))
    return round_half_away(ratio * F.lit(100.0), n)


def truthy_num(c: str | Column) -> Column:
    """Python truthiness of a number: not NULL and not zero."""
    x = col(c)
    return x.isNotNull() & (x != 0)


def is_missing(c: str | Column, dtype: str) -> Column:
    """pandas isna(): NULL, or NaN for floating columns (F16)."""
    x = col(c)
    if dtype in ("double", "float"):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def utc_ntz(ts: Column) -> Column:
    """The UTC wall clock of an instant, in any session time zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)"))


def now_utc() -> Column:
    return utc_ntz(F.current_timestamp())


# Stamps are cut from the text of a wall clock: formatting a TIMESTAMP_NTZ goes
# through the session zone and would move a time that the zone skips.

def run_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' (F4)."""
    return F.substring(ts.cast("string"), 1, 19)


def day_path(ts: Column) -> Column:
    """'yyyy/MM/dd' archive path."""
    return F.replace(F.substring(ts.cast("string"), 1, 10), F.lit("-"), F.lit("/"))


def day_stamp(ts: Column) -> Column:
    """'yyyyMMdd' (F5)."""
    return F.replace(F.substring(ts.cast("string"), 1, 10), F.lit("-"), F.lit(""))


def run_stamp(ts: Column) -> Column:
    """'yyyyMMdd_HHmmss' (F6)."""
    return F.replace(F.translate(F.substring(ts.cast("string"), 1, 19), "-:", ""), F.lit(" "), F.lit("_"))


def iso_text(ts: Column) -> Column:
    """ISO text with microseconds."""
    t = ts.cast("string")
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 8), F.lit("."),
                    F.rpad(F.substring(t, 21, 6), 6, "0"))
