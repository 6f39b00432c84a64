"""Landed provider payloads -> canonical quote rows.

Network fetching is out of scope: payloads are landed as JSON files (or a
text column, e.g. from a message bus) and parsed with explicit schemas —
every provider number arrives as text and goes through ``try_cast``, so a
junk field gives NULL for that field only. One projection per provider;
the instrument dimension is a join Spark plans (AQE broadcasts it when its
measured size allows).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotefuse import constants as K
from quotefuse.functions.scalar import (now_utc, pct_change, run_text, to_double, to_long, truthy_num,
                                         ts_lit)
from quotefuse.schemas import RAW_QUOTE

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def _st(*names: str, t=S) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n in names])


BINANCE_ITEM = _st("symbol", "lastPrice", "prevClosePrice", "openPrice", "highPrice",
                   "lowPrice", "priceChangePercent", "quoteVolume", "bidPrice", "askPrice",
                   "count")
COINGECKO_ITEM = T.StructType(
    [T.StructField("symbol", S), T.StructField("name", S)]
    + [T.StructField(n, S) for n in (
        "current_price", "price_change_24h", "high_24h", "low_24h",
        "price_change_percentage_24h", "price_change_percentage_1h_in_currency",
        "price_change_percentage_7d_in_currency", "ath", "circulating_supply",
        "total_volume", "market_cap", "market_cap_rank")])
_QUOTE = _st("d", "o", "h", "l", "c", "v")
BOURSORAMA_PAYLOAD = T.StructType([T.StructField("d", T.StructType([
    T.StructField("Name", S), T.StructField("SymbolId", S),
    T.StructField("qd", _QUOTE), T.StructField("qv", _QUOTE)]))])
YAHOO_RECORD = _st("ticker", "currency", "last_price", "previous_close", "open", "day_high",
                   "day_low", "last_volume", "market_cap", "error")
FEAR_GREED = T.StructType([T.StructField("data", T.ArrayType(
    _st("value", "value_classification")))])


def _now(run_ts: _dt.datetime | Column | None) -> Column:
    if run_ts is None:
        return run_text(now_utc())
    return run_text(run_ts if isinstance(run_ts, Column) else ts_lit(run_ts))


def conform(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project onto RAW_QUOTE (missing fields NULL, typed) plus ``keep``."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                              .alias(f.name) for f in RAW_QUOTE.fields])


CORRUPT = "_qf_corrupt"


def read_landed(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Landed JSON (lines, or with ``multiline`` top-level arrays) -> one row
    per item; text that cannot be read is kept in ``CORRUPT``."""
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, S)]))
            .option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def unreadable(items: DataFrame, symbol_col: str, source: str, run_ts=None) -> DataFrame:
    """Error rows of the items that could not be read."""
    return conform(items.where(F.col(CORRUPT).isNotNull()).select(
        F.col(symbol_col).alias("ticker"), F.lit(source).alias("source"),
        F.lit(K.STATUS_ERROR).alias("statut"),
        F.concat(F.lit(K.MSG_JSON), F.substring(CORRUPT, 1, 200)).alias("erreur_msg"),
        _now(run_ts).alias("collecte_le")))


def items_from_text(df: DataFrame, text_col: str, schema: T.StructType) -> DataFrame:
    """A text column holding one JSON object per row -> item columns."""
    parsed = F.from_json(F.col(text_col), schema)
    rest = [c for c in df.columns if c != text_col]
    return df.select(*rest, parsed.alias("_p")).select(*rest, "_p.*")


def parse_binance(items: DataFrame, symbols: Iterable[str] | DataFrame | None = K.COINS_BINANCE,
                  run_ts=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """24h ticker items: keep configured symbols, 'USDT' -> '-USD' (S4)."""
    if isinstance(symbols, DataFrame):
        items = items.join(symbols.select(F.col(symbols.columns[0]).alias("symbol")),
                           "symbol", "left_semi")
    elif symbols is not None:
        items = items.where(F.col("symbol").isin(*list(symbols)))
    out = items.select(
        *keep,
        F.replace(F.col("symbol"), F.lit("USDT"), F.lit("-USD")).alias("ticker"),
        F.lit("").alias("nom"),
        to_double("lastPrice").alias("prix"),
        to_double("openPrice").alias("ouverture"),
        to_double("highPrice").alias("haut"),
        to_double("lowPrice").alias("bas"),
        to_double("prevClosePrice").alias("cloture_veille"),
        to_double("priceChangePercent").alias("variation_pct"),
        to_long("quoteVolume").alias("volume"),
        to_double("bidPrice").alias("bid"),
        to_double("askPrice").alias("ask"),
        to_long("count").alias("nb_trades_24h"),
        F.lit("USD").alias("devise"), F.lit("crypto").alias("categorie"),
        F.lit(K.SRC_BINANCE).alias("source"), F.lit(K.STATUS_OK).alias("statut"),
        _now(run_ts).alias("collecte_le"))
    return conform(out, keep)


def parse_coingecko(items: DataFrame, run_ts=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Markets items: 'SYM-USD', previous close from the 24h change."""
    prix = F.col("current_price").try_cast("double")
    chg = F.coalesce(F.col("price_change_24h").try_cast("double"), F.lit(0.0))
    out = items.select(
        *keep,
        F.concat(F.upper(F.col("symbol")), F.lit("-USD")).alias("ticker"),
        F.col("name").alias("nom"),
        prix.alias("prix"),
        F.col("high_24h").try_cast("double").alias("haut"),
        F.col("low_24h").try_cast("double").alias("bas"),
        F.when(truthy_num(prix), to_double(prix - chg)).alias("cloture_veille"),
        to_double("price_change_percentage_24h").alias("variation_pct"),
        to_double("price_change_percentage_1h_in_currency").alias("variation_1h"),
        to_double("price_change_percentage_7d_in_currency").alias("variation_7j"),
        to_long("total_volume").alias("volume"),
        to_long("market_cap").alias("market_cap"),
        F.col("market_cap_rank").try_cast("int").alias("rang"),
        F.col("ath").try_cast("double").alias("ath"),
        F.col("circulating_supply").try_cast("double").alias("supply"),
        F.lit("USD").alias("devise"), F.lit("crypto").alias("categorie"),
        F.lit(K.SRC_COINGECKO).alias("source"), F.lit(K.STATUS_OK).alias("statut"),
        _now(run_ts).alias("collecte_le"))
    return conform(out, keep)


def parse_boursorama(df: DataFrame, symbol_col: str = "symbole", text_col: str = "payload",
                     run_ts=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """End-of-day payload per requested symbol.

    ``[]`` / empty, a missing ``d`` or a missing/empty ``qd`` give an error
    row (ticker, source, statut='erreur', erreur_msg, collecte_le only).
    """
    raw = F.col(text_col)
    p = F.from_json(raw, BOURSORAMA_PAYLOAD)
    d, qd, qv = p["d"], p["d"]["qd"], p["d"]["qv"]
    # ``if not qd``: absent, or present with no field set
    qd_empty = qd.isNull() | F.coalesce(*[qd[f] for f in ("d", "o", "h", "l", "c", "v")]).isNull()
    blank = raw.isNull() | F.trim(raw).isin("", "[]", "{}", "null") | F.trim(raw).startswith("[")
    err = (F.when(blank, F.lit(K.MSG_BOURSO_EMPTY))
           .when(d.isNull(), F.concat(F.lit(K.MSG_BOURSO_NO_D + " : "), F.substring(raw, 1, 200)))
           .when(qd_empty, F.lit(K.MSG_BOURSO_NO_QD)))
    prix, prev = to_double(qd["c"]), to_double(qv["c"])
    ok = err.isNull()
    out = df.select(
        *keep,
        F.col(symbol_col).alias("ticker"),
        F.when(ok, F.coalesce(d["Name"], F.lit(""))).alias("nom"),
        F.when(ok, prix).alias("prix"),
        F.when(ok, to_double(qd["o"])).alias("ouverture"),
        F.when(ok, to_double(qd["h"])).alias("haut"),
        F.when(ok, to_double(qd["l"])).alias("bas"),
        F.when(ok, prev).alias("cloture_veille"),
        F.when(ok & truthy_num(prix) & truthy_num(prev), pct_change(prix, prev)).alias("variation_pct"),
        F.when(ok, to_long(qd["v"])).alias("volume"),
        F.when(ok, F.lit("EUR")).alias("devise"),
        F.when(ok, F.lit("action_fr")).alias("categorie"),
        F.lit(K.SRC_BOURSORAMA).alias("source"),
        F.when(ok, F.lit(K.STATUS_OK)).otherwise(F.lit(K.STATUS_ERROR)).alias("statut"),
        err.alias("erreur_msg"),
        _now(run_ts).alias("collecte_le"))
    return conform(out, keep)


def parse_yahoo(records: DataFrame, dim: DataFrame, run_ts=None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Quote records joined to the (ticker, categorie) list they were
    requested from (S7); a record with ``error`` set is an error row that
    keeps its category. A ticker outside the list keeps its row with a NULL
    category (it fuses with the unknown categories)."""
    r = records.join(dim.select("ticker", "categorie"), "ticker", "left")
    prix, prev = to_double("last_price"), to_double("previous_close")
    ok = F.col("error").isNull()
    out = r.select(
        *keep,
        "ticker",
        F.when(ok, F.lit("")).alias("nom"),
        F.when(ok, prix).alias("prix"),
        F.when(ok, to_double("open")).alias("ouverture"),
        F.when(ok, to_double("day_high")).alias("haut"),
        F.when(ok, to_double("day_low")).alias("bas"),
        F.when(ok, prev).alias("cloture_veille"),
        F.when(ok, pct_change(prix, prev)).alias("variation_pct"),
        F.when(ok, to_long("last_volume")).alias("volume"),
        F.when(ok, to_long("market_cap")).alias("market_cap"),
        F.when(ok, F.coalesce(F.nullif(F.col("currency"), F.lit("")), F.lit("USD"))).alias("devise"),
        "categorie",
        F.lit(K.SRC_YAHOO).alias("source"),
        F.when(ok, F.lit(K.STATUS_OK)).otherwise(F.lit(K.STATUS_ERROR)).alias("statut"),
        F.col("error").alias("erreur_msg"),
        _now(run_ts).alias("collecte_le"))
    return conform(out, keep)


def parse_fear_greed(df: DataFrame, text_col: str = "payload") -> DataFrame:
    """First element's integer value and label; unusable payloads give no row."""
    first = F.get(F.from_json(F.col(text_col), FEAR_GREED)["data"], 0)
    v = first["value"].try_cast("int")
    return (df.select(v.alias("fear_greed_valeur"),
                      first["value_classification"].alias("fear_greed_label"))
            .where(F.col("fear_greed_valeur").isNotNull()
                   & F.col("fear_greed_label").isNotNull()))


def instruments(spark: SparkSession) -> DataFrame:
    """Configured (ticker, categorie) list: a fixed, tiny dimension."""
    rows = ([(t, "action") for t in K.TICKERS_ACTIONS] + [(t, "indice") for t in K.TICKERS_INDICES]
            + [(t, "action_fr") for t in K.TICKERS_FR])
    return F.broadcast(spark.createDataFrame(rows, "ticker string, categorie string"))
