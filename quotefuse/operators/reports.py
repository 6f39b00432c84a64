"""Dashboard queries over the warehouse.

Each report reads one run (default: the latest ``run_id``) or, with
``all_runs=True``, every run mixed as the original dashboard does. Filters
are Column parameters, never text formatted into SQL. NULL placement
follows PostgreSQL (DESC puts NULLs first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.functions.scalar import round_half_away as rnd
from quotefuse.plans.skipping import read_ticker
from quotefuse.plans.warehouse import LOADED_COL, RUN_COL, latest_run, read_table


def table(spark: SparkSession, root: str, name: str, run_id: str | None = None,
          all_runs: bool = False) -> DataFrame:
    """A table's rows of one run (default: the newest in the ledger, which may
    hold none), listing that run's files only, or of all runs."""
    if all_runs:
        return read_table(spark, root, name)
    run_id = run_id if run_id is not None else latest_run(spark, root, name)
    return read_table(spark, root, name, run_id if run_id is not None else "")


def _desc_pg(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def latest_snapshot(spark, root) -> DataFrame:
    """Most recent snapshot row."""
    s = read_table(spark, root, "snapshot_marche")
    return s.orderBy(F.col(LOADED_COL).desc_nulls_first(), F.col(RUN_COL).desc()).limit(1)


def market_sentiment(snap: DataFrame) -> DataFrame:
    """Share of rising assets as a gauge band and a delta to 50."""
    p = F.col("pct_marche_hausse")
    band = (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p < K.SENTIMENT_LOW, "rouge").when(p < K.SENTIMENT_HIGH, "orange")
            .otherwise("vert"))
    return snap.select("date_snapshot", p.alias("pct_marche_hausse"), band.alias("zone"),
                       (p - F.lit(K.SENTIMENT_REFERENCE)).alias("delta_reference"))


def prices_by_category(spark, root, categorie: str | None = None, run_id=None,
                       all_runs: bool = False) -> DataFrame:
    """History rows, optionally of one category, by variation desc (P10)."""
    h = table(spark, root, K.HISTORY_TABLE, run_id, all_runs)
    if categorie is not None:
        h = h.where(F.col("categorie") == F.lit(categorie))
    return h.orderBy(_desc_pg("variation_pct"), F.col("ticker").asc_nulls_last())


def movers_by_type(spark, root, type_mouvement: str = K.MOVE_UP, run_id=None,
                   all_runs: bool = False) -> DataFrame:
    """Top movers of one list."""
    t = table(spark, root, "top_mouvements", run_id, all_runs)
    return t.where(F.col("type_mouvement") == F.lit(type_mouvement))


def ticker_history(spark, root, ticker: str) -> DataFrame:
    """One ticker over all runs, newest first (P12); of the loads that are indexed
    only files that may hold it are opened (``plans/skipping.py``)."""
    return (read_ticker(spark, root, ticker)
            .select("ticker", "prix", "variation_pct", "volume", "date_collecte",
                    "categorie", "source", LOADED_COL)
            .orderBy(F.col(LOADED_COL).desc_nulls_first(), F.col("date_collecte").desc_nulls_first(), *_ties()))


def _ties() -> list[Column]:
    """Last sort keys: every other column, so equal times come in a fixed order."""
    return [F.col(c).asc_nulls_last() for c in ("prix", "variation_pct", "volume", "categorie", "source")]


def ticker_card(spark, root, ticker: str | None = None) -> DataFrame:
    """Latest price, latest variation and entry count per ticker.

    "Latest" is the newest load, then the newest collection time; the
    remaining columns break ties so the pick is deterministic. One partial
    aggregation per ticker: a hot ticker costs one row per task.
    """
    h = read_table(spark, root, K.HISTORY_TABLE) if ticker is None else read_ticker(spark, root, ticker)
    recency = F.struct(F.col(LOADED_COL), F.col("date_collecte"), F.col("prix"),
                       F.col("variation_pct"))
    return h.groupBy("ticker").agg(
        F.max_by(F.struct("prix", "variation_pct"), recency).alias("_last"),
        F.count(F.lit(1)).alias("nb_entrees")).select(
        "ticker", F.col("_last.prix").alias("prix_actuel"),
        F.col("_last.variation_pct").alias("variation_actuelle"), "nb_entrees")


def distinct_tickers(spark, root) -> DataFrame:
    """Sorted distinct tickers."""
    h = read_table(spark, root, K.HISTORY_TABLE)
    return h.select("ticker").distinct().orderBy(F.col("ticker").asc_nulls_last())


def crypto_totals(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    """Cryptos tracked, total cap in trillions, total volume in billions."""
    c = table(spark, root, "top_cryptos_cap", run_id, all_runs)
    a = c.agg(F.count(F.lit(1)).alias("nb_cryptos"),
              (F.sum("capitalisation") / F.lit(1e12)).alias("cap_totale_t"),
              (F.sum("volume") / F.lit(1e9)).alias("volume_total_b"))
    # report precision: 9 decimals keeps summation-order noise out of results
    return a.select("nb_cryptos", rnd("cap_totale_t", 9).alias("cap_totale_t"),
                    rnd("volume_total_b", 9).alias("volume_total_b"))


def alert_count(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    """Number of alert rows."""
    return table(spark, root, "alertes_prix", run_id, all_runs).agg(
        F.count(F.lit(1)).alias("nb_alertes"))


def report_categories(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    t = table(spark, root, "resume_categorie", run_id, all_runs)
    return (t.select("categorie", "nb_actifs", "variation_moyenne", "nb_en_hausse",
                     "nb_en_baisse", "volume_total")
            .orderBy(_desc_pg("nb_actifs"), F.col("categorie").asc_nulls_last()))


def report_currencies(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    t = table(spark, root, "resume_devise", run_id, all_runs)
    return t.orderBy(_desc_pg("nb_actifs"), F.col("devise").asc_nulls_last())


def report_movers(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    t = table(spark, root, "top_mouvements", run_id, all_runs)
    return t.orderBy(_desc_pg("variation_pct"), F.col("ticker").asc_nulls_last())


def report_alerts(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    t = table(spark, root, "alertes_prix", run_id, all_runs)
    return t.orderBy(_desc_pg("variation_pct"), F.col("ticker").asc_nulls_last())


def report_cryptos(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    t = table(spark, root, "top_cryptos_cap", run_id, all_runs)
    return t.orderBy(_desc_pg("capitalisation"), F.col("ticker").asc_nulls_last())


# --- chart orderings (T5) ----------------------------------------------------

def gainers_chart(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    """Rising list, ascending for a horizontal bar chart."""
    return movers_by_type(spark, root, K.MOVE_UP, run_id, all_runs).orderBy(
        F.col("variation_pct").asc_nulls_last(), F.col("ticker").asc_nulls_last())


def losers_chart(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    """Falling list, descending."""
    return movers_by_type(spark, root, K.MOVE_DOWN, run_id, all_runs).orderBy(
        _desc_pg("variation_pct"), F.col("ticker").asc_nulls_last())


def crypto_by_volume(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    """Top cryptos by 24h volume, ascending."""
    return table(spark, root, "top_cryptos_cap", run_id, all_runs).orderBy(
        F.col("volume").asc_nulls_last(), F.col("ticker").asc_nulls_last())


def history_chart(spark, root, ticker: str) -> DataFrame:
    """One ticker's history, oldest first, for a line chart."""
    return ticker_history(spark, root, ticker).orderBy(
        F.col(LOADED_COL).asc_nulls_last(), F.col("date_collecte").asc_nulls_last(), *_ties())


def alerts_chart(spark, root, run_id=None, all_runs: bool = True) -> DataFrame:
    """Alerts by variation, ascending for a horizontal bar chart."""
    return table(spark, root, "alertes_prix", run_id, all_runs).orderBy(
        F.col("variation_pct").asc_nulls_last(), F.col("ticker").asc_nulls_last())
