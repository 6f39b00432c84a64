"""Gold KPIs over Silver.

Grouped KPIs aggregate partially on the map side, so the shuffle carries
one row per group per task whatever the skew. Top-k uses ``orderBy.limit``
(TakeOrderedAndProject: k rows per task, then one small merge). Every
ordering names its NULL placement and ends on the group key / ticker so
ties are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.functions.scalar import now_utc
from quotefuse.functions.scalar import round_half_away as rnd
from quotefuse.functions.scalar import run_text, ts_lit
from quotefuse.operators.quantile import median_of, middle_values


def _v() -> Column:
    return F.col("variation_pct")


def _flag(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): NULL on empty input, like SQL."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _ts_col(run_ts: _dt.datetime | Column | None) -> Column:
    if run_ts is None:
        return now_utc()
    return run_ts if isinstance(run_ts, Column) else ts_lit(run_ts)


def snapshot(silver: DataFrame, run_ts: _dt.datetime | Column | None = None) -> DataFrame:
    """Global market snapshot, one row even on empty input (A1). Reads Silver
    twice when called: all figures with the median's sketch, then its range."""
    v = F.col("_v")
    values = silver.select(F.col("variation_pct").cast("double").alias("_v"))
    found = middle_values(values, {
        "total_actifs": F.count(v), "actifs_en_hausse": _flag(v > 0), "actifs_en_baisse": _flag(v < 0),
        "actifs_neutres": _flag(v == 0), "_avg": F.avg(v), "_max": F.max(v), "_min": F.min(v)})
    found["_med"] = median_of(found)
    one = silver.sparkSession.range(1).select(*[
        F.lit(found[c]).cast("double" if c.startswith("_") else "long").alias(c)
        for c in ("total_actifs", "actifs_en_hausse", "actifs_en_baisse", "actifs_neutres", "_avg", "_max", "_min", "_med")])
    return one.select(
        run_text(_ts_col(run_ts)).alias("date_snapshot"),
        "total_actifs", "actifs_en_hausse", "actifs_en_baisse", "actifs_neutres",
        rnd(F.try_divide(F.lit(100.0) * F.col("actifs_en_hausse"), F.col("total_actifs")), 1)
        .alias("pct_marche_hausse"),
        rnd("_avg", 4).alias("variation_moyenne"),
        rnd("_med", 4).alias("variation_mediane"),
        rnd("_max", 2).alias("meilleure_variation"),
        rnd("_min", 2).alias("pire_variation"))


MOVER_COLUMNS = ("ticker", "nom", "prix", "variation_pct", "devise", "categorie", "source")


def _tie() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("ticker", "nom", "prix", "devise",
                                                  "categorie", "source")]


def top_movers(silver: DataFrame, n: int = K.TOP_N) -> DataFrame:
    """n largest and n smallest variations, labelled by list not by sign;
    a row can be in both when there are fewer than 2n rows (T1)."""
    base = silver.where(_v().isNotNull()).select(*MOVER_COLUMNS)
    up = base.orderBy(_v().desc(), *_tie()).limit(n).withColumn("type_mouvement", F.lit(K.MOVE_UP))
    down = base.orderBy(_v().asc(), *_tie()).limit(n).withColumn("type_mouvement", F.lit(K.MOVE_DOWN))
    # at most 2n rows: a single-partition sort, no range exchange
    return up.unionByName(down).coalesce(1).sortWithinPartitions(_v().desc(), *_tie())


def by_category(silver: DataFrame, sort: bool = True) -> DataFrame:
    """Per-category summary; NULL category is a group (A2)."""
    out = silver.groupBy("categorie").agg(
        F.count(F.lit(1)).alias("nb_actifs"),
        rnd(F.avg("prix"), 4).alias("prix_moyen"),
        rnd(F.avg(_v()), 4).alias("variation_moyenne"),
        rnd(F.max(_v()), 4).alias("variation_max"),
        rnd(F.min(_v()), 4).alias("variation_min"),
        _flag(_v() > 0).alias("nb_en_hausse"),
        _flag(_v() < 0).alias("nb_en_baisse"),
        rnd(F.sum("volume"), 2).alias("volume_total"),
        rnd(F.sum("capitalisation"), 2).alias("capitalisation_totale"))
    if sort:
        out = out.orderBy(F.col("nb_actifs").desc(), F.col("categorie").asc_nulls_last())
    return out


def by_currency(silver: DataFrame, sort: bool = True) -> DataFrame:
    """Per-currency summary (A3)."""
    out = silver.groupBy("devise").agg(
        F.count(F.lit(1)).alias("nb_actifs"),
        rnd(F.avg(_v()), 4).alias("variation_moyenne"),
        _flag(_v() > 0).alias("nb_en_hausse"),
        _flag(_v() < 0).alias("nb_en_baisse"))
    if sort:
        out = out.orderBy(F.col("nb_actifs").desc(), F.col("devise").asc_nulls_last())
    return out


def alerts(silver: DataFrame, threshold: float = K.ALERT_THRESHOLD, sort: bool = True) -> DataFrame:
    """|variation| >= threshold (inclusive), labelled by direction."""
    t = float(threshold)
    out = silver.where(F.abs(_v()) >= t).select(
        "ticker", "nom", rnd("prix", 4).alias("prix"),
        rnd(_v(), 4).alias("variation_pct"),
        F.when(_v() >= t, F.lit(K.ALERT_UP)).when(_v() <= -t, F.lit(K.ALERT_DOWN)).alias("niveau_alerte"),
        "categorie", "source", "devise")
    if sort:
        out = out.orderBy(F.col("variation_pct").desc_nulls_last(), *_tie())
    return out


def top_crypto(silver: DataFrame, n: int = K.TOP_N) -> DataFrame:
    """n largest market caps among cryptos with a cap."""
    cap = F.col("capitalisation")
    return (silver.where((F.col("categorie") == "crypto") & cap.isNotNull())
            .select("ticker", "nom", rnd("prix", 4).alias("prix"),
                    rnd(cap, 2).alias("capitalisation"),
                    rnd(_v(), 4).alias("variation_pct"),
                    rnd("volume", 2).alias("volume"))
            .orderBy(cap.desc(), *_tie()).limit(n))


def all_gold(silver: DataFrame, run_ts=None, n: int = K.TOP_N,
             threshold: float = K.ALERT_THRESHOLD, sort: bool = True) -> dict[str, DataFrame]:
    """The six KPIs. ``sort=False`` skips the presentation ORDER BY of the
    grouped/filtered tables — for writes into unordered tables, where the
    readers sort (saves a sampling job and a range shuffle per table)."""
    return {
        "snapshot_marche": snapshot(silver, run_ts),
        "top_mouvements": top_movers(silver, n),
        "resume_categorie": by_category(silver, sort),
        "resume_devise": by_currency(silver, sort),
        "alertes_prix": alerts(silver, threshold, sort),
        "top_cryptos_cap": top_crypto(silver, n),
    }
