"""Whole batch (X7) over landed payloads derived from events; re-running a
run id leaves the same rows (load idempotence)."""
import datetime as dt

from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.plans import jobs, warehouse
from quotefuse.session import scratch_path
from quotefuse.sources import fixtures


def _pick(values, uid):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (uid % len(values) + 1).cast("int"))


def _land(spark, sf, root, binance_var=None):
    e = fixtures.quote_events(spark, sf)
    uid, v, txt = F.col("user_id"), F.col("value"), lambda c: c.cast("string")
    e.select(_pick(K.COINS_BINANCE, uid).alias("symbol"), txt(v).alias("lastPrice"),
             txt(F.col("prev")).alias("prevClosePrice"), txt(v * 0.99).alias("openPrice"),
             txt(v * 1.05).alias("highPrice"), txt(v * 0.95).alias("lowPrice"),
             txt(F.col("event_id") % 9 - 4 if binance_var is None else F.lit(binance_var)
                 ).alias("priceChangePercent"),
             txt(v * 1000).alias("quoteVolume"), txt(F.col("event_id")).alias("count")
             ).write.json(f"{root}/landing/binance")
    coins = ("btc", "eth", "bnb", "sol", "xrp", "ada", "doge", "dot")
    e.select(_pick(coins, uid).alias("symbol"), _pick(coins, uid).alias("name"),
             txt(v).alias("current_price"), txt(v * 1e9).alias("market_cap"),
             txt(v - F.col("prev")).alias("price_change_24h"),
             txt(F.col("event_id") % 9 - 4).alias("price_change_percentage_24h")
             ).write.json(f"{root}/landing/coingecko")
    yahoo = K.TICKERS_ACTIONS + K.TICKERS_INDICES + K.TICKERS_FR
    e.select(_pick(yahoo, uid).alias("ticker"), F.lit("").alias("currency"),
             txt(v).alias("last_price"), txt(v * 0.99).alias("previous_close"),
             F.when(F.col("event_type") == "error", "timeout").alias("error")
             ).write.json(f"{root}/landing/yahoo")
    full = F.to_json(F.struct(F.struct(F.lit("X").alias("Name"), F.struct(
        v.alias("c"), (v * 100).alias("v")).alias("qd"), F.struct((v * 0.99).alias("c")).alias("qv")
    ).alias("d")))
    e.select(_pick(K.SYMBOLES_BOURSORAMA, uid).alias("symbole"),
             F.when(F.col("event_id") % 9 == 0, F.lit("[]")).otherwise(full).alias("payload")
             ).write.json(f"{root}/landing/boursorama")


def test_run_all_twice_is_idempotent(spark, sf_small):
    root = scratch_path(spark, "jobs")
    _land(spark, sf_small, root)
    cfg = jobs.Config(root=root)
    ts = dt.datetime(2024, 2, 1, 10, 0, 0)
    first = jobs.run_all(spark, cfg, ts)
    second = jobs.run_all(spark, cfg, ts)
    assert first["load"] == second["load"]
    hist = warehouse.read_table(spark, f"{root}/dw", K.HISTORY_TABLE)
    assert hist.count() == first["load"][K.HISTORY_TABLE]
    s = jobs.read_silver(spark, cfg)
    assert s.groupBy("categorie", "ticker").count().where("count > 1").count() == 0
    rows = s.collect()
    crypto = [r.source for r in rows if r.categorie == "crypto"]
    assert crypto and set(crypto) == {K.LABEL_CRYPTO_FUSED}   # both sources land every coin
    fr = {r.ticker: r.source for r in rows if r.categorie == "action_fr"}
    assert fr.get("TTE.PA") in (K.LABEL_FR_FUSED, None)      # 1rPTTE remapped and fused
    assert first["quality"]["statut_global"] in ("OK", "WARN", "FAIL")
    doc = spark.read.text(f"{root}/logs/quality_report")
    assert doc.count() >= 3 and doc.where(F.col("value").contains('"couche":"silver"')).count() == 1


def test_source_subset(spark, sf_small):
    root = scratch_path(spark, "jobs-crypto")
    _land(spark, sf_small, root)
    cfg = jobs.Config(root=root, sources=("coingecko", "binance"))
    jobs.collect(spark, cfg, dt.datetime(2024, 2, 1))
    b = spark.read.parquet(f"{root}/bronze/crypto")
    assert {r.source for r in b.select("source").distinct().collect()} == {"coingecko", "binance"}


def test_subsets_have_their_own_snapshots(spark):
    """A subset leaves the snapshot of the whole collection alone, takes the index only with
    the crypto sources, and Silver and the checks read the runs of all of them."""
    root = scratch_path(spark, "subsets")
    spark.createDataFrame([("btc", "5", "2")], "symbol string, current_price string, price_change_percentage_24h string").write.json(
        f"{root}/landing/coingecko")
    spark.createDataFrame([("AAPL", "7", "6")], "ticker string, last_price string, previous_close string").write.json(f"{root}/landing/yahoo")
    spark.createDataFrame([('{"data": [{"value": "40", "value_classification": "Fear"}]}',)], "value string").write.text(f"{root}/landing/fear_greed")
    ts = dt.datetime(2024, 2, 1, 10)
    yahoo, crypto, every = (jobs.Config(root=root, sources=s) for s in (("yahoo",), ("binance", "coingecko"), jobs.SOURCES))
    assert "fear_greed_valeur" not in jobs.collect(spark, yahoo, ts)
    assert jobs.collect(spark, crypto, ts)["fear_greed_valeur"] == 40
    assert not warehouse.exists(spark, f"{root}/bronze/collecte_latest")
    jobs.silver(spark, every, ts)
    assert {r.ticker: r.fichier_source for r in jobs.read_silver(spark, every).collect()} == {
        "AAPL": "yahoo_20240201_100000.parquet", "BTC-USD": "crypto_20240201_100000.parquet"}
    jobs.collect(spark, every, ts + dt.timedelta(hours=1))
    jobs.silver(spark, every, ts + dt.timedelta(hours=1))
    assert {r.fichier_source for r in jobs.read_silver(spark, every).collect()} == {"collecte_20240201_110000.parquet"}
    rep = jobs.bronze_report(spark, every)
    assert {r.table_name for r in rep.select("table_name").distinct().collect()} == {
        "yahoo_20240201_100000.parquet", "crypto_20240201_100000.parquet", "collecte_20240201_110000.parquet"}
    assert rep.count() == jobs.bronze_report(spark, every).count()


def test_silver_job_with_everything_filtered(spark, sf_small):
    root = scratch_path(spark, "jobs-empty")
    _land(spark, sf_small, root, binance_var=500)   # every variation out of range
    cfg = jobs.Config(root=root, sources=("binance",))
    ts = dt.datetime(2024, 2, 2)
    jobs.collect(spark, cfg, ts)
    counts = jobs.silver(spark, cfg, ts)
    assert counts["nb_avant"] > 0 and counts["nb_apres"] == 0
    assert jobs.read_silver(spark, cfg).count() == 0      # empty latest replaces the old one
    gold = jobs.gold(spark, cfg, ts)
    assert gold["snapshot_marche"] == 1 and gold["top_mouvements"] == 0
    loaded = jobs.load(spark, cfg, ts)
    assert loaded[K.HISTORY_TABLE] == 0 and loaded["snapshot_marche"] == 1
    assert jobs.quality(spark, cfg, ts).collect()[0].statut_global in ("OK", "WARN", "FAIL")


def test_history_chart_is_oldest_first_with_fixed_ties(spark, sf_small):
    from quotefuse.operators import reports
    from quotefuse.plans import pipeline as P
    root = P.fixture_warehouse(spark, sf_small)
    got = reports.history_chart(spark, root, "T1.PA").collect()
    assert got and [r.date_collecte for r in got] == sorted(r.date_collecte for r in got)
    assert [tuple(r) for r in got] == [tuple(r) for r in reports.history_chart(spark, root, "T1.PA").repartition(3).orderBy(
        "inserted_at", "date_collecte", "prix", "variation_pct", "volume", "categorie", "source").collect()]
