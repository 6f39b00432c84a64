"""

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the
driver tables (through the ``events`` adapter), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.functions import scalar
from quotefuse.operators import clean, collect, fuse, kpis, normalize, quality, reports
from quotefuse.plans import catalog, fusion_state, jobs, ledger, run_state, warehouse
from quotefuse.plans import pipeline as P
from quotefuse.schemas import BRONZE_COLUMNS, NUMERIC_COLUMNS
from quotefuse.session import scratch_path
from quotefuse.sources import bronze, fixtures, payloads
from quotefuse.streaming import ticks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _b(spark, sf, prev=True):
    return fixtures.bronze_ev(spark, sf, prev).drop("ts")


def _prix_double(df: DataFrame) -> DataFrame:
    return df.withColumn("prix", F.col("prix").try_cast("double"))


# --- normalisation (P1-P4) ---------------------------------------------------

@register("normalize_columns")
def q_normalize_columns(spark, sf):
    df = normalize.columns(fixtures.raw_alias_ev(spark, sf))
    return _prix_double(df.select("event_id", *BRONZE_COLUMNS))


@register("map_tickers")
def q_map_tickers(spark, sf):
    return normalize.tickers(_b(spark, sf, prev=False)).select("event_id", "ticker", "devise")


@register("map_tickers_table")
def q_map_tickers_table(spark, sf):
    """A mapping of every traded symbol, some of them twice, joined rather than spelled out."""
    ev = fixtures.events(spark, sf)
    symbol = F.col("user_id").cast("string")
    mapping = ev.where("user_id % 7 <> 0").select(
        F.concat(F.lit("T"), symbol).alias("alias"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("M"), symbol, F.lit(".PA"))).when(
            F.col("event_type") != "error", F.concat(F.lit("N"), symbol)).alias("ticker"))
    quotes = normalize.tickers(_b(spark, sf, prev=False), mapping, broadcast_rows=1_000)
    return quotes.select("event_id", "ticker", "devise")


@register("ensure_columns")
def q_ensure_columns(spark, sf):
    df = normalize.ensure(_b(spark, sf).drop("devise", "capitalisation", "statut"))
    return _prix_double(df.select("event_id", *BRONZE_COLUMNS))


# --- cleaning (P5-P7, A17) ---------------------------------------------------

@register("cast_types")
def q_cast_types(spark, sf):
    return clean.cast_types(_b(spark, sf), keep=("event_id",))


@register("clean_filter")
def q_clean_filter(spark, sf):
    return clean.valid(clean.cast_types(_b(spark, sf), keep=("event_id",)))


@register("normalize_currency")
def q_normalize_currency(spark, sf):
    return (clean.currency(clean.cast_types(_b(spark, sf, prev=False), keep=("event_id",)))
            .select("event_id", "ticker", "devise"))


@register("clean_counts")
def q_clean_counts(spark, sf):
    return clean.counts(clean.cast_types(_b(spark, sf)))


# --- fusion (J1-J6) -----------------------------------------------------------

def _fused(spark, sf, families=None):
    df = normalize.tickers(_b(spark, sf))
    out = fuse.fuse(df, "event_id", keep_order=True, families=families).drop("event_id")
    return clean.cast_types(out.withColumnRenamed(fuse.ORD, "event_id"), keep=("event_id",))


@register("fuse_crypto")
def q_fuse_crypto(spark, sf):
    return _fused(spark, sf, ("crypto",))


@register("fuse_equity_fr")
def q_fuse_equity_fr(spark, sf):
    return _fused(spark, sf, ("action_fr",))


@register("fuse_preferred")
def q_fuse_preferred(spark, sf):
    return _fused(spark, sf, ("action", "indice"))


@register("fuse_other")
def q_fuse_other(spark, sf):
    return _fused(spark, sf, (None,))


@register("fuse_all")
def q_fuse_all(spark, sf):
    return _fused(spark, sf)


@register("dedup_first")
def q_dedup_first(spark, sf):
    df = clean.cast_types(_b(spark, sf), keep=("event_id",))
    return fuse.dedup_first(df, "event_id")


@register("silver_pipeline")
def q_silver_pipeline(spark, sf):
    return P.silver_ev(spark, sf)


# --- gold (A1-A3, T1, T2, P9) over unfused clean rows --------------------------

@register("market_snapshot")
def q_market_snapshot(spark, sf):
    return kpis.snapshot(P.clean_ev(spark, sf), fixtures.SNAPSHOT_TS)


@register("top_movers")
def q_top_movers(spark, sf):
    return kpis.top_movers(P.clean_ev(spark, sf))


@register("category_summary")
def q_category_summary(spark, sf):
    return kpis.by_category(P.clean_ev(spark, sf))


@register("currency_summary")
def q_currency_summary(spark, sf):
    return kpis.by_currency(P.clean_ev(spark, sf))


@register("price_alerts")
def q_price_alerts(spark, sf):
    return kpis.alerts(P.clean_ev(spark, sf))


@register("top_crypto_cap")
def q_top_crypto_cap(spark, sf):
    return kpis.top_crypto(P.clean_ev(spark, sf))


# --- data quality (A10-A16) ----------------------------------------------------

def _dq_input(spark, sf, prev=True):
    return clean.cast_types(_b(spark, sf, prev))


@register("dq_completeness")
def q_dq_completeness(spark, sf):
    return quality.report(_dq_input(spark, sf), "bronze_ev", "bronze", ["completude"])


@register("dq_coherence")
def q_dq_coherence(spark, sf):
    return quality.report(_dq_input(spark, sf), "bronze_ev", "bronze", ["coherence"])


@register("dq_validity")
def q_dq_validity(spark, sf):
    return quality.report(_dq_input(spark, sf), "bronze_ev", "bronze", ["validite"])


@register("dq_duplicates")
def q_dq_duplicates(spark, sf):
    return quality.duplicates(_dq_input(spark, sf, prev=False))


@register("dq_bronze_by_file")
def q_dq_bronze_by_file(spark, sf):
    return quality.report(_dq_input(spark, sf), None, "bronze", by="fichier_source")


@register("dq_global_status")
def q_dq_global_status(spark, sf):
    # the summary counts Silver only, so only that layer is built
    return quality.global_status(quality.report(P.silver_ev(spark, sf), "silver", "silver"))


# --- warehouse (K5-K7, A14) ----------------------------------------------------

def _wh(spark, sf):
    return P.fixture_warehouse(spark, sf)


@register("dw_append_gold")
def q_dw_append_gold(spark, sf):
    root = _wh(spark, sf)
    parts = [warehouse.read_table(spark, root, t).groupBy(warehouse.RUN_COL)
             .agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(t).alias("table_name"), "*")
             for t in K.GOLD_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dw_append_history")
def q_dw_append_history(spark, sf):
    return warehouse.read_table(spark, _wh(spark, sf), K.HISTORY_TABLE)


@register("dw_load_counts")
def q_dw_load_counts(spark, sf):
    root = _wh(spark, sf)
    latest = fixtures.RUN_IDS[1]
    parts = [warehouse.read_table(spark, root, t).where(F.col(warehouse.RUN_COL) == latest)
             .agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(t).alias("table_name"), "nb_lignes")
             for t in K.DW_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_warehouse")
def q_dq_warehouse(spark, sf):
    return quality.warehouse_checks(spark, _wh(spark, sf))


# --- reports (P10-P15, A6-A9, T3-T4) -------------------------------------------

@register("latest_snapshot")
def q_latest_snapshot(spark, sf):
    return reports.latest_snapshot(spark, _wh(spark, sf))


@register("market_sentiment")
def q_market_sentiment(spark, sf):
    return reports.market_sentiment(reports.latest_snapshot(spark, _wh(spark, sf)))


@register("prices_by_category")
def q_prices_by_category(spark, sf):
    return reports.prices_by_category(spark, _wh(spark, sf), "crypto")


@register("movers_by_type")
def q_movers_by_type(spark, sf):
    return reports.movers_by_type(spark, _wh(spark, sf), K.MOVE_DOWN, all_runs=True)


@register("ticker_history")
def q_ticker_history(spark, sf):
    return reports.ticker_history(spark, _wh(spark, sf), "T1.PA")


@register("ticker_history_indexed")
def q_ticker_history_indexed(spark, sf):
    """Through the index by ticker: one run indexed, the other loaded again since."""
    return reports.ticker_history(spark, P.indexed_warehouse(spark, sf), "T1.PA")


@register("ticker_card")
def q_ticker_card(spark, sf):
    return reports.ticker_card(spark, _wh(spark, sf))


@register("distinct_tickers")
def q_distinct_tickers(spark, sf):
    return reports.distinct_tickers(spark, _wh(spark, sf))


@register("crypto_totals")
def q_crypto_totals(spark, sf):
    return reports.crypto_totals(spark, _wh(spark, sf))


@register("alert_count")
def q_alert_count(spark, sf):
    return reports.alert_count(spark, _wh(spark, sf))


@register("report_categories")
def q_report_categories(spark, sf):
    return reports.report_categories(spark, _wh(spark, sf))


@register("report_currencies")
def q_report_currencies(spark, sf):
    return reports.report_currencies(spark, _wh(spark, sf))


@register("report_movers")
def q_report_movers(spark, sf):
    return reports.report_movers(spark, _wh(spark, sf))


@register("report_alerts")
def q_report_alerts(spark, sf):
    return reports.report_alerts(spark, _wh(spark, sf))


@register("report_cryptos")
def q_report_cryptos(spark, sf):
    return reports.report_cryptos(spark, _wh(spark, sf))


# --- sources: landed payloads (S4-S8), Bronze CSV scan (S1) -------------------

def _items(df, schema):
    return payloads.items_from_text(df, "payload", schema)


@register("parse_binance")
def q_parse_binance(spark, sf):
    items = _items(fixtures.binance_items(spark, sf), payloads.BINANCE_ITEM)
    return payloads.parse_binance(items, None, fixtures.SNAPSHOT_TS, keep=("event_id",))


@register("parse_coingecko")
def q_parse_coingecko(spark, sf):
    items = _items(fixtures.coingecko_items(spark, sf), payloads.COINGECKO_ITEM)
    return payloads.parse_coingecko(items, fixtures.SNAPSHOT_TS, keep=("event_id",))


@register("parse_boursorama")
def q_parse_boursorama(spark, sf):
    return payloads.parse_boursorama(fixtures.boursorama_payloads(spark, sf),
                                     run_ts=fixtures.SNAPSHOT_TS, keep=("event_id",))


@register("parse_yahoo")
def q_parse_yahoo(spark, sf):
    return payloads.parse_yahoo(fixtures.yahoo_records(spark, sf),
                                fixtures.yahoo_dimension(spark, sf), fixtures.SNAPSHOT_TS,
                                keep=("event_id",))


@register("parse_fear_greed")
def q_parse_fear_greed(spark, sf):
    return payloads.parse_fear_greed(fixtures.fear_greed_payloads(spark, sf))


def _landed_csv(spark, sf, scan) -> DataFrame:
    """bronze_ev landed as CSV files of two column orders in ONE folder, with
    commas, quotes and line breaks in the names, then scanned back as Bronze
    (all text, NA tokens -> NULL, file-tagged)."""
    b = _b(spark, sf).withColumn("nom", _awkward_name())
    root = scratch_path(spark, "landing")
    cols = b.columns
    for run, order in ((0, cols), (1, list(reversed(cols)))):
        P.run_split(b, run).select(*order).write.mode("append").option("header", "true").option("escape", '"').csv(f"{root}/lots")
    scanned = scan(spark, [f"{root}/lots", f"{root}/absent"])
    num = set(NUMERIC_COLUMNS) | {"event_id"}
    return scanned.select(
        F.col("event_id").try_cast("long").alias("event_id"),
        *[(F.col(c).try_cast("double") if c in num else F.col(c)).alias(c)
          for c in BRONZE_COLUMNS if c != "fichier_source"],
        F.col("fichier_source").endswith(".csv").alias("fichier_csv"))


def _awkward_name():
    e, n = F.col("event_id"), F.col("nom")
    return (F.when(e % 3 == 0, F.concat(n, F.lit(', dit "le gros"'))).when(e % 3 == 1, F.concat(n, F.lit("\nsuite")))
            .otherwise(n))


# --- collection (U1, U2, A4, A5, P13) ----------------------------------------------

def _source_frames(spark, sf, prev=True):
    b = _prix_double(_b(spark, sf, prev))
    src = F.col("source")
    return {
        "yahoo": b.where(src == K.SRC_YAHOO).drop("capitalisation"),
        "coingecko": b.where(src == K.SRC_COINGECKO).drop("volume"),
        "binance": b.where(src == K.SRC_BINANCE).drop("nom"),
        "boursorama": b.where(src == K.SRC_BOURSORAMA).drop("capitalisation", "categorie"),
    }


@register("bronze_scan")
def q_bronze_scan(spark, sf):
    return _landed_csv(spark, sf, bronze.scan_bronze)


@register("bronze_scan_split")
def q_bronze_scan_split(spark, sf):
    """The same files read split by split."""
    return _landed_csv(spark, sf, bronze.scan_split)


@register("collect_union")
def q_collect_union(spark, sf):
    return collect.union_sources(_source_frames(spark, sf).values())


@register("collect_union_crypto")
def q_collect_union_crypto(spark, sf):
    f = _source_frames(spark, sf)
    return collect.union_sources([f["coingecko"], f["binance"]])


@register("collect_summary")
def q_collect_summary(spark, sf):
    return collect.summary(collect.union_sources(_source_frames(spark, sf, prev=False).values()))


@register("count_by_source")
def q_count_by_source(spark, sf):
    return collect.value_counts(P.clean_ev(spark, sf), "source")


@register("count_by_category")
def q_count_by_category(spark, sf):
    return collect.value_counts(P.clean_ev(spark, sf), "categorie")


# --- scalar functions (F1-F3), archive (K10) -------------------------------------

@register("scalar_conversions")
def q_scalar_conversions(spark, sf):
    b = _b(spark, sf)
    p = F.col("prix").try_cast("double")
    return b.select("event_id", scalar.to_double("prix", 4).alias("prix_arrondi"),
                    scalar.to_long("prix").alias("prix_entier"),
                    scalar.pct_change(p, F.col("prix_ouv")).alias("variation"))


@register("archive_partitions")
def q_archive_partitions(spark, sf):
    rows = P.clean_ev(spark, sf)
    day = F.to_timestamp(F.col("date_collecte"))
    archived = warehouse.archive(rows, scratch_path(spark, "archive"), ts_col=day)
    return archived.groupBy("annee", "mois", "jour").agg(F.count(F.lit(1)).alias("nb"))


# --- tick stream (R1-R4, K8, K9) as batch over the same functions ------------------

def _ticks(spark, sf):
    m = fixtures.tick_messages(spark, sf)
    return ticks.parse_ticks(m, ts=F.col("timestamp"))


@register("tick_parse")
def q_tick_parse(spark, sf):
    return _ticks(spark, sf)


@register("tick_to_kafka_value")
def q_tick_to_kafka_value(spark, sf):
    return ticks.to_kafka(_ticks(spark, sf))


@register("tick_read")
def q_tick_read(spark, sf):
    return ticks.read_ticks(ticks.to_kafka(_ticks(spark, sf)))


@register("tick_alerts")
def q_tick_alerts(spark, sf):
    return ticks.alerts(_ticks(spark, sf))


@register("tick_daily_counts")
def q_tick_daily_counts(spark, sf):
    return ticks.daily_counts(_ticks(spark, sf))


# --- large values, empty reloads, chart orderings, archive counts -------------------

@register("round_large")
def q_round_large(spark, sf):
    """ROUND on values up to 1e18, at 0 to 4 decimals."""
    e = fixtures.events(spark, sf)
    x = F.col("value") * F.pow(F.lit(10.0), (F.col("event_id") % 17).cast("double"))
    return e.select("event_id", *[scalar.round_half_away(x, n).alias(f"r{n}") for n in range(5)])


@register("dw_reload_empty")
def q_dw_reload_empty(spark, sf):
    """Two runs of alerts loaded, the first one again without a row: what is left per run."""
    root = scratch_path(spark, "reload")
    rows = kpis.alerts(P.clean_ev(spark, sf), sort=False)
    for run, ts in zip(fixtures.RUN_IDS, fixtures.RUN_TS):
        warehouse.load_table(rows, root, "alertes_prix", run, ts)
    warehouse.load_table(rows.limit(0), root, "alertes_prix", fixtures.RUN_IDS[0], fixtures.RUN_TS[0])
    return warehouse.read_table(spark, root, "alertes_prix").groupBy(warehouse.RUN_COL).agg(F.count(F.lit(1)).alias("nb"))


@register("report_chart_gainers")
def q_chart_gainers(spark, sf):
    return reports.gainers_chart(spark, _wh(spark, sf)).select("ticker", "variation_pct", warehouse.RUN_COL)


@register("report_chart_losers")
def q_chart_losers(spark, sf):
    return reports.losers_chart(spark, _wh(spark, sf)).select("ticker", "variation_pct", warehouse.RUN_COL)


@register("report_chart_alerts")
def q_chart_alerts(spark, sf):
    return reports.alerts_chart(spark, _wh(spark, sf)).select("ticker", "variation_pct", warehouse.RUN_COL)


@register("report_chart_cryptos")
def q_chart_cryptos(spark, sf):
    return reports.crypto_by_volume(spark, _wh(spark, sf)).select("ticker", "volume", warehouse.RUN_COL)


@register("fear_greed_collect")
def q_fear_greed_collect(spark, sf):
    """The index payloads landed as lines and collected as a run's snapshot."""
    root = scratch_path(spark, "fear-greed")
    fixtures.fear_greed_payloads(spark, sf).select("payload").write.text(f"{root}/landing/fear_greed")
    jobs.fear_greed(spark, jobs.Config(root=root), fixtures.SNAPSHOT_TS)
    return spark.read.parquet(f"{root}/bronze/fear_greed_latest").groupBy("fear_greed_valeur", "fear_greed_label").agg(
        F.count(F.lit(1)).alias("nb"))


@register("archive_counts")
def q_archive_counts(spark, sf):
    """Two snapshots archived under the run's day, a third one absent: the
    archive's rows and the counts of the step."""
    root = scratch_path(spark, "archive-run")
    rows = P.clean_ev(spark, sf)
    for run in (0, 1):
        P.run_split(rows, run).write.parquet(f"{root}/zone/run{run}")
    done = warehouse.archive_files(spark, [f"{root}/zone/run{i}" for i in range(3)], f"{root}/archive", fixtures.SNAPSHOT_TS)
    kept = spark.read.option("recursiveFileLookup", "true").schema(rows.schema).parquet(
        f"{root}/archive/{fixtures.SNAPSHOT_TS:%Y/%m/%d}")
    return kept.agg(F.count(F.lit(1)).alias("nb_lignes")).select(
        "nb_lignes", *[F.lit(v).cast("long").alias(k) for k, v in done.items()])


# --- ledger and SQL over the catalog (P10, P11, K4-K7, S10) ---------------------------

@register("dw_latest_empty")
def q_dw_latest_empty(spark, sf):
    """Two runs of alerts and a third one without any: the newest run, what the
    default report shows of it, and the rows of all runs."""
    root = scratch_path(spark, "latest-empty")
    rows = kpis.alerts(P.clean_ev(spark, sf), sort=False)
    for run, ts in zip(fixtures.RUN_IDS, fixtures.RUN_TS):
        warehouse.load_table(rows, root, "alertes_prix", run, ts)
    warehouse.load_table(rows.limit(0), root, "alertes_prix", "20240201_000000", fixtures.RUN_TS[1])
    shown = reports.report_alerts(spark, root, all_runs=False).select(F.lit(1).alias("d"), F.lit(0).alias("t"))
    every = reports.report_alerts(spark, root).select(F.lit(0).alias("d"), F.lit(1).alias("t"))
    return shown.unionByName(every).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("d", "nb_dernier"), ("t", "nb_tous"))]).select(
        F.lit(warehouse.latest_run(spark, root, "alertes_prix")).alias("run_id"), "nb_dernier", "nb_tous")


@register("dw_ledger")
def q_dw_ledger(spark, sf):
    return ledger.frame(spark, _wh(spark, sf)).select("table_name", "run_id", "nb_lignes")


def _ask(name: str, **args) -> Query:
    def run(spark, sf):
        return catalog.ask(spark, catalog.register(spark, _wh(spark, sf)), name, **args)
    return run


for _name, _args in (("apercu", {}), ("categories", {}), ("prix_categorie", {"categorie": "crypto"}), ("mouvements", {}),
                     ("devises", {}), ("cryptos", {}), ("alertes", {}), ("tickers", {}), ("historique", {"ticker": "T1.PA"})):
    register(f"sql_{_name}")(_ask(_name, **_args))


@register("sql_dernier_run")
def q_sql_dernier_run(spark, sf):
    """A question of the user's own over the views of the newest run."""
    return catalog.query(spark, catalog.register(spark, _wh(spark, sf)), """
        SELECT a.categorie, count(*) AS nb_alertes, max(c.nb_actifs) AS nb_actifs
        FROM alertes_prix_dernier a LEFT JOIN resume_categorie_dernier c ON c.categorie <=> a.categorie
        WHERE abs(a.variation_pct) >= :seuil GROUP BY a.categorie""", {"seuil": 5.0})


# --- incremental jobs and the stream's two sinks (X2, X5, X6, R3-R5, K9) ---------------

def _in_runs(df: DataFrame) -> DataFrame:
    """The fixture's rows as four runs."""
    return df.withColumn(warehouse.RUN_COL, F.concat(F.lit("r"), (F.col("event_id") % 4).cast("string")))


# a first collection of two runs, a late one, then one that is new and one collected again
_ARRIVALS = ({"r1": "a", "r3": "a"}, {"r0": "a", "r1": "a", "r3": "a"}, {"r0": "a", "r1": "b", "r2": "a", "r3": "a"})


@register("silver_incremental")
def q_silver_incremental(spark, sf):
    """The fusion of all rows, reached by three updates of the stored state."""
    quotes = _in_runs(normalize.tickers(_b(spark, sf)))
    root = scratch_path(spark, "fusion")
    for n, runs in enumerate(_ARRIVALS):
        def rows(some, first=n == 0):
            part = quotes.where(F.col(warehouse.RUN_COL).isin(*some)) if some else quotes.where(F.lit(False))
            # the first collection of r1 was another one: its prices are replaced later
            return part.withColumn("prix", F.lit("1").cast("string")) if first else part
        named = {r: v + ("0" if n == 0 and r == "r3" else "") for r, v in runs.items()}  # so was r3, until the second
        done = fusion_state.update(spark, root, named, rows, "event_id")
    schema = fuse.partial(quotes.limit(0).drop(warehouse.RUN_COL), "event_id").schema
    out = fuse.resolve(spark.read.schema(schema).parquet(done["etat"]), keep_order=True).drop("event_id")
    return clean.cast_types(out.withColumnRenamed(fuse.ORD, "event_id"), keep=("event_id",))


@register("dq_incremental")
def q_dq_incremental(spark, sf):
    """The report of every Bronze file, its results kept: three updates, each over new files."""
    rows = _dq_input(spark, sf)
    root = scratch_path(spark, "quality")
    files = sorted(r[0] for r in rows.select("fichier_source").distinct().collect())

    def compute(some):
        part = rows.where(F.col("fichier_source").isin(*some)) if some else rows.where(F.lit(False))
        return quality.report(part, None, "bronze", by="fichier_source").withColumn("run_id", F.col("table_name"))

    for n in (1, 2, 3):
        got, _ = run_state.update(spark, root, "bronze", {f: "a" for f in files[: -(-n * len(files) // 3)]}, compute)
    return got.drop("run_id")


@register("tick_stream_sinks")
def q_tick_stream_sinks(spark, sf):
    """The messages as a stream into both sinks, drained, started again and its finished
    days merged: ticks and alerts of each day, and the processed count."""
    land, out = scratch_path(spark, "tick-landing"), scratch_path(spark, "tick-sinks")
    fixtures.tick_messages(spark, sf).select("value", "timestamp").repartition(4).write.parquet(land)
    source = spark.readStream.schema("value string, timestamp timestamp_ntz").option("maxFilesPerTrigger", 2).parquet(land)
    for _ in range(2):
        ticks.start(spark, source, out, f"{out}/_checkpoint", ts=F.col("timestamp")).awaitTermination()
    ticks.merge_days(spark, out, "20240116")
    each = [ticks.read_sink(spark, out, t).select("jour", F.lit(t == ticks.TICKS).cast("int").alias("t"), F.lit(t == ticks.ALERTS).cast("int").alias("a"))
            for t in (ticks.TICKS, ticks.ALERTS)]
    return each[0].unionByName(each[1]).groupBy("jour").agg(F.sum("t").alias("nb_ticks"), F.sum("a").alias("nb_alertes")).withColumn(
        "nb_messages", F.lit(ticks.processed_count(spark, out)).cast("long"))
