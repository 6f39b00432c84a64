"""End-user jobs (X1-X7): collect -> Silver -> Gold -> load -> quality, and the
tick stream. Each job is one lazy plan per layer, ending in zone writes.

Layout under ``cfg.root`` (any Hadoop path):
  landing/<source>/*.json   landed provider payloads (JSON lines by default —
                            splittable; ``multiline=True`` for raw API arrays)
  bronze/collecte/run_id=…  collected quotes (plus ``collecte_latest``); a collection of the
                            yahoo, crypto or boursorama sources alone has a snapshot of that name
  silver/silver/run_id=…    Silver (plus ``silver_latest``)
  gold/<table>/run_id=…     the six KPIs (plus ``<table>_latest``)
  dw/<table>/run_id=…       warehouse tables
  logs/quality/…            long quality report and its JSON document

Re-running a run_id overwrites exactly that run's partitions everywhere.
"""

from __future__ import annotations

import argparse
import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotefuse import constants as K
from quotefuse.operators import clean, collect as collect_ops, fuse, kpis, normalize
from quotefuse.operators import quality as dq
from quotefuse.plans import archiving, fusion_state, ledger, run_state, skipping, warehouse
from quotefuse.schemas import RAW_QUOTE, SILVER
from quotefuse.sources import bronze as bronze_scan
from quotefuse.sources import payloads
from quotefuse.streaming import ticks

SOURCES = ("yahoo", "coingecko", "binance", "boursorama")
# What can be collected alone, with the name of its snapshots; any other choice is a "collecte"
SUBSETS = {"yahoo": ("yahoo",), "crypto": ("coingecko", "binance"), "boursorama": ("boursorama",)}
SNAPSHOTS = ("collecte", *SUBSETS)
SEQ = "_qf_seq"
BOURSORAMA_LANDED = T.StructType([T.StructField("symbole", T.StringType()), T.StructField("payload", T.StringType())])


@dataclass
class Config:
    root: str
    sources: tuple[str, ...] = SOURCES          # S12: subset to collect
    multiline: bool = False                     # landed files are JSON arrays
    n: int = K.TOP_N
    threshold: float = K.ALERT_THRESHOLD
    drop_errors_first: bool = False
    bronze_since: str | None = None             # oldest run_id Silver reads (None: all)
    bronze_csv: tuple[str, ...] = ()            # folders of CSV snapshots Silver reads as well
    export: tuple[str, ...] = ()                # further formats of the latest snapshots (csv, json)
    incremental: bool = True                    # Silver keeps a fusion state and reads new runs only

    @property
    def snapshot(self) -> str:
        """Name of the collection's snapshots."""
        return next((n for n, s in SUBSETS.items() if set(s) == set(self.sources)), "collecte")

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


def run_id_of(ts: _dt.datetime) -> str:
    return ts.strftime("%Y%m%d_%H%M%S")


def _read(spark: SparkSession, cfg: Config, source: str, schema) -> DataFrame | None:
    path = cfg.path("landing", source)
    if not warehouse.exists(spark, path):
        return None
    return payloads.read_landed(spark, path, schema, cfg.multiline)


def fear_greed(spark: SparkSession, cfg: Config, run_ts: _dt.datetime) -> dict:
    """S8 in a collection: the landed index of this run, or {} without a usable one."""
    path = cfg.path("landing", "fear_greed")
    if not warehouse.exists(spark, path):
        return {}
    index = payloads.parse_fear_greed(spark.read.text(path, wholetext=cfg.multiline), "value")
    warehouse.save_snapshot(index, cfg.path("bronze"), "fear_greed", run_id_of(run_ts))
    got = spark.read.schema(index.schema).parquet(cfg.path("bronze", "fear_greed_latest")).orderBy(
        "fear_greed_valeur", "fear_greed_label").limit(1).collect()
    return got[0].asDict() if got else {}


def collect(spark: SparkSession, cfg: Config, run_ts: _dt.datetime) -> dict:
    """Parse the selected sources' landed payloads, union, save Bronze.
    Items that cannot be read are error rows; a source without a landing
    folder is named in ``sources_absentes``; without any, an empty run is saved."""
    parsers = {
        "yahoo": (payloads.YAHOO_RECORD, "ticker", K.SRC_YAHOO,
                  lambda df: payloads.parse_yahoo(df, payloads.instruments(spark), run_ts)),
        "coingecko": (payloads.COINGECKO_ITEM, "symbol", K.SRC_COINGECKO,
                      lambda df: payloads.parse_coingecko(df, run_ts)),
        "binance": (payloads.BINANCE_ITEM, "symbol", K.SRC_BINANCE,
                    lambda df: payloads.parse_binance(df, K.COINS_BINANCE, run_ts)),
        "boursorama": (BOURSORAMA_LANDED, "symbole", K.SRC_BOURSORAMA,
                       lambda df: payloads.parse_boursorama(df, run_ts=run_ts))}
    frames, absent = [], []
    for name in (n for n in parsers if n in cfg.sources):
        schema, symbol, label, parse = parsers[name]
        landed = _read(spark, cfg, name, schema)
        if landed is None:
            absent.append(name)
            continue
        good = landed.where(F.col(payloads.CORRUPT).isNull()).drop(payloads.CORRUPT)
        frames.append(parse(good))
        frames.append(payloads.unreadable(landed, symbol, label, run_ts))
    union = collect_ops.union_sources(frames) if frames else spark.createDataFrame([], RAW_QUOTE)
    obs = Observation("collect")
    st = F.col("statut")
    # the row's collection position, fixed once at landing: the fusion order
    bronze = union.withColumn(SEQ, F.monotonically_increasing_id()).observe(
        obs, F.count_if(st == K.STATUS_OK).alias("nb_succes"),
        F.count_if(st == K.STATUS_ERROR).alias("nb_erreurs"))
    n = warehouse.save_snapshot(bronze, cfg.path("bronze"), cfg.snapshot, run_id_of(run_ts), export=cfg.export)
    ledger.commit(spark, cfg.path("bronze"), [ledger.Entry(cfg.snapshot, run_id_of(run_ts), ledger.new_load(), n)])
    index = fear_greed(spark, cfg, run_ts) if cfg.snapshot in ("collecte", "crypto") else {}
    return {**{k: int(v or 0) for k, v in obs.get.items()}, "sources_absentes": absent, **index}


SNAPSHOT = "_qf_snapshot"


def read_bronze(spark: SparkSession, cfg: Config) -> DataFrame:
    """All collected runs of all snapshots (explicit schema: an empty run leaves no files)."""
    schema = T.StructType(list(RAW_QUOTE.fields) + [T.StructField(SEQ, T.LongType()),
                                                     T.StructField(warehouse.RUN_COL, T.StringType())])
    out = None
    for name in SNAPSHOTS:
        if name == "collecte" or warehouse.exists(spark, cfg.path("bronze", name)):
            one = warehouse.read_zone(spark, cfg.path("bronze", name), schema).withColumn(SNAPSHOT, F.lit(name))
            out = one if out is None else out.unionByName(one)
    return out


def bronze_runs(spark: SparkSession, cfg: Config) -> dict[str, str]:
    """The committed runs ('run', or 'run.name' of a snapshot other than collecte) and their loads."""
    return {e.run_id if e.table_name == "collecte" else f"{e.run_id}.{e.table_name}": e.load_id
            for e in ledger.live(spark, cfg.path("bronze")) if e.table_name in SNAPSHOTS}


def of_runs(bronze: DataFrame, runs: list[str]) -> DataFrame:
    """Rows of some runs as ``bronze_runs`` names them: only their partitions are read."""
    test = F.lit(False)
    for name in SNAPSHOTS:
        some = [r.partition(".")[0] for r in runs if (r.partition(".")[2] or "collecte") == name]
        if some:
            test = test | ((F.col(SNAPSHOT) == name) & F.col(warehouse.RUN_COL).isin(*some))
    return bronze.where(test)


def bronze_order(df: DataFrame) -> DataFrame:
    """Explicit, unique fusion order: newest run first, then collection order.
    Run ids are digits of a UTC time, so they are ordered as numbers; no
    session time zone comes in."""
    stamp = F.regexp_replace(warehouse.RUN_COL, "[^0-9]", "").try_cast("long")
    name = F.col(SNAPSHOT) if SNAPSHOT in df.columns else F.lit("")
    return df.withColumn("_qf_key", F.struct((-F.coalesce(stamp, F.lit(0).cast("long"))).alias("run"), F.col(SEQ).alias("seq"),
                                             name.alias("name"))).drop(SNAPSHOT)


def file_name() -> Column:
    """The name that a run's snapshot has as a file."""
    return F.concat(F.col(SNAPSHOT), F.lit("_"), F.col(warehouse.RUN_COL), F.lit(".parquet"))


def run_label() -> Column:
    """The run as ``bronze_runs`` names it."""
    return F.when(F.col(SNAPSHOT) == "collecte", F.col(warehouse.RUN_COL)).otherwise(
        F.concat(F.col(warehouse.RUN_COL), F.lit("."), F.col(SNAPSHOT)))


def csv_bronze(spark: SparkSession, cfg: Config) -> DataFrame | None:
    """CSV snapshots (S1) as Bronze rows: the run comes from the file name
    (``..._yyyyMMdd_HHmmss.csv``), the order from the place in the file, then its path."""
    if not cfg.bronze_csv:
        return None
    df = bronze_scan.scan_split(spark, cfg.bronze_csv)
    df = df.withColumnsRenamed({bronze_scan.POS_COL: SEQ, bronze_scan.PATH_COL: SNAPSHOT})
    run = F.nullif(F.regexp_extract("fichier_source", r"(\d{8}_\d{6})", 1), F.lit(""))
    return df.withColumn(warehouse.RUN_COL, run)


def bronze_quotes(spark: SparkSession, cfg: Config, runs: list[str] | None = None) -> DataFrame:
    """Collected quotes as the fusion reads them, with ``run_id`` and the order ``_qf_key``;
    of some runs only those partitions are read."""
    b = read_bronze(spark, cfg)
    if runs is not None:
        b = of_runs(b, runs)
    if cfg.bronze_since:  # partition pruning on run_id: only the listed runs are read
        b = b.where(F.col(warehouse.RUN_COL) >= cfg.bronze_since)
    b = b.withColumn("fichier_source", file_name()).withColumn("_qf_run", run_label())
    b = bronze_order(b).withColumn(warehouse.RUN_COL, F.col("_qf_run")).drop("_qf_run")
    return normalize.tickers(normalize.columns(b.drop(SEQ)))


def fused_quotes(spark: SparkSession, cfg: Config) -> DataFrame:
    """J6 over all collected runs: from the stored state and the runs that are new
    (``plans/fusion_state.py``), or, with a lower bound, CSV snapshots or a Bronze
    zone without a ledger, over all rows."""
    runs = bronze_runs(spark, cfg)
    if cfg.incremental and runs and not cfg.bronze_since and not cfg.bronze_csv:
        def rows(some: list[str]) -> DataFrame:
            quotes = bronze_quotes(spark, cfg, some)
            return fuse.without_errors(quotes) if cfg.drop_errors_first else quotes
        state = cfg.path("silver", "fusion_sans_erreurs" if cfg.drop_errors_first else "fusion")
        return fusion_state.fused(spark, state, runs, rows, "_qf_key")[0].drop("_qf_key")
    df = bronze_quotes(spark, cfg).drop(warehouse.RUN_COL)
    snapshots = csv_bronze(spark, cfg)
    if snapshots is not None:
        snapshots = normalize.tickers(normalize.columns(bronze_order(snapshots).drop(warehouse.RUN_COL, SEQ)))
        text = df.select(*[c if c == "_qf_key" else F.col(c).cast("string").alias(c) for c in df.columns])
        df = text.unionByName(snapshots, allowMissingColumns=True)
    return fuse.fuse(df, "_qf_key", drop_errors_first=cfg.drop_errors_first).drop("_qf_key")


def silver(spark: SparkSession, cfg: Config, run_ts: _dt.datetime) -> dict[str, int]:
    """Bronze (all runs, newest first) -> Silver; counts before/after cleaning."""
    fused = normalize.ensure(fused_quotes(spark, cfg))
    casted = clean.cast_types(fused)
    obs = Observation("clean")
    casted = casted.observe(obs, F.count(F.lit(1)).alias("nb_avant"),
                            F.count_if(clean.valid_predicate()).alias("nb_apres"))
    out = clean.finalize(clean.currency(clean.valid(casted)))
    # observed during the (single) evaluation that writes the run partition;
    # the sorted ``latest`` is copied from what was written
    warehouse.save_snapshot(out, cfg.path("silver"), "silver", run_id_of(run_ts),
                            sort_by=[F.col("categorie").asc_nulls_last(),
                                     F.col("ticker").asc_nulls_last()], export=cfg.export)
    return {k: int(v) for k, v in obs.get.items()}


def read_silver(spark: SparkSession, cfg: Config, run_id: str | None = None) -> DataFrame:
    """The latest Silver, or one run's partition."""
    if run_id is None:
        return warehouse.read_zone(spark, cfg.path("silver", "silver_latest"), SILVER)
    schema = T.StructType(list(SILVER.fields) + [T.StructField(warehouse.RUN_COL, T.StringType())])
    return (warehouse.read_zone(spark, cfg.path("silver", "silver"), schema)
            .where(F.col(warehouse.RUN_COL) == run_id).drop(warehouse.RUN_COL))


def gold(spark: SparkSession, cfg: Config, run_ts: _dt.datetime) -> dict[str, int]:
    """The six KPIs from the written Silver of this run."""
    s = read_silver(spark, cfg, run_id_of(run_ts))
    out = {}
    for t, g in kpis.all_gold(s, run_ts, cfg.n, cfg.threshold).items():
        out[t] = warehouse.save_snapshot(g, cfg.path("gold"), t, run_id_of(run_ts), export=cfg.export)
    return out


def load(spark: SparkSession, cfg: Config, run_ts: _dt.datetime) -> dict[str, int]:
    """History + Gold of this run into the warehouse (idempotent), then the
    history's index by ticker over the loads that are new."""
    rid = run_id_of(run_ts)
    s = read_silver(spark, cfg, rid)
    g = {t: warehouse.read_zone(spark, cfg.path("gold", t), warehouse.gold_schema(t))
         .where(F.col(warehouse.RUN_COL) == rid).drop(warehouse.RUN_COL) for t in K.GOLD_TABLES}
    counts = warehouse.load(spark, cfg.path("dw"), s, g, rid, run_ts)
    skipping.update(spark, cfg.path("dw"))
    return counts


def checked_bronze(spark: SparkSession, cfg: Config, runs: list[str] | None = None) -> DataFrame:
    """Bronze rows of some runs (None: all) as the checks read them, with their file's name."""
    b = read_bronze(spark, cfg)
    if runs is not None:
        b = of_runs(b, runs)
    return clean.cast_types(normalize.ensure(normalize.columns(
        b.withColumn("fichier_source", file_name()).drop(SEQ, SNAPSHOT, warehouse.RUN_COL))))


def bronze_report(spark: SparkSession, cfg: Config) -> DataFrame:
    """The checks of every Bronze file, with its rows: a file's result is kept, so only
    files of new or repeated runs are read."""
    def compute(runs: list[str] | None) -> DataFrame:
        rep = dq.report(checked_bronze(spark, cfg, runs), None, "bronze", by="fichier_source", with_total=True)
        run, name = (F.regexp_extract("table_name", r"^([a-z]+)_(.*)\.parquet$", i) for i in (2, 1))
        return rep.withColumn("run_id", F.when(name == "collecte", run).otherwise(F.concat(run, F.lit("."), name)))

    runs = bronze_runs(spark, cfg)
    if not runs:  # a Bronze zone without a ledger
        return compute(None).drop("run_id")
    return run_state.update(spark, cfg.path("logs", "quality_state"), "bronze", runs, compute)[0].drop("run_id")


def quality(spark: SparkSession, cfg: Config, run_ts: _dt.datetime,
            layers=("silver",)) -> DataFrame:
    """Bronze per file, Silver, Gold (completeness), warehouse; summary;
    long report + JSON document written under logs/. Returns the summary. Of Bronze and of
    the history only new runs are read; their checks and counts come from one pass."""
    sized = bronze_report(spark, cfg).unionByName(dq.report(read_silver(spark, cfg), "silver", "silver", with_total=True))
    for t in K.GOLD_TABLES:
        latest = warehouse.read_zone(spark, cfg.path("gold", f"{t}_latest"), warehouse.gold_schema(t, False))
        sized = sized.unionByName(dq.report(latest, f"{t}_latest", "gold", ["completude"], with_total=True))
    stock = dq.warehouse_checks(spark, cfg.path("dw"), state=cfg.path("logs", "quality_state"))
    rep = sized.unionByName(stock, allowMissingColumns=True)
    rid = run_id_of(run_ts)
    warehouse.write_run(rep.withColumn(warehouse.RUN_COL, F.lit(rid)), cfg.path("logs", "quality"), rid)
    saved = spark.read.schema(rep.schema.add(warehouse.RUN_COL, "string")).parquet(cfg.path("logs", "quality")).where(
        F.col(warehouse.RUN_COL) == rid).drop(warehouse.RUN_COL)
    counts = dq.counts_of(saved.where(F.col("nb_lignes").isNotNull()))
    saved = saved.drop("nb_lignes")
    status = dq.global_status(saved, layers)
    dq.to_json_document(saved, counts, status, run_ts).write.mode("overwrite").text(cfg.path("logs", "quality_report"))
    return status


def archive(spark: SparkSession, cfg: Config, run_ts: _dt.datetime) -> dict[str, int]:
    """Last step of the hourly chain (K10): raw payloads, the latest snapshots of every zone
    and the logs, byte for byte under archive/<year>/<month>/<day>/, with counts of files
    done and failed and of bytes. The outcome of every file is logged beside."""
    latest = [cfg.path("bronze", f"{cfg.snapshot}_latest"), cfg.path("silver", "silver_latest"),
              *(cfg.path("gold", f"{t}_latest") for t in K.GOLD_TABLES)]
    folders = [(cfg.path("landing"), "raw"), *((p, "processed/" + p.rsplit("/", 1)[-1]) for p in latest), (cfg.path("logs"), "logs")]
    outcome = archiving.mirror(spark, folders, cfg.path("archive", run_ts.strftime("%Y/%m/%d")), required=latest)
    warehouse.write_run(outcome.withColumn(warehouse.RUN_COL, F.lit(run_id_of(run_ts))), cfg.path("archive_log"), run_id_of(run_ts))
    return archiving.counts(outcome)


def stream(spark: SparkSession, cfg: Config, source: DataFrame, trigger: dict | None = None):
    """One tick stream into stream/ticks and stream/alertes, by day."""
    return ticks.start(spark, source, cfg.path("stream"), cfg.path("stream", "_checkpoint"),
                       trigger)


def run_all(spark: SparkSession, cfg: Config, run_ts: _dt.datetime | None = None) -> dict:
    """Collect once -> Silver -> Gold -> load -> quality -> archive."""
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    out = {"run_id": run_id_of(run_ts), "collect": collect(spark, cfg, run_ts)}
    out["silver"] = silver(spark, cfg, run_ts)
    out["gold"] = gold(spark, cfg, run_ts)
    out["load"] = load(spark, cfg, run_ts)
    out["quality"] = quality(spark, cfg, run_ts).collect()[0].asDict()
    out["archive"] = archive(spark, cfg, run_ts)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="quote pipeline jobs")
    ap.add_argument("job", choices=["collect", "silver", "gold", "load", "quality", "archive", "run_all", "stream"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--source", choices=["tout", "yahoo", "crypto", "boursorama"], default="tout")
    ap.add_argument("--run-ts", help="yyyy-mm-ddTHH:MM:SS (default: now, UTC)")
    ap.add_argument("--multiline", action="store_true")
    ap.add_argument("--n", type=int, default=K.TOP_N, help="rows of the movers and crypto lists")
    ap.add_argument("--threshold", type=float, default=K.ALERT_THRESHOLD, help="price alert, in percent")
    ap.add_argument("--bronze-since", help="oldest run id that Silver reads")
    ap.add_argument("--bronze-csv", nargs="*", default=(), help="folders of CSV snapshots that Silver reads as well")
    ap.add_argument("--drop-errors-first", action="store_true")
    ap.add_argument("--export", nargs="*", choices=["csv", "json"], default=())
    ap.add_argument("--full", action="store_true", help="Silver fuses all Bronze rows instead of keeping a state")
    ap.add_argument("--ticks", help="folder of tick messages to stream from (stream job), one per line")
    a = ap.parse_args(argv)
    srcs = {"tout": SOURCES, **SUBSETS}[a.source]
    cfg = Config(root=a.root, sources=srcs, multiline=a.multiline, n=a.n, threshold=a.threshold,
                 drop_errors_first=a.drop_errors_first, bronze_since=a.bronze_since,
                 bronze_csv=tuple(a.bronze_csv), export=tuple(a.export), incremental=not a.full)
    ts = _dt.datetime.fromisoformat(a.run_ts) if a.run_ts else \
        _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    spark = SparkSession.builder.getOrCreate()
    if a.job == "stream":
        if not a.ticks:
            ap.error("stream needs --ticks")
        query = stream(spark, cfg, spark.readStream.text(a.ticks))
        query.awaitTermination()
        print({"nb_messages": ticks.processed_count(spark, cfg.path("stream"))})
        return
    fn = {"collect": collect, "silver": silver, "gold": gold, "load": load,
          "archive": archive, "run_all": run_all}.get(a.job)
    print(fn(spark, cfg, ts) if fn else quality(spark, cfg, ts).collect())


if __name__ == "__main__":
    main()
