"""Zones and warehouse: partitioned Parquet, idempotent per run.

A warehouse table is a folder of loads; the ledger says which load of a run is
live and with how many rows, so readers see whole loads only and an empty run is
a run like any other (``plans/ledger.py``). A zone is a directory partitioned by
``run_id`` whose snapshot overwrites its own run's partition (dynamic partition
overwrite); that touches no partition when the result is empty, so a run that
wrote no row has its partition removed. Row counts come from ``observe`` during
the write, without a second pass.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotefuse import constants as K
from quotefuse.functions.scalar import day_path, now_utc, ts_lit
from quotefuse.plans import archiving, ledger
from quotefuse.schemas import GOLD_COLUMNS, HISTORY_COLUMNS, dw_type, struct

RUN_COL, LOADED_COL = "run_id", "inserted_at"


def table_columns(table: str) -> tuple[str, ...]:
    return HISTORY_COLUMNS if table == K.HISTORY_TABLE else GOLD_COLUMNS[table]


def table_schema(table: str):
    cols = [(c, dw_type(c)) for c in table_columns(table)]
    return struct(*cols, (LOADED_COL, T.TimestampNTZType()), (RUN_COL, T.StringType()))


def gold_schema(table: str, with_run: bool = True):
    """Schema of a Gold zone table (the KPI columns, plus ``run_id``)."""
    cols = [(c, dw_type(c)) for c in GOLD_COLUMNS[table]]
    return struct(*cols, *([(RUN_COL, T.StringType())] if with_run else []))


def _fs(spark: SparkSession, path: str):
    """(file system, path) of any Hadoop path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - directories only
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_run(df: DataFrame, path: str, run_id: str) -> int:
    """Replaces one run of a partitioned directory with ``df`` (which holds
    ``run_id`` in every row); returns the rows written."""
    obs = Observation("write_run")
    (df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COL).parquet(path))
    n = int(obs.get.get("n", 0))
    if n == 0:
        fs, p = _fs(df.sparkSession, f"{path}/{RUN_COL}={run_id}")
        if fs.exists(p):
            fs.delete(p, True)
    return n


def create_tables(spark: SparkSession, root: str, tables=K.DW_TABLES) -> None:
    """Create-if-missing: an empty table directory per table (K4).

    An empty partitioned Parquet write leaves only ``_SUCCESS`` (no schema),
    so a directory is the same table; the types live in ``table_schema`` and
    every read applies them (``read_table``), and ``plans/catalog.py`` declares
    them as tables of the Spark catalog."""
    for t in tables:
        fs, p = _fs(spark, f"{root}/{t}")
        if not fs.exists(p):
            fs.mkdirs(p)


def read_zone(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet directory with its schema; empty if the path does not exist.
    Every other failure to read is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table's live rows, of all runs or of one; without any it is empty with
    its schema (S3). Only the folders that the ledger names are listed."""
    return read_runs(spark, root, table, None if run_id is None else [run_id])


def read_runs(spark: SparkSession, root: str, table: str, runs: Collection[str] | None) -> DataFrame:
    """The live rows of some runs (None: of all)."""
    found = [e for e in ledger.live(spark, root, table) if e.nb_lignes and (runs is None or e.run_id in runs)]
    schema = table_schema(table)
    if not found:
        return spark.createDataFrame([], schema)
    paths = [ledger.folder(root, table, e.run_id, e.load_id) for e in found]
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths).drop(ledger.LOAD_COL)


def latest_run(spark: SparkSession, root: str, table: str) -> str | None:
    """Newest run id of a table, from the ledger: no data file is opened."""
    return ledger.latest_run(spark, root, table)


def _prepare(df: DataFrame, table: str, run_id: str, run_ts: _dt.datetime) -> DataFrame:
    """Known ∩ available columns (P14), NaN -> NULL, DW types, run columns."""
    present = set(df.columns)
    cols = []
    for c in table_columns(table):
        t = dw_type(c)
        if c in present:
            x = F.col(c).cast(t)
            if t.typeName() == "double":
                x = F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
            cols.append(x.alias(c))
        else:
            cols.append(F.lit(None).cast(t).alias(c))
    out = df.select(*cols, ts_lit(run_ts).alias(LOADED_COL), F.lit(run_id).alias(RUN_COL))
    # the history is read by ticker: sorted files let row-group statistics prune it
    return out.sortWithinPartitions("ticker") if table == K.HISTORY_TABLE else out


def write_load(df: DataFrame, root: str, table: str, run_id: str, run_ts: _dt.datetime) -> ledger.Entry:
    """Writes one load of a table where nobody looks yet; the entry to commit."""
    entry = ledger.Entry(table, run_id, ledger.new_load(), 0)
    obs = Observation("write_load")
    (_prepare(df, table, run_id, run_ts).drop(RUN_COL).observe(obs, F.count(F.lit(1)).alias("n"))
     .write.parquet(ledger.folder(root, table, run_id, entry.load_id)))
    return ledger.Entry(table, run_id, entry.load_id, int(obs.get.get("n", 0)))


def load_table(df: DataFrame, root: str, table: str, run_id: str,
               run_ts: _dt.datetime) -> int:
    """Loads one run of a table, replacing an earlier load of it; returns the rows written (K5, K6)."""
    entry = write_load(df, root, table, run_id, run_ts)
    ledger.commit(df.sparkSession, root, [entry])
    return entry.nb_lignes


def load(spark: SparkSession, root: str, silver: DataFrame, gold: Mapping[str, DataFrame],
         run_id: str, run_ts: _dt.datetime) -> dict[str, int]:
    """Gold tables + history for one run, made visible together; per-table and total counts (K7)."""
    create_tables(spark, root)
    frames = {**{t: gold[t] for t in K.GOLD_TABLES if t in gold}, K.HISTORY_TABLE: silver}
    return committed(spark, root, [write_load(df, root, t, run_id, run_ts) for t, df in frames.items()])


def committed(spark: SparkSession, root: str, entries: list[ledger.Entry]) -> dict[str, int]:
    """Commits the tables of a load; rows per table and in total."""
    ledger.commit(spark, root, entries)
    counts = {e.table_name: e.nb_lignes for e in entries}
    return {**counts, "total": sum(counts.values())}


def save_snapshot(df: DataFrame, zone: str, name: str, run_id: str, sort_by=None,
                  export: tuple[str, ...] = ()) -> int:
    """Zone snapshot: run-partitioned history plus an always-overwritten
    ``latest`` (K1-K3; an empty result still replaces latest, D7). The plan
    is evaluated once: ``latest`` is copied from the written partition, and
    only that copy is sorted (``sort_by``). ``export`` names further formats
    of ``latest`` ('csv', 'json'). Returns the rows written."""
    tagged = df.withColumn(RUN_COL, F.lit(run_id))
    n = write_run(tagged, f"{zone}/{name}", run_id)
    # explicit schema: an empty run writes no partition files to infer from
    written = (read_zone(df.sparkSession, f"{zone}/{name}", tagged.schema)
               .where(F.col(RUN_COL) == F.lit(run_id)).drop(RUN_COL))
    if sort_by:
        written = written.orderBy(*sort_by)
    written.write.mode("overwrite").parquet(f"{zone}/{name}_latest")
    for kind in export:
        out = written.write.mode("overwrite")
        (out.option("header", "true").option("escape", '"') if kind == "csv" else out).format(kind).save(f"{zone}/{name}_latest_{kind}")
    return n


def archive(df: DataFrame, root: str, run_ts: _dt.datetime | None = None,
            ts_col=None) -> DataFrame:
    """Date-partitioned archive annee/mois/jour.

    The day is the run's (upload day, as the original) or, with ``ts_col``,
    each row's own timestamp. Re-archiving a day replaces that day only.
    Returns the archive read back.
    """
    if ts_col is None:
        ts_col = ts_lit(run_ts) if run_ts is not None else now_utc()
    parts = F.split(day_path(ts_col), "/")
    out = df.select("*", parts[0].alias("annee"), parts[1].alias("mois"), parts[2].alias("jour"))
    obs = Observation("archive")
    (out.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("annee", "mois", "jour").parquet(root))
    if run_ts is not None and int(obs.get.get("n", 0)) == 0:  # the run's day holds nothing any more
        day = run_ts.strftime("annee=%Y/mois=%m/jour=%d")
        for path in {f"{root}/{day}", f"{root}/annee={run_ts.year}/mois={run_ts.month}/jour={run_ts.day}"}:
            fs, p = _fs(df.sparkSession, path)
            if fs.exists(p):
                fs.delete(p, True)
    # explicit schema: an archive of no rows leaves no file to infer from
    days = [T.StructField(c, T.IntegerType()) for c in ("annee", "mois", "jour")]
    return read_zone(df.sparkSession, root, T.StructType([*df.schema.fields, *days]))


def archive_files(spark: SparkSession, paths: list[str], root: str, run_ts: _dt.datetime) -> dict[str, int]:
    """Archives the directories of a run, byte for byte, below root/<day>/<name>
    (K10); counts the directories that could and could not be archived. What an
    earlier archive of the day had of them and is gone since is removed."""
    named = [(p, p.rstrip("/").rsplit("/", 1)[-1]) for p in paths]
    outcome = archiving.mirror(spark, named, f"{root}/{run_ts:%Y/%m/%d}", required=paths)
    failed = {r["cible"] for r in outcome.where(F.col("erreur").isNotNull()).select("cible").collect()}
    wrong = {name for _, name in named if any(f"/{name}/" in f"{t}/" for t in failed)}
    return {"nb_ok": len(named) - len(wrong), "nb_erreurs": len(wrong)}
