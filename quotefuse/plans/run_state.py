"""Results per run, kept and reused.

A check of one file depends on that file's rows alone, so its result is computed
once and kept under the run's id together with what it was made from; a later
report computes new or changed runs and takes the rest as it is. Results of one
computation share a folder ``<name>/load_id=…`` and hold their ``run_id`` as a
column; the ledger says which folder has the valid result of a run. When many
folders hold few rows each they are rewritten as one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotefuse.plans import ledger

FOLDERS = 64
FILE_ROWS = 1_000_000


def _schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])


def read(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The valid results of all runs, with ``run_id``."""
    entries = [e for e in ledger.live(spark, root, name) if e.source]
    if not entries:
        return spark.createDataFrame([], _schema(schema))
    loads = sorted({e.load_id for e in entries})
    kept = spark.createDataFrame([(e.run_id, e.load_id) for e in entries], f"run_id string, {ledger.LOAD_COL} string")
    rows = spark.read.schema(_schema(schema)).option("basePath", f"{root}/{name}").parquet(
        *[f"{root}/{name}/{ledger.LOAD_COL}={x}" for x in loads])
    # a line per run, like a list of partitions
    return rows.join(F.broadcast(kept), ["run_id", ledger.LOAD_COL], "left_semi").drop(ledger.LOAD_COL).select(
        *schema.names, "run_id")


def update(spark: SparkSession, root: str, name: str, runs: Mapping[str, str], compute: Callable[[list[str]], DataFrame]
           ) -> tuple[DataFrame, list[str]]:
    """The results of ``runs`` (run id -> what it is made from), computing those that are
    missing or made from something else; and the runs that were computed. ``compute`` gives the
    results of some runs with ``run_id``; runs that are not named any more lose theirs."""
    known = {e.run_id: e.source for e in ledger.live(spark, root, name)}
    changed = sorted(r for r, s in runs.items() if known.get(r) != s)
    gone = [ledger.Entry(name, r, "", ledger.GONE) for r in known if r not in runs]
    schema = T.StructType([f for f in compute([]).schema.fields if f.name != "run_id"])
    if changed:
        load = ledger.new_load()
        compute(changed).select(*schema.names, "run_id").write.parquet(f"{root}/{name}/{ledger.LOAD_COL}={load}")
        gone += [ledger.Entry(name, r, load, 0, runs[r]) for r in changed]
    if gone:
        ledger.commit(spark, root, gone)
    entries = ledger.live(spark, root, name)
    if len({e.load_id for e in entries}) > FOLDERS:
        load = ledger.new_load()
        rows = read(spark, root, name, schema)
        rows.coalesce(1 + rows.count() // FILE_ROWS).write.parquet(f"{root}/{name}/{ledger.LOAD_COL}={load}")
        ledger.commit(spark, root, [ledger.Entry(name, e.run_id, load, 0, e.source) for e in entries])
    return read(spark, root, name, schema), changed
