"""Data-skipping index of the history by ticker (P12, A8): which files may hold it.

For every data file of a load the index keeps the least and greatest ticker and a
Bloom filter of its tickers, cut into blocks of 64 bits: a ticker's hash chooses
one block of the file, six bits of a second hash are set in it. A row of the index
is one block that has a bit set, with its file's bounds, so a lookup filters rows
and never unpacks a filter; a block that is not there has no bits. There are as many
blocks as a file has ``PER_BLOCK`` distinct tickers, rounded up to a power of two.

The index is built by Spark from the ticker column alone, load by load: rows of
``plans/run_state.py``, valid for the load they were made from. A run that is not
indexed, or was loaded again since, is read whole, so an index that lags behind
costs time and never rows. A filter may name a file without the ticker (about one
in 200), never leave out a file that holds it.

Defined results: a null ticker is in no index (equality never finds one); an empty
run has no files; a file of null tickers only is never opened; a ticker that no
file may hold gives the empty history without opening one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotefuse import constants as K
from quotefuse.plans import ledger, run_state, warehouse

FOLDER, NAME = "index", f"{K.HISTORY_TABLE}_ticker"
PER_BLOCK, BITS = 4, 6
SCHEMA = T.StructType([
    T.StructField("fichier", T.StringType()), T.StructField("ticker_min", T.StringType()),
    T.StructField("ticker_max", T.StringType()), T.StructField("blocs", T.LongType()),
    T.StructField("bloc", T.LongType()), T.StructField("bits", T.LongType())])


def _block(ticker: Column, blocks: Column) -> Column:
    """The block of a ticker among ``blocks``, a power of two."""
    return F.xxhash64(ticker).bitwiseAND(blocks - F.lit(1))


def _mask(ticker: Column) -> Column:
    """The bits that a ticker sets in its block."""
    h, out = F.xxhash64(ticker, F.lit(1)), F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def describe(spark: SparkSession, root: str, entries: Iterable[ledger.Entry]) -> DataFrame:
    """The index rows of some loads of the history, with ``run_id``."""
    paths = [ledger.folder(root, K.HISTORY_TABLE, e.run_id, e.load_id) for e in entries if e.nb_lignes > 0]
    if not paths:
        return spark.createDataFrame([], T.StructType([*SCHEMA.fields, T.StructField("run_id", T.StringType())]))
    rows = (spark.read.schema(warehouse.table_schema(K.HISTORY_TABLE)).option("basePath", f"{root}/{K.HISTORY_TABLE}").parquet(*paths)
            .select("run_id", F.col("_metadata.file_name").alias("fichier"), "ticker").where(F.col("ticker").isNotNull()))
    # a ticker that fills a file is one row of each task before the shuffle
    held = rows.distinct()
    files = rows.groupBy("run_id", "fichier").agg(
        F.min("ticker").alias("ticker_min"), F.max("ticker").alias("ticker_max"),
        F.approx_count_distinct("ticker").alias("n"))
    # the size of a filter decides how often it errs, not what it finds: an estimate will do
    size = F.ceil(F.log2(F.greatest(F.col("n") / F.lit(float(PER_BLOCK)), F.lit(1.0)))).cast("int")
    files = files.withColumn("blocs", F.call_function("shiftleft", F.lit(1).cast("long"), size)).drop("n")
    return (held.join(files, ["run_id", "fichier"])
            .groupBy("run_id", "fichier", "ticker_min", "ticker_max", "blocs",
                     _block(F.col("ticker"), F.col("blocs")).alias("bloc"))
            .agg(F.bit_or(_mask(F.col("ticker"))).alias("bits")).select(*SCHEMA.names, "run_id"))


def update(spark: SparkSession, root: str) -> list[str]:
    """Indexes the live loads of the history that are not indexed yet, and forgets
    those that are not live any more; the runs that were read."""
    live = {e.run_id: e for e in ledger.live(spark, root, K.HISTORY_TABLE)}
    return run_state.update(spark, f"{root}/{FOLDER}", NAME, {r: e.load_id for r, e in live.items()},
                            lambda runs: describe(spark, root, [live[r] for r in runs]))[1]


def files(spark: SparkSession, root: str, ticker: str) -> list[str]:
    """Paths that may hold a ticker: data files of indexed loads, folders of the others."""
    made = {e.run_id: e.source for e in ledger.live(spark, f"{root}/{FOLDER}", NAME)}
    live = {e.run_id: e for e in ledger.live(spark, root, K.HISTORY_TABLE) if e.nb_lignes > 0}
    indexed = {r for r, e in live.items() if made.get(r) == e.load_id}
    out = [ledger.folder(root, K.HISTORY_TABLE, r, e.load_id) for r, e in live.items() if r not in indexed]
    if indexed:
        t = F.lit(ticker)
        mask = _mask(t)
        hit = (run_state.read(spark, f"{root}/{FOLDER}", NAME, SCHEMA)
               .where((F.col("ticker_min") <= t) & (F.col("ticker_max") >= t))
               .where((F.col("bloc") == _block(t, F.col("blocs"))) & (F.col("bits").bitwiseAND(mask) == mask))
               .select("run_id", "fichier"))
        # one name per file to open, which the reader's own listing holds anyway
        out += [f"{ledger.folder(root, K.HISTORY_TABLE, r.run_id, live[r.run_id].load_id)}/{r.fichier}"
                for r in hit.toLocalIterator() if r.run_id in indexed]
    return sorted(out)


def read_ticker(spark: SparkSession, root: str, ticker: str) -> DataFrame:
    """The live history rows of one ticker, opening only files that may hold it."""
    schema, paths = warehouse.table_schema(K.HISTORY_TABLE), files(spark, root, ticker)
    if not paths:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", f"{root}/{K.HISTORY_TABLE}").parquet(*paths)
            .drop(ledger.LOAD_COL).where(F.col("ticker") == F.lit(ticker)))
