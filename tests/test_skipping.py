"""The history's index by ticker: no row is lost, few files are opened."""
import datetime as dt

from pyspark.sql import functions as F

from quotefuse import constants as K
from quotefuse.operators import reports
from quotefuse.plans import ledger, skipping, warehouse
from quotefuse.session import scratch_path

TS = [dt.datetime(2024, 2, 1, h) for h in range(4)]
QUOTE = "ticker string, prix double, categorie string"


def load(spark, root, run, tickers, files=8):
    """Tickers spread over ``files`` files by their hash, as the fusion leaves them."""
    rows = spark.createDataFrame([(t, float(i), "crypto") for i, t in enumerate(tickers)], QUOTE)
    return warehouse.load_table(rows.repartition(files, "ticker"), root, K.HISTORY_TABLE, f"r{run}", TS[run])


def opened(df):
    return len(df.inputFiles())


def plain(spark, root, ticker):
    return sorted(map(tuple, warehouse.read_table(spark, root, K.HISTORY_TABLE).where(F.col("ticker") == ticker).collect()))


def through_index(spark, root, ticker):
    cols = warehouse.read_table(spark, root, K.HISTORY_TABLE).columns
    return sorted(map(tuple, skipping.read_ticker(spark, root, ticker).select(*cols).collect()))


def test_every_ticker_is_found_and_few_files_are_opened(spark):
    root = scratch_path(spark, "skipping")
    names = [f"T{i}" for i in range(400)] + ["", "é", "T1 ", "t1", "x" * 5000]
    for run in range(2):
        load(spark, root, run, names[run::2] + names[:20] + ["HOT"] * 2000 + [None] * 30)
    assert opened(skipping.read_ticker(spark, root, "T7")) == opened(warehouse.read_table(spark, root, K.HISTORY_TABLE)) == 16
    assert skipping.update(spark, root) == ["r0", "r1"]
    assert skipping.update(spark, root) == []
    few = 0
    for t in [*names[:40:3], *names[-5:], "HOT"]:
        assert through_index(spark, root, t) == plain(spark, root, t) != []
        few += opened(skipping.read_ticker(spark, root, t))
    assert few <= 2.5 * 20  # one or two files of 16 hold a ticker, but for a filter's rare mistake
    for t in ("T7000", "nothing", "zzz"):
        assert through_index(spark, root, t) == []
    absent = [len(skipping.files(spark, root, f"T{i}x")) for i in range(30)]
    assert sum(absent) <= 30 * 16 * 0.05


def test_loads_the_index_does_not_know(spark):
    root = scratch_path(spark, "skipping")
    assert skipping.update(spark, root) == [] and skipping.read_ticker(spark, root, "A").count() == 0
    load(spark, root, 0, ["A", "B"])
    skipping.update(spark, root)
    load(spark, root, 1, ["A", "C"])            # not indexed yet
    assert through_index(spark, root, "C") == plain(spark, root, "C") != []
    assert len(through_index(spark, root, "A")) == 2
    load(spark, root, 0, ["D"])                 # replaces an indexed load
    assert through_index(spark, root, "B") == []
    assert through_index(spark, root, "D") == plain(spark, root, "D") != []
    assert skipping.update(spark, root) == ["r0", "r1"]
    load(spark, root, 2, [])                    # an empty run
    load(spark, root, 3, [None, None])          # null tickers only
    assert skipping.update(spark, root) == ["r2", "r3"]
    for t in "ABCD":
        assert through_index(spark, root, t) == plain(spark, root, t)
    assert skipping.files(spark, root, "B") == []
    assert [r["ticker"] for r in reports.ticker_history(spark, root, "D").collect()] == ["D"]
    assert reports.ticker_card(spark, root, "A").first()["nb_entrees"] == 1
    # an entry that leaves the table leaves the index
    ledger.commit(spark, root, [ledger.Entry(K.HISTORY_TABLE, "r1", "", ledger.GONE)])
    assert skipping.update(spark, root) == [] and through_index(spark, root, "A") == []


def test_the_index_reads_the_ticker_column_only(spark):
    root = scratch_path(spark, "skipping")
    load(spark, root, 0, ["A", "B", "A"])
    plan = skipping.describe(spark, root, ledger.live(spark, root, K.HISTORY_TABLE))._jdf.queryExecution().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert scans and all("prix" not in x.split("ReadSchema")[1] for x in scans)
