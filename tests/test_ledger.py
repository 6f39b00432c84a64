"""Loads become visible together, an empty newest run is shown as empty, and
the catalog follows the ledger."""
import datetime as dt
import threading

import pytest

from quotefuse import constants as K
from quotefuse.operators import reports
from quotefuse.plans import catalog, ledger, warehouse
from quotefuse.session import scratch_path

TS = dt.datetime(2024, 2, 1, 10, 0, 0)
ALERT = "ticker string, variation_pct double"


def alerts(spark, *tickers):
    return spark.createDataFrame([(t, 5.0) for t in tickers], ALERT)


def tickers(df):
    return sorted(r["ticker"] for r in df.collect())


def test_empty_newest_run_is_empty(spark):
    root = scratch_path(spark, "ledger")
    assert reports.report_alerts(spark, root, all_runs=False).count() == 0
    warehouse.load_table(alerts(spark, "A"), root, "alertes_prix", "r1", TS)
    assert tickers(reports.report_alerts(spark, root, all_runs=False)) == ["A"]
    assert warehouse.load_table(alerts(spark, "B").limit(0), root, "alertes_prix", "r2", TS) == 0
    assert warehouse.latest_run(spark, root, "alertes_prix") == "r2"
    assert reports.report_alerts(spark, root, all_runs=False).count() == 0
    assert tickers(reports.report_alerts(spark, root)) == ["A"]
    assert reports.alert_count(spark, root, all_runs=False).first()[0] == 0
    # an old run loaded again does not become the newest
    warehouse.load_table(alerts(spark, "C"), root, "alertes_prix", "r1", TS)
    assert warehouse.latest_run(spark, root, "alertes_prix") == "r2"
    assert tickers(warehouse.read_table(spark, root, "alertes_prix")) == ["C"]
    assert [(r.table_name, r.run_id, r.nb_lignes) for r in ledger.frame(spark, root).collect()] == [
        ("alertes_prix", "r1", 1), ("alertes_prix", "r2", 0)]


def test_a_reader_during_a_load_sees_the_old_run_whole(spark):
    root = scratch_path(spark, "ledger")
    silver = spark.createDataFrame([("A", 1.0)], "ticker string, prix double")
    gold = {"alertes_prix": alerts(spark, "A")}
    warehouse.load(spark, root, silver, gold, "r1", TS)
    before = warehouse.read_table(spark, root, K.HISTORY_TABLE)
    entries = [warehouse.write_load(alerts(spark, "B", "C"), root, "alertes_prix", "r1", TS),
               warehouse.write_load(silver.limit(0), root, K.HISTORY_TABLE, "r1", TS)]
    # written, not committed: nobody sees it
    assert tickers(warehouse.read_table(spark, root, "alertes_prix")) == ["A"]
    assert tickers(warehouse.read_table(spark, root, K.HISTORY_TABLE)) == ["A"]
    warehouse.committed(spark, root, entries)
    assert tickers(warehouse.read_table(spark, root, "alertes_prix")) == ["B", "C"]
    assert warehouse.read_table(spark, root, K.HISTORY_TABLE).count() == 0
    assert tickers(before) == ["A"]  # a reader that has listed its files goes on with them
    assert ledger.vacuum(spark, root) == []
    gone = ledger.vacuum(spark, root, dt.timedelta(seconds=-5))
    assert sorted(g.split("/")[0] for g in gone) == ["alertes_prix", K.HISTORY_TABLE]
    assert tickers(warehouse.read_table(spark, root, "alertes_prix")) == ["B", "C"]


def test_a_failed_load_leaves_nothing(spark):
    root = scratch_path(spark, "ledger")
    bad = alerts(spark, "A").selectExpr("ticker", "raise_error('x') as variation_pct")
    with pytest.raises(Exception, match="x"):
        warehouse.load(spark, root, spark.createDataFrame([("A",)], "ticker string"), {"alertes_prix": bad}, "r1", TS)
    assert warehouse.latest_run(spark, root, K.HISTORY_TABLE) is None
    assert warehouse.read_table(spark, root, K.HISTORY_TABLE).count() == 0


def test_many_commits_fold_into_a_state(spark):
    root = scratch_path(spark, "ledger")
    n = 2 * ledger.FOLD + 5
    for i in range(n):
        ledger.commit(spark, root, [ledger.Entry("t", f"r{i % 40:03d}", f"l{i}", i), ledger.Entry("u", "r", "l", 0)])
    live = ledger.live(spark, root, "t")
    assert [(e.run_id, e.load_id) for e in live] == [(f"r{r:03d}", f"l{r + 40 if r + 40 < n else r}") for r in range(40)]
    assert {e.seq for e in ledger.live(spark, root, "u")} == {n}
    assert sum(name.endswith(".state") for name in ledger._names(spark, root)) == 2


def test_writers_at_once_lose_no_commit(spark):
    root = scratch_path(spark, "ledger")
    lock, real = threading.Lock(), ledger._publish

    def one_at_a_time(*args):  # the test's local files have no exclusive rename
        with lock:
            return real(*args)

    ledger._publish = one_at_a_time
    try:
        work = [threading.Thread(target=ledger.commit, args=(spark, root, [ledger.Entry("t", f"r{i}", "l", 1)])) for i in range(8)]
        for w in work:
            w.start()
        for w in work:
            w.join()
    finally:
        ledger._publish = real
    live = ledger.live(spark, root)
    assert len(live) == 8 and sorted(e.seq for e in live) == list(range(1, 9))


def test_catalog_follows_the_ledger(spark):
    root = scratch_path(spark, "catalog")
    db = catalog.register(spark, root)
    sql = lambda text, **args: catalog.query(spark, db, text, args)
    assert sql("SELECT * FROM alertes_prix").count() == 0
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()} >= set(K.DW_TABLES)
    for run, names in (("r1", "AB"), ("r2", "C"), ("r3", "")):
        rows = alerts(spark, *names) if names else alerts(spark, "x").limit(0)
        warehouse.load_table(rows, root, "alertes_prix", run, TS)
        assert catalog.register(spark, root) == db
    assert tickers(sql("SELECT * FROM alertes_prix")) == ["A", "B", "C"]
    assert sql("SELECT * FROM alertes_prix_dernier").count() == 0
    assert sql("SELECT * FROM alertes_prix").columns == warehouse.table_schema("alertes_prix").names
    warehouse.load_table(alerts(spark, "D"), root, "alertes_prix", "r1", TS)
    warehouse.load_table(alerts(spark, "x").limit(0), root, "alertes_prix", "r2", TS)
    catalog.register(spark, root)
    assert tickers(sql("SELECT * FROM alertes_prix")) == ["D"]
    assert catalog.registered(spark, db, "alertes_prix") == {"r1"}
    plan = sql("SELECT * FROM alertes_prix WHERE run_id = :run", run="r1")._jdf.queryExecution().toString()
    assert "CatalogFileIndex" in plan or "PartitionFilters" in plan
    assert spark.catalog.currentDatabase() == "default"


def test_values_are_bound_not_pasted(spark):
    root = scratch_path(spark, "catalog")
    rows = spark.createDataFrame([("A", "crypto", 1.0), ("B", "l'or", 2.0), ("C", None, None)],
                                 "ticker string, categorie string, variation_pct double")
    warehouse.load_table(rows, root, K.HISTORY_TABLE, "r1", TS)
    db = catalog.register(spark, root)
    assert tickers(catalog.ask(spark, db, "prix_categorie", categorie="l'or")) == ["B"]
    assert catalog.ask(spark, db, "prix_categorie", categorie="' OR '1'='1").count() == 0
    assert [r["ticker"] for r in catalog.ask(spark, db, "prix").collect()] == ["C", "B", "A"]
    for name in catalog.TEXTS:  # every question runs, also over empty tables
        args = {"prix_categorie": {"categorie": "x"}, "historique": {"ticker": "x"}}.get(name, {})
        catalog.ask(spark, db, name, **args).collect()
