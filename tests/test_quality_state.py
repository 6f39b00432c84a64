"""The hourly quality report reads new files only and equals the full one."""
import datetime as dt

from quotefuse.operators import quality as dq
from quotefuse.plans import jobs, ledger, run_state, warehouse
from quotefuse.session import scratch_path

TS = [dt.datetime(2024, 2, 1, h) for h in (10, 11, 12)]


def land(spark, root, *prices):
    rows = [(c, str(p), "2") for c, p in zip(("btc", "eth", "btc"), prices)]
    spark.createDataFrame(rows, "symbol string, current_price string, price_change_percentage_24h string").write.mode(
        "overwrite").json(f"{root}/landing/coingecko")


def key(rows):
    return sorted(map(str, rows.select("couche", "table_name", "section", "regle", "nb", "pct", "statut").collect()))


def test_only_new_files_are_read(spark, monkeypatch):
    root = scratch_path(spark, "quality")
    cfg, read, real = jobs.Config(root=root, sources=("coingecko",)), [], jobs.checked_bronze

    def watched(spark, cfg, runs=None):
        read.extend(runs or [])
        return real(spark, cfg, runs)

    monkeypatch.setattr(jobs, "checked_bronze", watched)
    history, real_runs = [], warehouse.read_runs

    def watched_runs(spark, root, table, runs):
        history.extend(runs or [])
        return real_runs(spark, root, table, runs)

    monkeypatch.setattr(warehouse, "read_runs", watched_runs)
    for ts, prices in ((TS[0], (1, -2, 3)), (TS[2], (4,)), (TS[1], (5, "abc")), (TS[2], (6, 7, 8))):
        land(spark, root, *prices)
        jobs.collect(spark, cfg, ts)
        jobs.silver(spark, cfg, ts)
        jobs.gold(spark, cfg, ts)
        jobs.load(spark, cfg, ts)
        read.clear()
        history.clear()
        status = jobs.quality(spark, cfg, ts).collect()[0]
        assert read == [jobs.run_id_of(ts)] and history == [jobs.run_id_of(ts)]
        full = dq.report(real(spark, cfg), None, "bronze", by="fichier_source")
        saved = spark.read.parquet(f"{root}/logs/quality").where(f"run_id = '{jobs.run_id_of(ts)}'")
        assert key(saved.where("couche = 'bronze'")) == key(full)
        assert key(saved.where("couche = 'dw'")) == key(dq.warehouse_checks(spark, f"{root}/dw"))
        assert status["statut_global"] in ("OK", "WARN", "FAIL")
    sizes = {r["table_name"]: r["nb_lignes"] for r in dq.counts_of(saved.where("couche = 'bronze'")).collect()}
    assert sizes == {f"collecte_{jobs.run_id_of(t)}.parquet": n for t, n in zip(TS, (3, 2, 3))}


def test_results_of_many_runs_are_folded(spark, monkeypatch):
    monkeypatch.setattr(run_state, "FOLDERS", 3)
    root = scratch_path(spark, "run-state")
    compute = lambda runs: spark.createDataFrame([(int(r), r) for r in runs], "nb long, run_id string")
    runs = {}
    for i in range(8):
        runs[str(i)] = "a"
        got, done = run_state.update(spark, root, "x", runs, compute)
        assert done == [str(i)] and sorted(r["nb"] for r in got.collect()) == list(range(i + 1))
        assert len({e.load_id for e in ledger.live(spark, root, "x")}) <= 3
    runs.pop("3")
    got, done = run_state.update(spark, root, "x", {**runs, "5": "b"}, lambda some: spark.createDataFrame(
        [(50, r) for r in some], "nb long, run_id string"))
    assert done == ["5"] and sorted(r["nb"] for r in got.collect()) == [0, 1, 2, 4, 6, 7, 50]
    assert run_state.read(spark, scratch_path(spark, "none"), "x", got.drop("run_id").schema).count() == 0
