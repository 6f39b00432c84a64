"""Re-runs, unreadable inputs and the CSV scan."""
import datetime as dt
import os

import pytest

from quotefuse import constants as K
from quotefuse.operators import quality
from quotefuse.plans import jobs, warehouse
from quotefuse.session import scratch_path, shared_dir
from quotefuse.sources import bronze

TS = dt.datetime(2024, 2, 1, 10, 0, 0)
ALERT = "ticker string, variation_pct double"


def test_reload_without_rows_leaves_none(spark):
    root = scratch_path(spark, "reload")
    some = spark.createDataFrame([("A", 5.0)], ALERT)
    for run in ("r1", "r2"):
        assert warehouse.load_table(some, root, "alertes_prix", run, TS) == 1
    assert warehouse.load_table(some.limit(0), root, "alertes_prix", "r1", TS) == 0
    assert [r["run_id"] for r in warehouse.read_table(spark, root, "alertes_prix").collect()] == ["r2"]
    zone = scratch_path(spark, "zone")
    warehouse.save_snapshot(some, zone, "t", "r1", export=("csv", "json"))
    assert spark.read.option("header", "true").csv(f"{zone}/t_latest_csv").count() == 1
    assert spark.read.json(f"{zone}/t_latest_json").count() == 1
    warehouse.save_snapshot(some.limit(0), zone, "t", "r1")
    assert warehouse.read_zone(spark, f"{zone}/t", some.schema).count() == 0
    assert warehouse.read_zone(spark, f"{zone}/t_latest", some.schema).count() == 0


def test_only_a_missing_path_reads_as_empty(spark):
    assert warehouse.read_table(spark, scratch_path(spark, "none"), "alertes_prix").count() == 0
    with pytest.raises(Exception, match="(?i)filesystem|scheme"):
        warehouse.read_table(spark, "nosuchfs://x/y", "alertes_prix").count()


def test_missing_table_is_an_error_row(spark):
    root = scratch_path(spark, "dw")
    warehouse.create_tables(spark, root, K.DW_TABLES[:-1])
    rows = quality.warehouse_checks(spark, root).collect()
    assert [r["table_name"] for r in rows if r["section"] == K.DW_ERROR] == [K.DW_TABLES[-1]]
    empty = next(r for r in rows if r["section"] == K.DW_RULE_EMPTY)
    assert empty["nb"] == len(K.DW_TABLES) - 1 and K.DW_TABLES[0] in empty["table_name"]


def test_machine_local_scratch_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_csv_files_are_read_by_their_own_header(spark):
    folder = scratch_path(spark, "csv").removeprefix("file:")
    write(folder, "collecte_20240101_100000.csv", "ticker,prix,devise\nA,1.5,EUR\nB,NA,USD\n")
    write(folder, "lot b_20240101_110000.csv", 'devise,ticker,prix,nom\r\nEUR,C,2,"say ""hi"", ok"\r\nUSD,D,3,"two\nlines"\r\n')
    write(folder, "vide.csv", "")
    rows = {r["ticker"]: r for r in bronze.scan_bronze(spark, [folder, folder + "/absent"]).collect()}
    assert {t: (r["prix"], r["devise"]) for t, r in rows.items()} == {
        "A": ("1.5", "EUR"), "B": (None, "USD"), "C": ("2", "EUR"), "D": ("3", "USD")}
    assert rows["C"]["nom"] == 'say "hi", ok' and rows["D"]["nom"] == "two\nlines" and rows["A"]["nom"] is None
    assert rows["A"]["fichier_source"] == "collecte_20240101_100000.csv"
    assert [p.rsplit("/", 1)[1] for p in bronze.skipped_files(spark, [folder, folder + "/absent"])] == ["vide.csv"]
    none = bronze.scan_bronze(spark, [folder + "/absent"])
    assert none.count() == 0 and "ticker" in none.columns
    assert bronze.scan_bronze(spark, []).count() == 0


def test_silver_job_reads_csv_snapshots(spark):
    root = scratch_path(spark, "csv-job")
    folder = scratch_path(spark, "csv-in").removeprefix("file:")
    head = "ticker,prix,variation_pct,devise,categorie,source,statut\n"
    write(folder, "collecte_20240101_100000.csv", head + "A,1,2,USD,action,yahoo_finance,succes\n")
    write(folder, "collecte_20240102_100000.csv", head + "A,7,2,USD,action,yahoo_finance,succes\n")
    cfg = jobs.Config(root=root, bronze_csv=(folder,))
    jobs.silver(spark, cfg, TS)
    assert [(r["ticker"], r["prix"]) for r in jobs.read_silver(spark, cfg).collect()] == [("A", 7.0)]


def test_empty_landing_runs_through(spark):
    cfg = jobs.Config(root=scratch_path(spark, "nothing"))
    out = jobs.run_all(spark, cfg, TS)
    assert out["collect"]["nb_succes"] == 0 and out["collect"]["sources_absentes"] == list(jobs.SOURCES)
    assert out["silver"] == {"nb_avant": 0, "nb_apres": 0} and out["load"][K.HISTORY_TABLE] == 0
    assert out["archive"]["nb_erreurs"] == 0


def test_unreadable_items_and_unknown_tickers_are_kept(spark):
    root = scratch_path(spark, "bad")
    local = root.removeprefix("file:")
    write(f"{local}/landing/coingecko", "a.json", '{"symbol": "btc", "current_price": "5"}\n{"symbol": oops\n')
    write(f"{local}/landing/yahoo", "a.json", '{"ticker": "ZZZ", "last_price": "3", "previous_close": "2"}\n')
    write(f"{local}/landing/fear_greed", "a.json", '{"data": [{"value": "40", "value_classification": "Fear"}]}\n')
    got = jobs.collect(spark, jobs.Config(root=root), TS)
    assert (got["nb_succes"], got["nb_erreurs"]) == (2, 1)
    assert got["sources_absentes"] == ["binance", "boursorama"] and got["fear_greed_valeur"] == 40
    rows = spark.read.parquet(f"{root}/bronze/collecte").collect()
    bad = next(r for r in rows if r["statut"] == K.STATUS_ERROR)
    assert bad["source"] == "coingecko" and bad["erreur_msg"].startswith(K.MSG_JSON + '{"symbol": oops')
    assert next(r for r in rows if r["ticker"] == "ZZZ")["categorie"] is None


def test_quality_document_has_date_rows_and_summary(spark):
    root = scratch_path(spark, "doc")
    cfg = jobs.Config(root=root)
    jobs.run_all(spark, cfg, TS)
    import json
    docs = [json.loads(r["value"]) for r in spark.read.text(f"{root}/logs/quality_report").collect()]
    last = next(d for d in docs if "resume" in d)
    assert last["date_rapport"] == "2024-02-01 10:00:00" and last["resume"]["statut_global"] in ("OK", "WARN", "FAIL")
    assert any(d.get("nb_lignes") is not None for d in docs if d.get("couche") == "silver")


def tree(folder):
    return {os.path.relpath(os.path.join(d, n), folder): open(os.path.join(d, n), "rb").read()
            for d, _, names in os.walk(folder) for n in names if n[:1] not in "_."}


def test_archive_is_byte_exact_with_an_outcome_per_file(spark):
    from quotefuse.plans import archiving
    root = scratch_path(spark, "copy")
    local = root.removeprefix("file:")
    write(f"{local}/in/a", "x y.json", "é\n" * 3_000_000)
    write(f"{local}/in", "empty.csv", "")
    write(f"{local}/in", "_SUCCESS", "")
    os.symlink(f"{local}/nowhere", f"{local}/in/broken.json")
    assert [b for _, b in archiving.listed(spark, f"{root}/in/a")] == ["x y.json"]
    pairs = [(f"{root}/in/{n}", f"{root}/out/{n}") for n in ("a/x y.json", "empty.csv", "broken.json")]
    rows = {r["cible"].rsplit("/", 1)[1]: r for r in archiving.copy_files(spark, pairs).collect()}
    assert rows["x y.json"]["octets"] == 9_000_000 and rows["broken.json"]["erreur"] and rows["empty.csv"]["octets"] == 0
    assert tree(f"{local}/out") == {"empty.csv": b"", "a/x y.json": "é\n".encode() * 3_000_000}
    assert archiving.counts(archiving.copy_files(spark, pairs)) == {"nb_ok": 2, "nb_erreurs": 1, "octets": 9_000_000}


def test_archive_of_a_day_holds_its_last_run(spark):
    root = scratch_path(spark, "archive-day")
    local = root.removeprefix("file:")
    write(f"{local}/landing/coingecko", "a.json", '{"symbol": "btc", "current_price": "5", "price_change_percentage_24h": "2"}\n')
    cfg = jobs.Config(root=root, sources=("coingecko",))
    first = jobs.run_all(spark, cfg, TS)
    day = f"{local}/archive/2024/02/01"
    assert first["archive"]["nb_erreurs"] == 0 and tree(f"{day}/raw") == tree(f"{local}/landing")
    for zone, name in (("silver", "silver_latest"), ("gold", "top_mouvements_latest")):
        assert tree(f"{day}/processed/{name}") == tree(f"{local}/{zone}/{name}")
    assert set(tree(f"{day}/logs")) == set(tree(f"{local}/logs"))
    assert first["archive"]["octets"] == sum(map(len, tree(day).values()))
    os.rename(f"{local}/landing", f"{local}/landed")
    second = jobs.run_all(spark, cfg, TS)
    assert not tree(f"{day}/raw") and tree(f"{day}/processed/silver_latest") == tree(f"{local}/silver/silver_latest")
    assert second["archive"]["nb_erreurs"] == 0


def test_archive_of_an_empty_day_removes_the_rows(spark):
    root = scratch_path(spark, "archive-empty")
    some = spark.createDataFrame([("A", 5.0)], ALERT)
    assert warehouse.archive(some, root, TS).count() == 1
    assert warehouse.archive(some, root, dt.datetime(2024, 2, 2)).count() == 2
    assert warehouse.archive(some.limit(0), root, TS).count() == 1
