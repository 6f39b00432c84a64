"""The stored fusion state equals the full fusion over any sequence of runs, and
an update reads new runs only."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from quotefuse.operators import fuse
from quotefuse.plans import fusion_state, jobs, ledger, warehouse
from quotefuse.session import scratch_path

SCHEMA = ("ticker string, categorie string, source string, statut string, prix double, volume double, "
          "capitalisation double, run_id string, _qf_key struct<run: long, seq: long>")
SOURCES = ("binance", "coingecko", "yahoo_finance", "boursorama", "autre")
CATEGORIES = ("crypto", "action_fr", "action", "indice", "fonds", None)


def some_rows(rng, run):
    out = []
    for seq in range(rng.randrange(0, 14)):
        pick = lambda *x: rng.choice(x)
        out.append((pick("A", "B", None), pick(*CATEGORIES), pick(*SOURCES), pick("succes", "erreur", None), rng.random(),
                    pick(None, rng.random()), pick(None, rng.random()), run, (-int(run), seq)))
    return out


@pytest.mark.parametrize("seed, keep", [(0, 48), (1, 48), (2, 2), (3, 1)])
def test_any_sequence_equals_the_full_fusion(spark, seed, keep):
    rng = random.Random(seed)
    root = scratch_path(spark, "state")
    bronze, version = {}, 0
    for _ in range(9):
        for _ in range(rng.choice((1, 1, 2))):  # new, late, repeated and emptied runs
            run = f"{rng.randrange(100, 108)}"
            version += 1
            bronze[run] = (str(version), some_rows(rng, run))
        if bronze and rng.random() < 0.2:
            bronze.pop(rng.choice(sorted(bronze)))
        read = []

        def rows(some):
            read.extend(some)
            return spark.createDataFrame([r for x in some for r in bronze[x][1]], SCHEMA)

        got, done = fusion_state.fused(spark, root, {r: v for r, (v, _) in bronze.items()}, rows, "_qf_key", keep)
        every = spark.createDataFrame([r for _, x in bronze.values() for r in x], SCHEMA)
        want = fuse.fuse(every.drop("run_id"), "_qf_key")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert sorted(read) == done["lus"]
        _, again = fusion_state.fused(spark, root, {r: v for r, (v, _) in bronze.items()}, rows, "_qf_key", keep)
        assert again["lus"] == []


def test_a_new_run_merges_one_state(spark):
    rng, root, bronze = random.Random(9), scratch_path(spark, "state"), {}
    seen = {}
    for run, version in (("101", "a"), ("102", "a"), ("104", "a"), ("103", "a"), ("103", "b"), ("104", "b"), ("104", "c")):
        bronze[run] = (version, some_rows(rng, run) or some_rows(rng, run))
        rows = lambda some: spark.createDataFrame([r for x in some for r in bronze[x][1]], SCHEMA)
        _, seen[run + version] = fusion_state.fused(spark, root, {r: v for r, (v, _) in bronze.items()}, rows, "_qf_key")
    assert [seen[k]["lus"] for k in ("102a", "103a", "103b", "104b")] == [["102"], ["103"], ["103"], ["104"]]
    assert all(seen[k]["fusionnes"] == [] for k in ("102a", "104a", "103a", "103b"))  # the last run again: the state before it
    assert seen["104b"]["fusionnes"] == ["103"] == seen["104c"]["fusionnes"]  # an older one: from before it came first


TS = [dt.datetime(2024, 2, 1, h) for h in (10, 11, 12, 13)]


def land(spark, root, price, coin="btc"):
    spark.createDataFrame([(coin, str(price))], "symbol string, current_price string").withColumn(
        "price_change_percentage_24h", F.lit("2")).write.mode("overwrite").json(f"{root}/landing/coingecko")


def test_silver_job_reads_the_new_run_only(spark, monkeypatch):
    root = scratch_path(spark, "state-job")
    cfg = jobs.Config(root=root, sources=("coingecko",))
    read, real = [], jobs.bronze_quotes

    def watched(spark, cfg, runs=None):
        df = real(spark, cfg, runs)
        if runs:
            plan = df._jdf.queryExecution().executedPlan().toString()
            read.append((runs, re.findall(r"PartitionFilters: \[isnotnull\(run_id#\d+\), \(run_id#\d+ = (\w+)\)\]", plan)))
        return df

    monkeypatch.setattr(jobs, "bronze_quotes", watched)
    full = jobs.Config(root=root, sources=("coingecko",), incremental=False)
    for ts, price in ((TS[0], 1), (TS[2], 3), (TS[1], 2), (TS[2], 5), (TS[3], 7)):  # late and repeated runs
        land(spark, root, price)
        jobs.collect(spark, cfg, ts)
        read.clear()
        jobs.silver(spark, cfg, ts)
        run = jobs.run_id_of(ts)
        assert read == [([run], [run])]
        got = [tuple(r) for r in jobs.read_silver(spark, cfg).collect()]
        jobs.silver(spark, full, ts)
        assert got == [tuple(r) for r in jobs.read_silver(spark, cfg).collect()] and got
    assert got[0][2] == 7.0
    land(spark, root, 9, coin="eth")
    warehouse.save_snapshot(jobs.read_bronze(spark, cfg).limit(0).drop("run_id", jobs.SNAPSHOT), f"{root}/bronze", "collecte", jobs.run_id_of(TS[3]))
    ledger.commit(spark, f"{root}/bronze", [ledger.Entry("collecte", jobs.run_id_of(TS[3]), "vide", 0)])
    jobs.silver(spark, cfg, TS[3])
    assert [r["prix"] for r in jobs.read_silver(spark, cfg).collect()] == [5.0]
