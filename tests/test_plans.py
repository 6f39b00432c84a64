"""Physical-plan checks: one exchange for fusion, top-k operator, no Python."""
import __spark_entry__ as E
from quotefuse.operators import fuse, kpis
from quotefuse.plans import pipeline as P
from quotefuse.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges_above_scan(plan_text):
    return plan_text.count("Exchange hashpartitioning(_qf_cat")


def test_fusion_single_shuffle(spark, sf_small):
    b = spark.read.parquet(f"{sf_small}/events.parquet").selectExpr(
        "event_id", "concat('T', user_id) AS ticker", "'crypto' AS categorie",
        "CASE WHEN event_id % 2 = 0 THEN 'binance' ELSE 'coingecko' END AS source",
        "value AS prix")
    f = fuse.fuse(b, "event_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(f)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1
    assert "SortAggregate" in plan or "HashAggregate" in plan


def test_topk_uses_take_ordered(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(kpis.top_crypto(P.clean_ev(spark, sf_small)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "TakeOrderedAndProject" in plan


def test_no_python_evaluation_anywhere(spark, sf_small):
    from quotefuse.plans.registry import REGISTRY
    for name, q in REGISTRY.items():
        plan = _plan(q(spark, sf_small))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                     "PythonUDF"):
            assert node not in plan, (name, node)


def test_latest_run_report_prunes_partitions(spark, sf_small):
    from quotefuse.operators import reports
    root = P.fixture_warehouse(spark, sf_small)
    report = reports.prices_by_category(spark, root, "crypto")
    plan, files = _plan(report), report.inputFiles()
    assert files and all("run_id=20240131_235959/load_id=" in f for f in files)
    assert "EqualTo(categorie,crypto)" in plan


def _static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lag_without_hot_keys_is_one_exchange(spark, sf_small):
    from quotefuse.operators.sequence import lag_by_key
    from quotefuse.sources import fixtures
    d = lag_by_key(fixtures.events(spark, sf_small), "user_id", ["ts", "event_id"], "value", "prev")
    plan = _static_plan(spark, d)
    width = spark.conf.get("spark.sql.shuffle.partitions")
    assert plan.count("Exchange") == 1
    assert "hashpartitioning(user_id#" in plan and f", {width})" in plan
    assert plan.count("Window [") == 1


def test_lag_with_hot_key_windows_all_rows_once(spark):
    import random
    from quotefuse.operators.sequence import lag_by_key
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, rnd.choice([0, 0, 0, 1, 2]), rnd.randint(0, 30), float(i))
                                for i in range(300)], "id long, k long, t long, v double")
    small = _static_plan(spark, lag_by_key(df, "k", ["t", "id"], "v", "prev", hot_rows=5, chunks=4))
    # one window over all rows + one over the (key, chunk) carry table
    assert small.count("Window [") == 2
    assert "BroadcastHashJoin" in small
    big = _static_plan(spark, lag_by_key(df, "k", ["t", "id"], "v", "prev", hot_rows=5, chunks=4,
                                         broadcast_rows=0))
    # fallback above the bound: the window output feeds three branches
    assert big.count("Window [") == 4


def test_queries_without_the_previous_close_have_no_window(spark, sf_small):
    from quotefuse.plans.registry import REGISTRY
    for key in ("map_tickers", "dq_duplicates", "collect_summary", "normalize_currency"):
        plan = _static_plan(spark, REGISTRY[key](spark, sf_small))
        assert "Window [" not in plan and "/events.parquet" in plan and "quote-events" not in plan, key


def test_family_filter_is_below_the_fusion(spark, sf_small):
    from quotefuse.plans.registry import REGISTRY
    for key in ("fuse_crypto", "fuse_preferred"):
        plan = _static_plan(spark, REGISTRY[key](spark, sf_small))
        bottom = plan[plan.rindex("Aggregate("):]
        assert "Filter" in bottom and plan.count("(key=[_qf_cat") == 2, key


def test_snapshot_reads_silver_once(spark):
    from quotefuse.operators import kpis
    path = scratch_path(spark, "silver")
    spark.range(1000).selectExpr("cast(id % 37 as double) as variation_pct").write.parquet(path)
    plan = _static_plan(spark, kpis.snapshot(spark.read.parquet(path)))
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= 1


def test_hot_null_key_is_chunked(spark):
    from quotefuse.operators.sequence import lag_by_key
    df = spark.createDataFrame([(i, None if i % 3 else i % 5, i // 2, float(i)) for i in range(300)],
                               "id long, k long, t long, v double")
    got = {r["id"]: r["prev"] for r in lag_by_key(df, "k", ["t", "id"], "v", "prev", hot_rows=50, chunks=4).collect()}
    last = {}
    for i in range(300):
        k = None if i % 3 else i % 5
        assert got[i] == last.get(k, None)
        last[k] = float(i)
    plan = _static_plan(spark, lag_by_key(df, "k", ["t", "id"], "v", "prev", hot_rows=50, chunks=4))
    assert "coalesce(k#" in plan  # the chunk join is null-safe


def test_latest_run_needs_no_job(spark, sf_small):
    from quotefuse.plans import warehouse
    root = P.fixture_warehouse(spark, sf_small)
    assert warehouse.latest_run(spark, root, "alertes_prix") == "20240131_235959"
    assert warehouse.latest_run(spark, root, "absent") is None
