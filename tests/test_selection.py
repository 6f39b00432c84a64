"""Exact median by narrowing ranges; ticker maps that are tables."""
import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from quotefuse.operators import kpis, normalize
from quotefuse.operators.quantile import exact_median, median_of, middle_values

INF = float("inf")


def values(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "_v double")


@pytest.mark.parametrize("n", [1, 2, 999, 4000])
@pytest.mark.parametrize("kind", ["spread", "ties", "one value", "two values"])
def test_rounds_of_buckets(spark, n, kind):
    rnd = random.Random(n)
    xs = {"spread": [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300) for _ in range(n)],
          "ties": [float(rnd.randint(0, 60)) if i % 3 else 7.0 for i in range(n)],
          "one value": [3.5] * n, "two values": [1.0] * (n // 2) + [2.0] * (n - n // 2)}[kind]
    # a coarse sketch and small rounds, so that several are needed
    found = middle_values(values(spark, xs + [None]), small=20, splitters=8, accuracy=20)
    assert median_of(found) == median(xs)


def test_infinite_values_and_nan(spark):
    assert median_of(middle_values(values(spark, [-INF, -INF, -INF, 1.0, INF]))) == -INF
    assert median_of(middle_values(values(spark, [INF] * 30 + [1.0] * 29), small=1, splitters=8)) == INF
    nan = float("nan")
    assert median_of(middle_values(values(spark, [nan, nan, 1.0, 2.0, 3.0]))) == 3.0  # NaN is the greatest
    assert math.isnan(median_of(middle_values(values(spark, [nan, nan, nan, 2.0]))))


def test_a_sketch_that_misses_the_middle_is_recovered(spark, monkeypatch):
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, q, a: real(c, [x / 4 for x in q] if len(q) == 2 else q, a))
    assert exact_median(values(spark, [float(i) for i in range(3001)]), "_v").first()[0] == 1500.0


def test_empty_and_null_only(spark):
    assert exact_median(values(spark, []), "_v").first()[0] is None
    assert exact_median(values(spark, [None, None]), "_v").first()[0] is None
    one = kpis.snapshot(spark.createDataFrame([(None,)], "variation_pct double")).collect()
    assert len(one) == 1 and one[0].total_actifs == 0 and one[0].actifs_en_hausse is None and one[0].variation_mediane is None


def test_splitters_do_not_grow_with_the_rows(spark, monkeypatch):
    asked = []
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, q, a: asked.append((len(q), a)) or real(c, q, a))
    for n in (2_000, 200_000):
        asked.append(n)
        assert exact_median(spark.range(n).selectExpr("cast(id as double) as x"), "x", small=10, splitters=16).first()[0] == (n - 1) / 2
    rounds = [x for x in asked if isinstance(x, tuple)]
    assert set(rounds) <= {(2, 10_000), (15, 160)} and len(rounds) < 8


def test_snapshot_reads_silver_twice(spark):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    silver = spark.range(0, 1000, 1, 3).selectExpr("cast(id % 37 as double) as variation_pct").mapInArrow(counted, "variation_pct double")
    got = kpis.snapshot(silver).collect()[0]
    assert rows.value == 2000 and got.total_actifs == 1000 and got.variation_mediane == 18.0


QUOTES = [("a", "USD"), ("a", "USD"), ("b", "GBP"), (None, "GBP"), ("z", None), ("", "USD")] + [("hot", "USD")] * 500
MAP = [("a", "A2"), ("a", "A1.PA"), ("b", "B"), ("b", None), (None, "N"), ("c", "C"), ("z", None), ("hot", "H.PA"), ("hot", "H.PA")]
WANT = sorted([("A1.PA", "EUR")] * 2 + [("B", "GBP"), ("z", ""), ("", "USD"), ("None", "GBP")] + [("H.PA", "EUR")] * 500)


@pytest.mark.parametrize("broadcast_rows", [0, 1, 3, 100])
def test_mapping_table(spark, broadcast_rows):
    df = spark.createDataFrame([(t, d, i) for i, (t, d) in enumerate(QUOTES)], "ticker string, devise string, alias int")
    out = normalize.tickers(df, spark.createDataFrame(MAP, "alias string, ticker string"), broadcast_rows)
    assert out.columns == ["ticker", "devise", "alias"]
    got = out.collect()
    assert sorted((str(r.ticker), r.devise or "") for r in got) == WANT and len({r.alias for r in got}) == len(QUOTES)


def test_empty_mapping_and_no_ticker(spark):
    empty = spark.createDataFrame([], "alias string, ticker string")
    df = spark.createDataFrame([("x.PA", "USD")], "ticker string, devise string")
    assert normalize.tickers(df, empty).collect()[0].devise == "EUR"
    assert normalize.tickers(df.drop("ticker"), empty).columns == ["devise"]


def test_a_large_mapping_is_no_literal(spark):
    mapping = spark.range(1_000_000).selectExpr("concat('T', id) as alias", "concat('U', id) as ticker")
    df = spark.range(50).selectExpr("concat('T', id * 3) as ticker", "'USD' as devise")
    out = normalize.tickers(df, mapping, broadcast_rows=1000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 5000 and "broadcast" in plan  # of a million aliases 50 are used
    assert {r.ticker for r in out.collect()} == {f"U{3 * i}" for i in range(50)}
