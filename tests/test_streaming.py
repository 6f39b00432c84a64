"""Streaming = batch: the file source drained with availableNow gives the
batch result; restarting from the checkpoint adds nothing."""
import uuid

from pyspark.sql import functions as F

from quotefuse.session import scratch_path
from quotefuse.sources import fixtures
from quotefuse.streaming import ticks


def test_stream_equals_batch_and_restart_is_idempotent(spark, sf_small):
    msgs = fixtures.tick_messages(spark, sf_small)
    land = scratch_path(spark, "ticks-landing")
    msgs.select("value", "timestamp").write.parquet(land)
    out, ckpt = scratch_path(spark, "ticks-out"), scratch_path(spark, "ticks-ckpt")
    src = spark.readStream.schema("value string, timestamp timestamp_ntz").option(
        "maxFilesPerTrigger", 1).parquet(land)
    ts = F.col("timestamp")
    q = ticks.start(spark, src, out, ckpt, ts=ts)
    q.awaitTermination()
    batch = ticks.parse_ticks(spark.read.parquet(land), ts=ts)
    got = ticks.read_sink(spark, out).drop("jour")
    assert got.count() == batch.count() == ticks.processed_count(spark, out)
    assert got.exceptAll(batch).count() == 0
    found = ticks.read_sink(spark, out, ticks.ALERTS).drop("jour")
    assert found.count() == ticks.alerts(batch).count() and found.exceptAll(ticks.alerts(batch)).count() == 0
    q2 = ticks.start(spark, src, out, ckpt, ts=ts)   # restart: nothing new
    q2.awaitTermination()
    assert ticks.read_sink(spark, out).count() == batch.count()


def test_count_is_not_limited_to_recent_progress(spark):
    """More batches than a query keeps progress reports of; one directory a day."""
    msg = '{"e": "24hrTicker", "s": "A", "c": "%d", "P": "3", "v": "1", "h": "1", "l": "1", "o": "1"}'
    land, out, ckpt = (scratch_path(spark, n) for n in ("many-in", "many-out", "many-ckpt"))
    n = 8
    spark.range(0, n, 1, n).selectExpr(f"format_string('{msg}', id) as value").write.text(land)
    src = spark.readStream.option("maxFilesPerTrigger", 1).text(land)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    kept = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        q = ticks.start(spark, src, out, ckpt)
        q.awaitTermination()
        assert len(q.recentProgress) <= 3
    finally:
        spark.conf.set(key, kept)
    assert ticks.processed_count(spark, out) == n
    assert ticks.read_sink(spark, out).select("jour").distinct().count() <= 2


def test_default_stamp_is_utc_in_any_session_zone(spark):
    import datetime as dt
    msg = '{"e": "24hrTicker", "s": "A", "c": "1", "P": "3", "v": "1", "h": "1", "l": "1", "o": "1"}'
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("Asia/Tokyo", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", z)
            t = ticks.with_day(ticks.parse_ticks(spark.createDataFrame([(msg,)], "value string"))).collect()[0]
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            assert abs((now - dt.datetime.fromisoformat(t["timestamp"])).total_seconds()) < 120
            assert t["jour"] == t["timestamp"][:10].replace("-", "")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


TICK_ROW = ("A", 1.0, 1.0, 1.0, 1.0, 1.0, 9.0, "binance_ws", "crypto")


def some_ticks(spark, *stamps):
    from quotefuse.schemas import TICK
    return spark.createDataFrame([(*TICK_ROW, s) for s in stamps], TICK)


def test_a_replayed_batch_doubles_nothing(spark, monkeypatch):
    """Both sinks are committed together: a batch that fails between them leaves
    neither, and its replay writes both once."""
    import pytest
    from quotefuse.plans import ledger
    out = scratch_path(spark, "replay")
    batch = some_ticks(spark, "2024-01-31T23:59:59.000000", "2024-02-01T00:00:00.000000")
    real = ticks.alerts
    monkeypatch.setattr(ticks, "alerts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ticks.write_batch(batch, 0, out, "s")
    assert ticks.processed_count(spark, out) == 0 and ticks.read_sink(spark, out).count() == 0
    monkeypatch.setattr(ticks, "alerts", real)
    for _ in range(3):
        ticks.write_batch(batch, 0, out, "s")
    ticks.write_batch(batch.limit(0), 1, out, "s")
    ticks.write_batch(batch, 0, out, "another stream of the same folder")
    for table in (ticks.TICKS, ticks.ALERTS):
        assert ticks.read_sink(spark, out, table).count() == 4
        assert ticks.read_sink(spark, out, table, "20240201").count() == 2
    assert ticks.processed_count(spark, out) == 4
    assert {e.run_id: e.nb_lignes for e in ledger.live(spark, out, ticks.LOTS)}["s"] == 1


def test_finished_days_are_merged_while_a_stream_goes_on(spark):
    out = scratch_path(spark, "merge")
    for i in range(5):
        ticks.write_batch(some_ticks(spark, f"2024-01-31T10:00:0{i}.000000", f"2024-02-01T10:00:0{i}.000000"), i, out, "s")
    reader = ticks.read_sink(spark, out)
    rows = sorted(map(str, reader.collect()))
    assert ticks.merge_days(spark, out, "20240201") == {"20240131": 10}
    ticks.write_batch(some_ticks(spark, "2024-02-01T11:00:00.000000"), 5, out, "s")
    assert sorted(map(str, reader.collect())) == rows  # listed before the swap
    assert len(ticks.read_sink(spark, out, day="20240131").inputFiles()) == 1
    assert len(ticks.read_sink(spark, out, day="20240201").inputFiles()) >= 6
    assert ticks.read_sink(spark, out).count() == 11 == ticks.processed_count(spark, out)
    assert ticks.merge_days(spark, out, "20240201") == {}
    ticks.write_batch(some_ticks(spark, "2024-01-31T10:00:00.000000"), 6, out, "s")  # a late tick
    assert ticks.merge_days(spark, out, "20240301")["20240131"] == 4
    assert ticks.read_sink(spark, out).count() == 12 == ticks.processed_count(spark, out)
