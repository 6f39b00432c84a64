"""Tick stream (R1-R5, K8, K9) with Structured Streaming.

All stream operators are stateless projections/filters, so the same
functions serve a static DataFrame (tests, backfills) and a streaming one.

One query feeds both sinks. Each micro-batch is parsed once and written as a lot
of ticks by UTC day; its alerts are filtered from the lot that was written; then
one commit of the ledger names the files of both with their rows. Readers see
both or neither, a batch replayed after a failure finds its number committed and
writes nothing, and the number of messages comes from the ledger. The lots of a
finished day are merged into few files by ``merge_days``, with one commit that
swaps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quotefuse import constants as K
from quotefuse.functions.scalar import iso_text, now_utc
from quotefuse.plans import ledger
from quotefuse.schemas import TICK, TICK_COLUMNS, TICK_ENVELOPE, struct

_REQUIRED = ("c", "P", "v", "h", "l", "o")


def parse_ticks(df: DataFrame, value_col: str = "value", ts: Column | None = None) -> DataFrame:
    """Exchange messages -> TICK rows.

    The payload is the ``data`` object of an envelope, or the message itself;
    only 24h-ticker events are kept; a message with any required field
    missing or not numeric is dropped (that message only). ``ts`` is the
    event time to stamp (default: processing time in UTC, as the producer does).
    """
    msg = F.from_json(F.col(value_col).cast("string"), TICK_ENVELOPE)
    tick = F.coalesce(msg["data"], F.struct(*[msg[f].alias(f) for f in ("e", "s", "c", "P", "v", "h", "l", "o")]))
    stamp = iso_text(ts if ts is not None else now_utc())
    t = df.select(tick.alias("t"), stamp.alias("timestamp"))
    nums = {f: F.col(f"t.{f}").try_cast("double") for f in _REQUIRED}
    out = t.where(F.col("t.e") == K.TICK_EVENT).select(
        F.col("t.s").alias("ticker"), nums["c"].alias("prix"), nums["o"].alias("prix_ouv"),
        nums["h"].alias("prix_haut"), nums["l"].alias("prix_bas"), nums["v"].alias("volume"),
        nums["P"].alias("variation_pct"), F.lit(K.SRC_BINANCE_WS).alias("source"),
        F.lit("crypto").alias("categorie"), "timestamp")
    required = ["ticker", "prix", "prix_ouv", "prix_haut", "prix_bas", "volume", "variation_pct"]
    return out.dropna(subset=required)


def to_kafka(ticks: DataFrame) -> DataFrame:
    """key = ticker, value = JSON of the TICK fields (K8)."""
    return ticks.select(F.col("ticker").alias("key"),
                        F.to_json(F.struct(*TICK_COLUMNS), {"ignoreNullFields": "false"}).alias("value"))


def read_ticks(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Message bus JSON -> TICK rows (R2)."""
    return df.select(F.from_json(F.col(value_col).cast("string"), TICK).alias("t")).select("t.*")


def alerts(ticks: DataFrame, threshold: float = K.ALERT_THRESHOLD) -> DataFrame:
    """|variation| >= threshold; NULL variation raises nothing."""
    v = F.col("variation_pct")
    return ticks.where(F.abs(v) >= float(threshold)).select(
        "ticker", F.when(v > 0, K.TICK_UP).otherwise(K.TICK_DOWN).alias("direction"),
        v.alias("variation_pct"), "prix", "timestamp")


def with_day(ticks: DataFrame) -> DataFrame:
    """UTC day of the tick stamp, 'yyyyMMdd' (K9 file-per-day)."""
    return ticks.withColumn("jour", F.replace(F.substring("timestamp", 1, 10), F.lit("-"), F.lit("")))


def arrow(ticks: DataFrame) -> DataFrame:
    """Rise/fall arrow per tick."""
    return ticks.withColumn("fleche", F.when(F.col("variation_pct") >= 0, K.ARROW_UP)
                            .otherwise(K.ARROW_DOWN))


def daily_counts(ticks: DataFrame) -> DataFrame:
    return with_day(ticks).groupBy("jour").agg(F.count(F.lit(1)).alias("nb_ticks"))


TICKS, ALERTS, LOTS = "ticks", "alertes", "lots"
ALERT_SCHEMA = struct(("ticker", T.StringType()), ("direction", T.StringType()), ("variation_pct", T.DoubleType()),
                      ("prix", T.DoubleType()), ("timestamp", T.StringType()))
DAY = T.StructField("jour", T.StringType())


def _schema(table: str) -> T.StructType:
    return T.StructType([*(TICK if table == TICKS else ALERT_SCHEMA).fields, DAY])


def _path(out: str, table: str, e: ledger.Entry) -> str:
    return f"{out}/{table}/{ledger.LOAD_COL}={e.load_id}/jour={e.run_id.partition('.')[0]}"


def _write_lot(df: DataFrame, out: str, table: str, lot: str) -> list[ledger.Entry]:
    """One table of a lot by day; an entry per day with its rows (days are few)."""
    target = f"{out}/{table}/{ledger.LOAD_COL}={lot}"
    df.write.partitionBy("jour").parquet(target)
    days = df.sparkSession.read.schema(_schema(table)).parquet(target).groupBy("jour").count().collect()
    return [ledger.Entry(table, f"{r['jour']}.{lot}", lot, r["count"]) for r in days]


def write_batch(ticks: DataFrame, batch_id: int, out: str, stream: str, threshold: float = K.ALERT_THRESHOLD) -> None:
    """Both sinks of one micro-batch of parsed ticks; a batch that is committed already is left alone."""
    spark = ticks.sparkSession
    done = {e.run_id: e.nb_lignes for e in ledger.live(spark, out, LOTS)}
    if done.get(stream, -1) >= batch_id:
        return
    lot = ledger.new_load()
    entries = _write_lot(with_day(ticks), out, TICKS, lot)
    if entries:  # the alerts of exactly what was written
        written = spark.read.schema(_schema(TICKS)).parquet(f"{out}/{TICKS}/{ledger.LOAD_COL}={lot}")
        entries += _write_lot(with_day(alerts(written, threshold)), out, ALERTS, lot)
    ledger.commit(spark, out, [*entries, ledger.Entry(LOTS, stream, lot, batch_id)])


def start(spark: SparkSession, source: DataFrame, out: str, checkpoint: str,
          trigger: dict | None = None, ts: Column | None = None,
          threshold: float = K.ALERT_THRESHOLD) -> StreamingQuery:
    """readStream (Kafka or file source with a ``value`` column) -> parse once ->
    ticks and alerts by day (R3, R4, K9). Kafka: ``spark.readStream.format('kafka')
    .option('subscribe', 'crypto-prices').option('startingOffsets', 'latest')``
    (the connector jar must be on the classpath)."""

    def both(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")  # the checkpoint's own id
        write_batch(batch, batch_id, out, stream or "", threshold)

    return (parse_ticks(source, ts=ts).writeStream.foreachBatch(both).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_sink(spark: SparkSession, out: str, table: str = TICKS, day: str | None = None) -> DataFrame:
    """The committed rows of a sink, of all days or one ('yyyyMMdd')."""
    found = [e for e in ledger.live(spark, out, table) if day in (None, e.run_id.partition(".")[0])]
    if not found:
        return spark.createDataFrame([], _schema(table))
    return (spark.read.schema(_schema(table)).option("basePath", f"{out}/{table}")
            .parquet(*[_path(out, table, e) for e in found]).drop(ledger.LOAD_COL))


def processed_count(spark: SparkSession, out: str) -> int:
    """Ticks processed so far, over all batches and restarts (R5): sums of the
    ledger, without reading the sink; also while a stream runs."""
    return sum(e.nb_lignes for e in ledger.live(spark, out, TICKS))


def merge_days(spark: SparkSession, out: str, before: str, file_bytes: int = 128 << 20) -> dict[str, int]:
    """Packs the lots of every day before ``before`` ('yyyyMMdd') into files of about
    ``file_bytes``; lots merged per day. One commit per day swaps the files of both sinks,
    so a running stream and readers are not disturbed; replaced files stay until removed."""
    days: dict[str, list[ledger.Entry]] = {}
    for e in ledger.live(spark, out):
        day = e.run_id.partition(".")[0]
        if e.table_name in (TICKS, ALERTS) and day < before:
            days.setdefault(day, []).append(e)
    merged = {}
    for day, lots in sorted(days.items()):
        new = []
        for table in (TICKS, ALERTS):
            old = [e for e in lots if e.table_name == table]
            if len(old) < 2:
                continue
            fs, p = ledger._fs(spark, out)  # noqa: SLF001
            size = sum(fs.getContentSummary(ledger._fs(spark, _path(out, table, e))[1]).getLength() for e in old)  # noqa: SLF001
            rows = spark.read.schema(_schema(table)).option("basePath", f"{out}/{table}").parquet(
                *[_path(out, table, e) for e in old]).drop(ledger.LOAD_COL)
            written = _write_lot(rows.repartition(max(1, -(-size // file_bytes))), out, table, ledger.new_load())
            if sum(e.nb_lignes for e in written) != sum(e.nb_lignes for e in old):
                raise RuntimeError(f"{table} of {day}: merged files hold other rows than the lots")
            new += [*written, *(ledger.Entry(table, e.run_id, e.load_id, ledger.GONE) for e in old)]
            merged[day] = merged.get(day, 0) + len(old)
        if new:
            ledger.commit(spark, out, new)
    return merged
