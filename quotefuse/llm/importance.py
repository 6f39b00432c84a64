"""Importance resampling of documents towards a target corpus.

Features are the runs of 1 to ``n`` consecutive words (A-Z lower-cased, words
of ASCII letters, digits and anything beyond ASCII), joined by one space and
hashed by CRC-32 into ``buckets``. A bucket's gain is the log ratio of its
smoothed shares in the target and in the documents, in thousandths, floored; a
document's weight is the floored mean gain of its features. The draw is without
replacement by Gumbel noise that hangs on the seed and the id only: of the
documents with at least ``least_words`` words the ``percent`` with the highest
score (weight plus noise) are ranked 1, 2, 3, ...

Inside a task, Arrow kernels do the work: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``; shifted
dictionary indices make the longer runs, the CRC of a run is taken once for
every distinct (shorter run, next word) pair, and gains are taken by index and
summed by segments. Texts are scanned twice (counts, then weights) and never
shuffled; what is gathered is one number per bucket.

The ranks need no sort in one task: scores are integers of a bounded range
(gains lie within 1000 x ln of the corpus sizes, the noise within -3,200 and
22,200), so a histogram of scores gives the rank at which each score begins,
and only ties of one score are ordered together. The noise spreads every group
of like documents over thousands of scores; rows that repeat an id, with it the
noise, are collapsed into one row with a count before that.

Defined results: null and empty texts have no features, weight 0 and no rank;
a null id takes the noise of the empty id and comes last among ties; a repeated
row is drawn as often as it stands in the table; rows that tie in score and id
are ordered by weight, then features; an empty documents table gives an empty
result, an empty target only smoothing; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.llm.common import saved, text_slices

# fixed value: what stands between words
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COPIES = 10_000  # repeated rows are written out in parts of this many


def feature_buckets(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature, and the number of words of every row."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=GAP)
    words, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")
    words, rows = words.filter(real), rows.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.dictionary_encode()
    known = [w.encode("utf-8") for w in coded.dictionary.to_pylist()]
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    crc = np.fromiter((zlib.crc32(w) for w in known), dtype=np.int64, count=len(known))
    found = [(rows, crc[word] % buckets)]
    run = word  # the number of the run that starts at each word, -1 where the row ends before
    for k in range(2, n + 1):
        if len(word) < k:
            break
        fits = (rows[k - 1:] == rows[: len(rows) - k + 1]) & (run[: len(rows) - k + 1] >= 0)
        pairs = pa.array(run[: len(fits)][fits] * len(known) + word[k - 1:][fits]).dictionary_encode()
        distinct = pairs.dictionary.to_numpy(zero_copy_only=False)
        crc = np.fromiter((zlib.crc32(b" " + known[p % len(known)], int(crc[p // len(known)])) for p in distinct.tolist()),
                          dtype=np.int64, count=len(distinct))
        index = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found.append((rows[: len(fits)][fits], crc[index] % buckets))
        run = np.full(len(fits), -1, dtype=np.int64)
        run[fits] = index
    n_words = np.bincount(rows, minlength=len(texts))
    return np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found]), n_words


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts: one partial count per task."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in text_slices(batches, "text"):
            total += np.bincount(feature_buckets(b.column("text"), n, buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    got = (texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "bucket int, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # one row per bucket at most
    out = np.zeros(buckets, dtype=np.int64)
    for r in got:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored log ratios of the smoothed shares, in thousandths."""
    s, t, buckets = source.astype(np.float64), target.astype(np.float64), len(source)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        table = known.value
        for b in text_slices(batches, "text"):
            row, bucket, n_words = feature_buckets(b.column("text"), n, len(table))
            order = np.argsort(row, kind="stable") if n > 1 else slice(None)  # runs of one length follow each other
            features = np.bincount(row, minlength=b.num_rows)
            running = np.concatenate(([0], np.cumsum(table[bucket[order]])))
            stops = np.cumsum(features)
            total = running[stops] - running[stops - features]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(features, pa.int64()),
                 pa.array(total // np.maximum(features, 1), pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the seed and the id."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def first_ranks(scored: DataFrame) -> DataFrame:
    """(score, ahead): how many rows have a higher score. Sums over blocks of
    64 scores first, so that each window sees few rows of the histogram."""
    hist = scored.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.shiftright("score", 6))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    blocks = hist.groupBy("block").agg(F.sum("n").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    inside = Window.partitionBy("block").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    return (hist.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(blocks), "block")
            .select("score", (F.col("ahead") + F.col("before")).alias("ahead")))


def draw(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` (doc_id, n_words, n_features, weight, score; a stored table) with the rank of the drawn rows."""
    out = ["doc_id", "n_features", "weight", "score"]
    fit = scored.where(F.col("n_words") >= least_words)
    size = percent * fit.count() // 100
    ranks = saved(first_ranks(fit).where(F.col("ahead") < size), "score-ranks")
    lowest = ranks.agg(F.min("score")).first()[0]
    if lowest is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    chosen = (F.col("n_words") >= least_words) & (F.col("score") >= lowest)
    rows = scored.where(chosen).groupBy(*out).agg(F.count(F.lit(1)).alias("n"))
    ties = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "weight", "n_features").rowsBetween(
        Window.unboundedPreceding, -1)
    # the histogram of the drawn scores is bounded by their range: broadcast
    rows = rows.join(F.broadcast(ranks), "score").withColumn(
        "ahead", F.col("ahead") + F.coalesce(F.sum("n").over(ties), F.lit(0)))
    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    each = parts.withColumn("copy", F.explode(F.sequence("part", F.least(F.col("part") + COPIES, F.col("n")) - 1)))
    rank = F.col("ahead") + F.col("copy") + 1
    drawn = each.select(*out, F.when(rank <= size, rank).alias("rank"))
    return scored.where(~chosen).select(*out, F.lit(None).cast("long").alias("rank")).unionByName(drawn)


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10,
             least_words: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) for every row of ``docs``."""
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    scored = weigh(docs, gain, n).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(saved(scored, "importance"), percent, least_words)
