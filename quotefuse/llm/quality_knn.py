"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms are hashed byte trigrams of the whole text plus marks for repeated
words; weights are log(1 + tf) * idf with document frequencies over all
documents. A truncated SVD of a bounded labelled sample (at most
``per_label`` rows of each label value, picked by a hash of the id) gives the
latent space; the sample's unit vectors are broadcast. Every document is
projected, its exact cosines with all labelled vectors are computed block by
block, and the labels of its ``k`` nearest neighbours vote, each weighted by
its similarity.

Defined results: null counts as empty text; an empty text has no neighbours
and takes the mean label of the sample; without any learnable label the score
is 0.5; labels other than 0 and 1 and null labels are not learned from; a
document labelled twice votes with each label; ties in similarity go to the
smaller hash rank; a null id is scored, not held out and not learned from;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import fold_of

TERMS = 2048
MARKS = 8  # the last terms: how often a word equals an earlier neighbour
BATCH = 256
BLOCK = 1024


def counts(text: str) -> np.ndarray:
    """Term counts of a whole text."""
    data = text.encode("utf-8", "replace")
    out = np.zeros(TERMS, dtype=np.float32)
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(b) >= 3:
        h = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        h *= np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out[: TERMS - MARKS] = np.bincount(h % np.uint32(TERMS - MARKS), minlength=TERMS - MARKS)
    # word starts and a number per word, to see repeats of nearby words
    space = b <= 32
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if len(b) else np.zeros(0, np.int64)
    if len(starts) > 1:
        run = np.concatenate(([0], np.cumsum(b.astype(np.uint64) * b)))
        ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
        word = (run[ends] - run[starts]) * np.uint64(64) + (ends - starts).astype(np.uint64)
        for lag in range(1, MARKS + 1):
            if len(word) > lag:
                same = np.count_nonzero(word[lag:] == word[:-lag])
                out[TERMS - MARKS + lag - 1] = len(word) * (same > 0.5 * (len(word) - lag))
    return out


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(tf) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and the number of documents: one
    partial count per task and term, summed by Spark."""

    def count(batches):
        df, n = np.zeros(TERMS, dtype=np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                df += counts(t or "") > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1), pa.int32()), pa.array(np.append(df, n), pa.int64())], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(TERMS + 1, dtype=np.int64)
    for r in rows:
        out[r["term"]] = r["n"]
    return out[:TERMS], int(out[TERMS])


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, per_label: int) -> DataFrame:
    """Labelled documents to learn from: at most ``per_label`` of each label value."""
    rows = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
            .where((fold_of(F.col("doc_id"), folds) != held) & F.col("label").isin(0, 1)).distinct()
            .withColumn("h", F.xxhash64("doc_id")))
    part = [rows.where(F.col("label") == v).orderBy("h", "doc_id").limit(per_label) for v in (0, 1)]
    picked = part[0].unionByName(part[1])
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    # an id counts once per label, by its text of least hash, however many rows carry it
    return rows.groupBy("doc_id", "label", "h").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def latent(x: np.ndarray, rank: int, seed: int = 7, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors by subspace iteration."""
    rank = max(1, min(rank, *x.shape))
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(x.shape[1], rank + 16)))
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :rank]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held: int = 1,
        per_label: int = 2000, rank: int = 64):
    """The broadcast model, or None if nothing can be learned."""

    def features(batches):
        for b in batches:
            tf = [counts(t).astype(np.float32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), b.column("h"), pa.array(tf, pa.binary())], ["label", "h", "tf"])

    got = (sample(docs, labels, label, folds, held, per_label).select("label", "h", "text")
           .mapInArrow(features, "label int, h long, tf binary")
           .orderBy("h", "label", "tf").limit(2 * per_label).collect())
    if not got:
        return None
    df, n = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    tf = np.stack([np.frombuffer(r["tf"], dtype=np.float32) for r in got])
    y = np.array([r["label"] for r in got], dtype=np.float32)
    x = weighted(tf, idf)
    axes = latent(x.astype(np.float64), rank).astype(np.float32)
    known = x @ axes
    size = np.linalg.norm(known, axis=1, keepdims=True)
    known = known / np.maximum(size, 1e-12)
    return docs.sparkSession.sparkContext.broadcast((idf, axes, known, y))


def nearest(unit: np.ndarray, known: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cosines and numbers of the ``k`` nearest known vectors, exact, block by block."""
    cos = np.zeros((len(unit), 0), dtype=np.float32)
    num = np.zeros((len(unit), 0), dtype=np.int64)
    for at in range(0, len(known), BLOCK):
        part = unit @ known[at: at + BLOCK].T
        cos = np.concatenate((cos, part), axis=1)
        num = np.concatenate((num, np.broadcast_to(np.arange(at, at + part.shape[1]), part.shape)), axis=1)
        if cos.shape[1] > k:
            top = np.sort(np.argpartition(-cos, k - 1, axis=1)[:, :k], axis=1)
            cos, num = np.take_along_axis(cos, top, 1), np.take_along_axis(num, top, 1)
    return cos, num


def vote(tf: np.ndarray, model: tuple, k: int, power: float) -> np.ndarray:
    idf, axes, known, y = model
    z = weighted(tf, idf) @ axes
    size = np.linalg.norm(z, axis=1)
    cos, num = nearest(z / np.maximum(size, 1e-12)[:, None], known, k)
    w = np.maximum(cos, 0).astype(np.float64) ** power * (size > 1e-9)[:, None]
    total = w.sum(axis=1)
    mean = float(y.mean())
    return np.where(total > 0, (w * y[num]).sum(axis=1) / np.maximum(total, 1e-300), mean)


def score(docs: DataFrame, model, folds: int = 3, held: int = 1, k: int = 15, power: float = 4.0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        known = model.value if model is not None else None
        for b in batches:
            column, got = b.column("text"), []
            for at in range(0, len(column), BATCH):
                texts = column.slice(at, BATCH).to_pylist()
                if known is None:
                    got.append(np.full(len(texts), 0.5))
                else:
                    got.append(np.clip(vote(np.stack([counts(t or "") for t in texts]), known, k, power), 0, 1))
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", **params) -> DataFrame:
    """Fit on the labelled rows and score every document."""
    docs = docs.select("doc_id", "text")
    return score(docs, fit(docs, labels, label, **params), params.get("folds", 3), params.get("held", 1))
