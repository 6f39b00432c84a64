"""Language identification by a string kernel.

Kernel: blended n-gram presence. A text is the set of its character n-grams
of 1 to 3 code points (lower-cased, ASCII other than letters read as a space),
hashed to ``2**BITS`` features per length; k(x, y) = |x & y| / sqrt(|x| |y|).
Model: Nystroem landmarks and one-versus-rest kernel ridge regression.
Every document is scored by matrix products over batches of presence rows.

Fitting sees a bounded sample: at most ``per_language`` rows of each language
and ``max_rows`` in all, picked by a hash of the id in turns over the
languages; the first ``landmarks`` of them are the landmarks. Everything sent
to the driver or broadcast is bounded by these parameters.

Defined results: null text or text without a letter gives ``und`` and score 0;
a null id is never learned from and not held out; no learnable row at all
gives ``und`` for every document; repeated rows are scored one by one; other
columns are ignored; an empty table gives an empty result. The score is the
winning output mapped from [-1, 1] to [0, 1]; ties go to the first language
in sorted order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotefuse.llm.common import blocks, fold_of

LENGTHS = (1, 2, 3)
BITS = 13
WIDTH = len(LENGTHS) << BITS
BATCH = 64
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_ASCII = np.array([c if chr(c).isalpha() else 32 for c in range(128)], dtype=np.uint64)


def presence(text: str, seen: np.ndarray) -> np.ndarray:
    """Sorted feature numbers of the n-grams in ``text``; ``seen`` is a
    cleared boolean workspace of ``WIDTH`` that is left cleared."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    low = cp < 128
    cp[low] = _ASCII[cp[low]]
    shift = np.uint64(64 - BITS)
    h = np.zeros(len(cp), dtype=np.uint64)
    for i, n in enumerate(LENGTHS):
        if len(cp) < n:
            break
        h = (h[: len(cp) - n + 1] + cp[n - 1:]) * _MULT[i]
        h ^= h >> np.uint64(29)
        seen[((h * _MULT[0]) >> shift) + np.uint64(i << BITS)] = True
    ids = np.flatnonzero(seen)
    seen[ids] = False
    return ids


def kernel(rows: list[np.ndarray], marks: np.ndarray, mark_sizes: np.ndarray) -> np.ndarray:
    """Kernel of the presence rows with the landmarks (``WIDTH`` x m)."""
    x = np.zeros((len(rows), WIDTH), dtype=np.float32)
    for i, ids in enumerate(rows):
        x[i, ids] = 1
    sizes = np.array([max(1, len(ids)) for ids in rows], dtype=np.float32)
    return (x @ marks) / np.sqrt(sizes[:, None] * mark_sizes[None, :])


def dense(marks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((WIDTH, len(marks)), dtype=np.float32)
    for j, ids in enumerate(marks):
        out[ids, j] = 1
    return out, np.array([max(1, len(ids)) for ids in marks], dtype=np.float32)


def sample(docs: DataFrame, folds: int, held: int, per_language: int, max_rows: int) -> DataFrame:
    """The bounded learning sample: doc_id, lang, text, rank. An id counts once per
    language, by the text of least hash that has a letter, however many rows carry it."""
    texts = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("t")).where(
        F.col("lang").isNotNull() & (fold_of(F.col("doc_id"), folds) != held) & F.col("text").rlike(r"\p{L}"))
    rows = texts.groupBy("doc_id", "lang").agg(F.min("t").alias("t")).withColumn("h", F.xxhash64("doc_id"))
    # thin each language by the hash to about twice its share first, so that no ranking holds a frequent language
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_rows)
    part = F.col("h") / F.lit(2.0**64) + 0.5
    rows = rows.join(F.broadcast(sizes), "lang").where(part * F.col("n") < 2 * per_language)
    w = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_language)
              .orderBy("rank", "h", "lang").limit(max_rows).select("doc_id", "lang", "t", "rank"))
    # equal rows of a picked id leave each task once
    return texts.join(F.broadcast(picked), ["doc_id", "lang", "t"]).dropDuplicates(["doc_id", "lang"]).drop("t")


def fit(docs: DataFrame, folds: int = 5, held: int = 0, per_language: int = 400,
        max_rows: int = 4000, landmarks: int = 128, ridge: float = 1e-3):
    """(languages, landmark rows, output matrix) or None if nothing can be learned."""
    spark = docs.sparkSession
    rows = sample(docs, folds, held, per_language, max_rows)

    def features(batches):
        seen = np.zeros(WIDTH, dtype=bool)
        for b in batches:
            ids = [presence(t, seen).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), b.column("rank"), pa.array(ids, pa.binary())], ["lang", "rank", "ids"])

    got = (rows.select("lang", "rank", "text").mapInArrow(features, "lang string, rank int, ids binary")
           .orderBy("rank", "lang", "ids").limit(max_rows).collect())
    if not got:
        return None
    sets = [np.frombuffer(r["ids"], dtype=np.int32) for r in got]
    langs = sorted({r["lang"] for r in got})
    marks = sets[:landmarks]
    m, sizes = dense(marks)
    k = np.concatenate([kernel(part, m, sizes) for part in blocks(sets, BATCH)]).astype(np.float64)
    inner = k[: len(marks)]
    val, vec = np.linalg.eigh((inner + inner.T) / 2)
    keep = val > 1e-6 * max(val.max(), 1e-12)
    root = vec[:, keep] / np.sqrt(val[keep])
    phi = k @ root
    y = np.array([[1.0 if r["lang"] == g else -1.0 for g in langs] for r in got])
    gram = phi.T @ phi + ridge * len(got) * np.eye(phi.shape[1])
    out = root @ np.linalg.solve(gram, phi.T @ y)
    return spark.sparkContext.broadcast((langs, [s.tobytes() for s in marks], out.astype(np.float32)))


def unpacked(model: tuple) -> tuple:
    """What scoring needs of a model's value: languages, landmarks, sizes, outputs, workspace."""
    langs, packed, out = model
    marks, sizes = dense([np.frombuffer(p, dtype=np.int32) for p in packed])
    return langs, marks, sizes, out, np.zeros(WIDTH, dtype=bool)


def outputs(column: pa.Array, known: tuple) -> tuple[list[str], list[float]]:
    """Language and score of each text of a column (null: no letter in it)."""
    langs, marks, sizes, out, seen = known
    pred, sure = [], []
    for at in range(0, len(column), BATCH):
        texts = column.slice(at, BATCH).to_pylist()
        f = kernel([presence(t or "", seen) for t in texts], marks, sizes) @ out
        for t, row in zip(texts, f):
            best = int(np.argmax(row))
            pred.append("und" if t is None else langs[best])
            sure.append(0.0 if t is None else float(min(1.0, max(0.0, (row[best] + 1) / 2))))
    return pred, sure


def predict(docs: DataFrame, model, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    rows = docs.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def score(batches):
        known = unpacked(model.value)
        for b in batches:
            pred, sure = outputs(b.column("text"), known)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(sure, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(score, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **params) -> DataFrame:
    """Fit on ``docs`` and predict every row of it."""
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, fit(docs, **params), params.get("folds", 5), params.get("held", 0))


def keep_known(docs: DataFrame, min_score: float = 0.2, **params) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or whose score is
    under ``min_score``. Nothing is rejected for its score without a model."""
    model = fit(docs.select("doc_id", "text", "lang"), **params)
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    if model is None:
        return lettered
    names = docs.columns

    def keep(batches):
        known = unpacked(model.value)
        for b in batches:
            _, sure = outputs(b.column(names.index("text")), known)
            yield b.filter(pa.array([s >= min_score for s in sure], pa.bool_()))

    return lettered.mapInArrow(keep, docs.schema)
