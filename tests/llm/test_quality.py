import numpy as np
import pytest
from cases import AWKWARD, frame

from quotefuse.llm import quality_knn as q

TABLES = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_brute_force_votes(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    model = q.fit(docs, labels)
    got = {r["doc_id"]: r for r in q.score(docs, model).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [i for i in truth if got[i]["held_out"]]
    hit = [got[i]["predicted"] == truth[i] for i in held]
    assert len(held) > 80 and np.mean(hit) > 0.95
    for label in (0, 1):
        assert np.mean([h for h, i in zip(hit, held) if truth[i] == label]) > 0.85
    # the votes of some documents from the whole cosine matrix
    idf, axes, known, y = model.value
    for r in docs.orderBy("doc_id").limit(40).collect():
        z = q.weighted(q.counts(r["text"])[None], idf) @ axes
        cos = (z / np.linalg.norm(z)) @ known.T
        top = np.argsort(-cos[0], kind="stable")[:15]
        w = np.maximum(cos[0, top], 0).astype(float) ** 4
        assert abs(got[r["doc_id"]]["score"] - (w * y[top]).sum() / w.sum()) < 1e-3


def test_nearest_is_exact_over_blocks(monkeypatch):
    monkeypatch.setattr(q, "BLOCK", 7)
    rnd = np.random.default_rng(1)
    a, b = rnd.standard_normal((20, 5)), rnd.standard_normal((60, 5))
    cos, num = q.nearest(a, b, 9)
    want = np.sort(a @ b.T, axis=1)[:, -9:]
    assert np.allclose(np.sort(cos, axis=1), want) and np.allclose(np.take_along_axis(a @ b.T, num, 1), cos)


@pytest.mark.parametrize("labels", [[(1, 1, 0), (8, 0, 0), (10, None, 1), (None, 1, 0), (99, 0, 0), (15, 7, 0), (15, 0, 0), (15, 1, 0)], []])
def test_awkward(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = q.classify(frame(spark, AWKWARD, extra=True), table).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (4, 5)}
    assert len(empty) == 1 and (labels or empty == {0.5})
    assert q.classify(frame(spark, []), table).count() == 0


def test_rows_that_share_an_id_do_not_crowd_out_the_others(spark):
    """10,000 rows of one labelled id: it votes once, the others are learned all the same."""
    rows = [(1, "good clean words here")] * 10_000 + [(i, f"bad {i} bad bad") for i in range(2, 60)]
    labels = spark.createDataFrame([(1, 1, 0)] + [(i, 0, 0) for i in range(2, 60)], "doc_id long, quality int, toxic int")
    got = q.sample(frame(spark, rows), labels, "quality", 3, 99, 50).collect()
    assert sorted((r["doc_id"], r["label"]) for r in got if r["doc_id"] == 1) == [(1, 1)] and len(got) == 51
    two = [(1, "b"), (1, "a"), (2, None)]
    both = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(q.sample(frame(spark, two), both, "quality", 3, 99, 50).collect()) == 3
