"""Small documents tables with the awkward cases."""

import os

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))

AWKWARD = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "One two THREE four five six seven eight nine ten, eleven twelve"),
    (3, "one two three four five six seven eight nine ten eleven twelve"),
    (3, "one two three four five six seven eight nine ten eleven twelve"),
    (4, ""), (5, None), (6, "   \n\t "), (7, "..!?"), (8, "a"), (9, "a b"), (10, "ß é 中文 字"),
    (11, LONG), (12, LONG + " tail"), (None, "one two three four"), (None, None), (14, "x" * 5000),
    (15, "same same same same same same same same same same same same"),
]


def small_documents():
    t = pq.read_table(os.path.join(SMALL, "documents.parquet"), columns=["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"]))


def frame(spark, rows, extra=False):
    """Documents of (doc_id, text) rows; ``extra`` adds columns with clashing names."""
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA)
    if extra:
        for name in ("h", "fp", "score", "text_hash", "root", "a", "b", "n", "items", "rank", "fingerprint", "component_id", "spans", "ord",
                     "keep_id", "bad_id", "cut_ord", "places", "n_sentences", "label", "held_out", "lang_pred", "weight", "epoch"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(got, want):
    got, want = sorted(map(tuple, got), key=key), sorted(map(tuple, want), key=key)
    assert got == want, [(g, w) for g, w in zip(got, want) if g != w][:3]
