import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import AWKWARD, SCHEMA, small_documents
from pyspark.sql import functions as F

from quotefuse.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}


def counts(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    return f, n


def brute(rows, least=30, top=2000):
    f, n = counts(rows)
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    best = {}
    for (lang, p), a in cand.items():
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        best[lang, p] = min(cuts)
    gone = {(lang, q[i:i + m]) for (lang, q), b in cand.items() for m in range(2, len(q)) for i in range(len(q) - m + 1)
            if 100 * b >= 80 * cand[lang, q[i:i + m]]}
    out = []
    for lang in n:
        kept = sorted((-best[k][0], -a, " ".join(k[1]).encode(), k) for k, a in cand.items() if k[0] == lang and k not in gone)
        for rank, (s, a, _, k) in enumerate(kept[:top], 1):
            out.append((lang, rank, " ".join(k[1]), -a, best[k][2], best[k][3], n[lang], -s))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], SCHEMA).selectExpr(
        "*", "'x' as k1", "'y' as phrase", "'z' as n", "'u' as fp")


CASES = ([("en", t) for _, t in AWKWARD] * 3 + [(None, "Ab  cd\tEF gh. ab cd")] * 17 + [("und", "ab cd ef, gh")] * 20
         + [("fr", "été à la plage! été à la plage ab")] * 40 + [("en", "x" * 70 + " y" * 50)] * 2 + [("zz", None), ("en", "a\x0bb\x0cc\rd\n")] * 30
         + [("de", "a b c d e f a b c d")] * 29 + [("de", "\x00 \u00a0 ü \x00 \u00a0 ü")] * 30)


@pytest.mark.parametrize("bits", [26, 6])
def test_awkward_cases(spark, bits):
    """A bit table of 64 bits marks nearly everything: it prunes less and changes no row."""
    got = sorted(map(tuple, co.mine(table(spark, CASES), bits=bits).collect()))
    assert got == brute(CASES) and len(got) > 10


def test_small_table_at_a_lower_threshold(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in df.collect()]
    got = sorted(map(tuple, co.mine(df, least=4, top=50).collect()))
    assert got == brute(rows, least=4, top=50) and len(got) > 150


def test_empty_table(spark):
    assert co.mine(table(spark, [])).count() == 0
    assert co.mine(table(spark, [("en", None), ("en", "")])).count() == 0


def test_colliding_fingerprints_keep_exact_counts(spark, monkeypatch):
    """With fingerprints of 3 bits nearly all runs collide; counts stay those of the phrases."""
    real = co.Words.runs

    def few(self, n):
        at, fp = real(self, n)
        return at, (fp & np.uint64(7)) << np.uint64(61)

    monkeypatch.setattr(co.Words, "runs", few)
    rows = [(r[0] or "en", r[1]) for r in [("en", t) for _, t in small_documents()[:60]]] + CASES[-60:]
    assert sorted(map(tuple, co.mine(table(spark, rows), least=8).collect())) == brute(rows, least=8)


def test_structured_words_that_powers_cannot_tell_apart(spark):
    """Thue-Morse words of 2048 letters have the same polynomial modulo 2**64 for every odd base."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(2048))
    two = one.translate(str.maketrans("ab", "ba"))
    w = co.Words(pa.array([one + " x " + two]), np.zeros(1, np.uint64))
    at, fp = w.runs(1)
    check = w.second().spans(at, at + 1)
    assert fp[0] == fp[2] and check[0] != check[2]
    rows = [("en", one + " x")] * 6 + [("en", two + " x")] * 7
    assert sorted(map(tuple, co.mine(table(spark, rows), least=5).collect())) == brute(rows, least=5)


def test_words_of_a_sliced_batch():
    texts = pa.array(["zz", "Ab, cd", None, "é  f", "g"]).slice(1).fill_null("")
    w = co.Words(texts, np.zeros(4, np.uint64))
    got = [bytes(w.data[s:e]).decode() for s, e in zip(w.start, w.stop)]
    assert got == ["ab", "cd", "é", "f", "g"] and w.row.tolist() == [0, 0, 2, 2, 3]
    assert w.runs(2)[0].tolist() == [2] and len(w.runs(4)[0]) == 0
    alone = co.Words(pa.array(["f", "x  F", "ab"]), np.zeros(3, np.uint64)).second()
    again = w.second()
    assert alone.spans(np.array([0, 2, 3]), np.array([1, 3, 4])).tolist() == again.spans(np.array([3, 3, 0]), np.array([4, 4, 1])).tolist()


def test_a_phrase_makes_few_rows_however_many_splits(spark):
    """Each task sends every phrase that it meets: 64 splits of the same words are read by 16 tasks, not 64."""
    texts = [(lang, text) for lang, text in CASES[-130:-30] if text]
    df = table(spark, texts * 8).repartition(64).localCheckpoint()
    found = co.pointers(co._rows(df), [], 26)
    few = max(16, 2 * spark.sparkContext.defaultParallelism)
    assert found.count() <= few * len(counts(texts)[0]) < 64 * len(counts(texts)[0])
    assert found.groupBy().sum("n").first()[0] == 8 * sum(counts(texts)[0].values())
    assert len(found.columns) <= 5 and co.fingerprint_counts(co._rows(df), (1, 2), [], 26).dtypes == [("part", "int"), ("n", "bigint")]


def test_texts_that_share_a_hash(spark, monkeypatch):
    """A pointer names 32 bits of a text's hash: if all texts have the same ones, each phrase is still found once."""
    real = co._rows
    monkeypatch.setattr(co, "_rows", lambda docs: real(docs).withColumn("k", F.lit(-7)))
    rows = CASES + [("en", "same same start, same same"), ("en", "same same start, another end"), ("fr", "same same start")] * 20
    assert sorted(map(tuple, co.mine(table(spark, rows)).collect())) == brute(rows)


def test_small_buffers_lose_nothing(spark, monkeypatch):
    """Tasks that write their counts out many times give the same rows."""
    monkeypatch.setattr(co, "HELD", 20)
    monkeypatch.setattr(co, "SPOTS", 20)
    assert sorted(map(tuple, co.mine(table(spark, CASES), least=10).collect())) == brute(CASES, least=10)
    packed = np.array([(9 << 32) | 2, (1 << 32) | 1, (9 << 32) | 5, (0xFFFFFFFF << 32) | 1], np.uint64)
    assert co.summed(packed).tolist() == [(1 << 32) | 1, (9 << 32) | 7, (0xFFFFFFFF << 32) | 1] and len(co.summed(packed[:0])) == 0
