import hashlib
import math
import re
import zlib

import pytest
from cases import AWKWARD, frame, same, small_documents

from quotefuse.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for c in features(x, n)[1]:
                counts[c % buckets] += 1
    top, low = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((b + 1.0) * top / ((a + 1.0) * low))) for a, b in zip(s, t)]
    rows = []
    for i, x in docs:
        words, found = features(x, n)
        weight = sum(gain[c % buckets] for c in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    fit = [r for r in rows if r[5] >= least_words]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in rows]


def texts(spark, values):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], "item_id long, text string")


@pytest.mark.parametrize("n", [1, 3])
def test_small_tables(spark, sf_small, n):
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    rows = small_documents()
    got = importance.resample(frame(spark, rows), items, n=n, buckets=997).collect()
    same(got, brute(rows, [r["text"] for r in items.collect()], n=n, buckets=997))
    assert sum(r["rank"] is not None for r in got) > 5


@pytest.mark.parametrize("least_words, percent", [(1, 50), (12, 100), (0, 30)])
def test_awkward_cases(spark, least_words, percent):
    target = ["one two three", None, "", "ß é 中文 字", "same word5"]
    got = importance.resample(frame(spark, AWKWARD, extra=True), texts(spark, target), n=2, buckets=50, percent=percent,
                              least_words=least_words)
    same(got.collect(), brute(AWKWARD, target, n=2, buckets=50, percent=percent, least_words=least_words))


def test_one_repeated_row_holds_many_ranks(spark):
    rows = [(7, "a b c")] * 25_000 + [(i, "a d") for i in range(100)] + [(None, "a b c")] * 3
    got = importance.resample(frame(spark, rows), texts(spark, ["a b"]), percent=97, least_words=2).collect()
    same(got, brute(rows, ["a b"], percent=97, least_words=2))
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 97 * len(rows) // 100 + 1))


def test_empty_sides(spark):
    assert importance.resample(frame(spark, []), texts(spark, ["a"])).count() == 0
    same(importance.resample(frame(spark, AWKWARD), texts(spark, []), least_words=1).collect(),
         brute(AWKWARD, [], least_words=1))
    short = [(1, "a b"), (2, None)]
    same(importance.resample(frame(spark, short), texts(spark, [])).collect(), brute(short, []))
