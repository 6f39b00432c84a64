import pytest
from cases import AWKWARD, SMALL, frame, same, small_documents

import brute
from quotefuse.llm import decontam

ITEMS = [
    (1, "two three four five six seven eight nine ten eleven twelve thirteen"), (2, "a b"), (3, "a"), (4, None), (5, ""),
    (6, "same same same same same same same same same same same"), (7, "中文 字"), (None, "six seven"), (8, "..."),
    (9, "One, two; three four"), (9, "word5 and5"), (10, " ".join(f"word{i} and{i}" for i in range(12)))]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block_words", [500_000, 12])
def test_awkward_cases(spark, block_words):
    got = decontam.decontaminate(frame(spark, AWKWARD, extra=True), items(spark), block_words=block_words)
    same(got.collect(), brute.decontaminate(AWKWARD, ITEMS))


def test_one_block_at_a_time(spark, monkeypatch):
    """A block is written before the index of the next is built; the whole benchmark is never a list."""
    steps, prefixes, save, blocks = [], decontam.prefixes, decontam.saved, decontam.item_blocks

    def read(*args):
        for block in blocks(*args):
            steps.append("read")
            yield block

    monkeypatch.setattr(decontam, "item_blocks", read)
    monkeypatch.setattr(decontam, "prefixes", lambda *a: (steps.append("index"), prefixes(*a))[1])
    monkeypatch.setattr(decontam, "saved", lambda *a: (steps.append("saved"), save(*a))[1])
    got = decontam.decontaminate(frame(spark, AWKWARD), items(spark), block_words=12)
    same(got.collect(), brute.decontaminate(AWKWARD, ITEMS))
    built = [s for s in steps if s != "read"]
    assert steps.count("index") > 3 and all(a != b for a, b in zip(built, built[1:]) if a == "index")
    # two blocks are read ahead: the one whose turn it is, and the next
    assert "saved" in steps[: steps.index("read", 4) + 4]


def test_small_tables(spark):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rows = small_documents()
    got = decontam.decontaminate(frame(spark, rows), bench).collect()
    want = brute.decontaminate(rows, [tuple(r) for r in bench.select("item_id", "text").collect()])
    same(got, want)
    assert any(r["contaminated"] for r in got)


def test_empty_sides(spark):
    assert decontam.decontaminate(frame(spark, []), items(spark)).count() == 0
    same(decontam.decontaminate(frame(spark, AWKWARD), items(spark, [])).collect(), brute.decontaminate(AWKWARD, []))


def test_clean_drops_hit_documents_only(spark):
    df = frame(spark, AWKWARD, extra=True)
    kept = decontam.clean(df, items(spark))
    want = [i for (i, *_, bad) in brute.decontaminate(AWKWARD, ITEMS) if not bad]
    assert kept.columns == df.columns
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in kept.collect())
