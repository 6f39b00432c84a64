import random

import pytest
from pyspark.sql import functions as F
from cases import AWKWARD, frame, small_documents

import brute
from quotefuse.llm import sentence_spans as sp


def short_sentences(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.choice((1, 3, 5, 11)))) + "." for _ in range(n)]


def test_exact_copies_end_empty(spark):
    texts = [" ".join(f"w{i}" for i in range(16)) + ". One two three. Four five six.", "Short. Passage. Here.", "One sentence", "  Lead. Two.",
             *(" ".join(short_sentences(s, s)) for s in range(1, 30)), *(t for _, t in AWKWARD[:5])]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts)]
    out = {r["doc_id"]: r["text"] for r in sp.dedup(frame(spark, rows), whole=True).collect()}
    assert all(out[1000 + i] == "" for i in range(len(texts)))
    assert out[0] == texts[0] and out[1] == texts[1]


def test_every_repeated_run_goes(spark):
    """A run of two or more sentences and 16 words goes in the later document, wherever it stands in the first."""
    rows = []
    for s in range(40):
        run = short_sentences(s, 9)
        rows += [(s, " ".join(short_sentences(1000 + s, 5) + run + short_sentences(2000 + s, 5))),
                 (100 + s, " ".join(short_sentences(3000 + s, s % 3) + run + short_sentences(4000 + s, s % 2)))]
    out = {r["doc_id"]: r["n_removed"] for r in sp.dedup(frame(spark, rows), whole=True).collect()}
    assert all(out[100 + s] >= 9 for s in range(40))


@pytest.mark.parametrize("rows", [AWKWARD, small_documents()], ids=["awkward", "small"])
def test_removes_no_less(spark, rows):
    out = [(r["doc_id"], r["text"] or "") for r in sp.dedup(frame(spark, rows), whole=True).collect()]
    kept = {}
    for i, t in out:
        kept[i] = kept.get(i, 0) + len(t)
    old = {}
    for i, _, _, t in brute.sentence_dedup(rows, 2, 16):
        old[i] = old.get(i, 0) + len(t or "")
    assert all(kept[i] <= old[i] for i in old)


def long_passages(alphabet, joint, seed):
    """40 pairs of documents that share 60 words amid others, without a stop."""
    rng = random.Random(seed)
    some = lambda n: joint.join(rng.choice(alphabet) for _ in range(n))
    rows, passages = [], [some(60) for _ in range(40)]
    for i, p in enumerate(passages):
        rows += [(i, joint.join((some(30), p, some(30)))), (100 + i, joint.join((some(7 + i % 20), p, some(25))))]
    return rows, passages


@pytest.mark.parametrize("alphabet,joint", [([f"w{i:03x}" for i in range(900)], " "), ([chr(0x4E00 + i) for i in range(900)], "")], ids=["spaced", "cjk"])
def test_passage_in_long_sentences(spark, alphabet, joint):
    rows, passages = long_passages(alphabet, joint, 5)
    out = {r["doc_id"]: r["text"] for r in sp.dedup(frame(spark, rows), whole=True).collect()}
    for i, p in enumerate(passages):
        words = p.split() if joint else list(p)
        middle = joint.join(words[26:34])
        assert middle in out[i] and middle not in out[100 + i]
        assert out[i] == rows[2 * i][1]


def test_stops_beyond_ascii(spark):
    run = "".join("".join(chr(0x4E00 + 37 * i + k) for k in range(9)) + "。" for i in range(4))
    rows = [(1, "前言在此。" + run + "後記！"), (2, "別的話？" + run + "完")]
    out = {r["doc_id"]: r["text"] for r in sp.dedup(frame(spark, rows), whole=True).collect()}
    assert out == {1: rows[0][1], 2: "別的話？完"}


def test_long_copies_end_empty(spark):
    texts = ["same " * 500, "0 1 " * 300, "字" * 400, "x" * 5000, " ".join(str(i * i) for i in range(400)), "中文 mixed 日本語の text. " * 9]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    out = {r["doc_id"]: r["text"] for r in sp.dedup(frame(spark, rows), whole=True).collect()}
    assert all(out[100 + i] == "" for i in range(len(texts)))


def test_pieces_join_to_the_sentences():
    for text in [t for _, t in AWKWARD + small_documents() if t and t.isascii()]:
        data = text.encode()
        start, end, count = sp.sentence_starts(data)
        s, e, c = sp.pieces(data, 16)
        assert set(start.tolist()) <= set(s.tolist()) and set(end.tolist()) <= set(e.tolist()) and c.sum() == count.sum()
        s, e, c = sp.pieces(data, 1 << 30)
        assert s.tolist() == start.tolist() and e.tolist() == end.tolist() and c.tolist() == count.tolist()


def test_one_colliding_hash_removes_nothing(spark, monkeypatch):
    """Spans whose first hash is equal are told apart by the second, frequent ones too."""
    rows = [(i, f"w{i} " * 20 + ". End.") for i in range(30)] + [(100 + i, "same " * 20 + ". End.") for i in range(5)]
    want = sorted(map(tuple, sp.dedup(frame(spark, rows), whole=True).collect()))
    assert sum(1 for r in want if r[1] == "") == 4
    found = sp.occurrences(frame(spark, rows).select("doc_id", "text"), 2, 16, True)
    clash = found.withColumn("hash", F.lit(7).cast("long"))
    assert sorted(map(tuple, sp.repeated_places(clash, 1000).collect())) == sorted(map(tuple, sp.repeated_places(found, 1000).collect()))


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_frequent_spans_are_cut_alike(spark, share):
    rows = [(i, "The very same line of words stands in all of these texts again and again. Yes it does so.") for i in range(50)]
    rows += [(100 + i, " ".join(f"u{i}x{k}" for k in range(14)) + f". Yes {i} or no.") for i in range(50)] * 2
    got = sorted((r["doc_id"], r["text"], r["n_removed"]) for r in sp.dedup(frame(spark, rows), whole=True, hot_share=share).collect())
    assert [t for i, t, _ in got if 0 < i < 50] == [""] * 49 and got[0][1] == rows[0][1]
    assert all(n == 0 for i, _, n in got if i >= 100)
