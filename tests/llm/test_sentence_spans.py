import pytest
from cases import AWKWARD, frame, same, small_documents

import brute
from quotefuse.llm import sentence_spans as sp

PASSAGE = " ".join(f"Sentence {w} of the passage has several words." for w in ("one", "two", "three", "four", "five", "six", "seven", "eight"))
PLANTED = AWKWARD + [
    (60, "Before it. " + PASSAGE + " After it."), (61, "Other words stand here " + PASSAGE), (62, PASSAGE + "\nA tail."),
    (50, "  Earlier id.\n" + PASSAGE), (63, "One. " * 40), (64, "line one two\n" * 30), (65, "É ü! Ø? " * 12), (66, PASSAGE), (66, PASSAGE),
    (66, "same id. " + PASSAGE), (None, PASSAGE), (None, "x " + PASSAGE), (67, "Short. Passage. Here."), (68, "Short. Passage. Here.")]


@pytest.mark.parametrize("rows,args", [(PLANTED, (3, 16)), (PLANTED, (2, 1)), (small_documents(), (3, 16)), (small_documents(), (2, 5))])
def test_against_brute_force(spark, rows, args):
    df = frame(spark, rows, extra=rows is PLANTED)
    out = sp.dedup(df, *args)
    assert out.columns[:-2] == df.columns
    n_all, n_cut = out.columns[-2:]
    want = brute.sentence_dedup(rows, *args)
    same([(r["doc_id"], r[n_all], r[n_cut], r["text"]) for r in out.collect()], want)
    assert any(n for _, _, n, _ in want)


def test_passage_stays_once(spark):
    texts = [r["text"] or "" for r in sp.dedup(frame(spark, [r for r in PLANTED if r[0] != 66 and r[0]])).collect()]
    assert sum("Sentence four of the passage" in t for t in texts) == 1
    assert "Earlier id.\n" in "".join(texts) and "A tail." in "".join(texts)


def test_empty(spark):
    assert sp.dedup(frame(spark, [])).count() == 0
