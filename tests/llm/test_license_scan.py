import pytest
from cases import AWKWARD, frame, same, small_documents

import brute
from quotefuse.llm import license_scan as ls

PLANTED = [
    (30, "Licensed under the Apache License, Version 2.0. And again: apache  LICENSE"), (31, "Released under the MIT License."),
    (32, "This work is licensed under the GNU General Public License, version 3."), (33, "Licensed under CC BY-NC 4.0."),
    (34, "gnu general public mit license cc by cc by sa 4 0"), (35, "Permission is hereby granted, free of charge, to any person"),
    (36, "Redistribution and use in source and binary forms, with or without modification"), (37, "license"),
    (38, "subject to the terms of the Mozilla Public License, v. 2.0"), (39, "KAPACHE LICENſE mit-license ＭIT license"),
    (40, "mit " * 4000 + "license"), (41, "software software free unencumbered"), (42, "by cc license mit")]


@pytest.mark.parametrize("rows", [AWKWARD + PLANTED, small_documents()], ids=["planted", "small"])
def test_against_brute_force(spark, rows):
    got = ls.scan(frame(spark, rows, extra=len(rows) < 100)).collect()
    same([tuple(r)[:6] for r in got], brute.licenses(rows))
    want = brute.license_labels(rows, ls.TEMPLATES, ls.FUNCTION_WORDS, ls.PHRASES)
    same([(r["doc_id"], r["labels"], round(r["score"], 9)) for r in got], [(i, n, round(s, 9)) for i, n, s in want])
    assert any("notice" in r["labels"] for r in got)


def test_labels_come_from_the_lookup(spark, monkeypatch):
    """Without postings no template is placed: only the base labels are left."""
    want = {r["doc_id"]: r["labels"] for r in ls.scan(frame(spark, PLANTED)).collect()}
    assert want[35] == "mit-text" and want[36] == "bsd-text" and want[33] == "cc-by,cc-by-nc-notice"
    monkeypatch.setattr(ls, "template_postings", lambda spark: spark.createDataFrame([], "word string, template int, tpos long"))
    assert all(r["labels"] == r["base_labels"] for r in ls.scan(frame(spark, PLANTED)).collect())
    with pytest.raises(ValueError):
        ls.scan(frame(spark, PLANTED), rare=1)


def test_rare_words_change_the_score_and_lose_no_label(spark):
    # the rarest words of mit-text stand elsewhere, its phrase in place
    text = "without restriction person obtaining associated documentation software copy. Permission is hereby granted, free of charge"
    rows = PLANTED + [(60, text)] + [(70 + i, "permission granted hereby charge") for i in range(20)]
    few, many = ({r["doc_id"]: r for r in ls.scan(frame(spark, rows), rare=n).collect()} for n in (2, 50))
    assert {i: r["labels"] for i, r in few.items()} == {i: r["labels"] for i, r in many.items()}
    assert few[60]["labels"] == "mit-text" and few[60]["score"] == 1.0 > many[60]["score"] > 0


def test_no_python_on_the_main_path(spark):
    plan = ls.scan(frame(spark, PLANTED))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_empty(spark):
    assert ls.scan(frame(spark, [])).count() == 0
