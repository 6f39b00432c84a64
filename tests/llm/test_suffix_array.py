import random

import numpy as np
import pytest
from cases import AWKWARD, frame, same, small_documents

import brute
from quotefuse.llm import suffix_array as sa

rnd = random.Random(9)
PASSAGE = " ".join("".join(rnd.choices("abcdeé", k=rnd.randint(1, 9))) for _ in range(90))


def around(n):
    return "".join(rnd.choices("abcd \n", k=n))


SHORT = [(i, t if t is None else t[:3000]) for i, t in AWKWARD]
PLANTED = SHORT + [(100 + k, around(rnd.randint(0, 300)) + PASSAGE[rnd.randint(0, 150):rnd.randint(250, 500)] + around(rnd.randint(0, 300)))
                   for k in range(40)] + [
    (200, "x" * 199), (201, "y" * 201), (202, "ab" * 300), (203, "z" * 200), (203, "z" * 200), (204, PASSAGE * 2),
    (205, "q" + PASSAGE[:199]), (206, PASSAGE[:100] + "é" + PASSAGE[100:300]), (207, "the end " * 60)]


@pytest.mark.parametrize("rows,params", [(PLANTED, {}), (PLANTED, {"class_rows": 2, "broadcast_values": 0, "batch_bytes": 5000}),
                                         (PLANTED, {"length": 40, "window": 25}), (small_documents(), {})])
def test_against_brute_force(spark, rows, params):
    got = sa.digest(frame(spark, rows, extra=rows is PLANTED), **params).collect()
    want = brute.byte_dedup(rows, params.get("length", 200))
    same(got, want)
    assert any(0 < n < size for _, size, n, _, _ in want)


@pytest.mark.parametrize("letters,n", [(2, 500), (3, 7), (200, 900), (1, 64), (5, 6)])
def test_suffix_order(letters, n):
    s = np.random.default_rng(n).integers(1, letters + 1, n)
    want = sorted(range(n), key=lambda i: s[i:].tolist())
    assert sa.suffix_order(s, n).tolist() == want
    near = sa.suffix_order(s, 9)
    assert [s[i:i + 9].tolist() for i in near] == [s[i:i + 9].tolist() for i in want]


def test_anchors_cover_every_window(monkeypatch):
    data = around(3000).encode()
    at, first, last = sa.anchors(data, 50)
    assert first[0] == 0 and last[-1] == len(data) - 7 - 50 and (first[1:] == last[:-1] + 1).all()
    assert ((at >= last) & (at < first + 50)).all()
    whole = [x.tolist() for x in (at, first, last)]
    monkeypatch.setattr(sa, "PART", 64)
    assert [x.tolist() for x in sa.anchors(data, 50)] == whole


def test_empty(spark):
    assert sa.digest(frame(spark, [])).count() == 0
