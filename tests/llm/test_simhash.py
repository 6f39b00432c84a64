import random

import pytest
from cases import AWKWARD, frame, same, small_documents

import brute
from quotefuse.llm import simhash_bk as sh
from quotefuse.llm.components import components


@pytest.mark.parametrize("rows", [AWKWARD, small_documents()], ids=["awkward", "small"])
def test_against_brute_force(spark, rows):
    got = sh.near_duplicates(frame(spark, rows, extra=rows is AWKWARD)).collect()
    same(got, brute.near_duplicates(rows))


@pytest.mark.parametrize("shard_rows", [2000, 40, 3])
def test_links_of_planted_chains_at_every_shard_size(spark, shard_rows):
    rnd = random.Random(5)
    values = set()
    for _ in range(40):
        v = rnd.getrandbits(64)
        for _ in range(12):
            values.add(v)
            for bit in rnd.sample(range(64), rnd.randint(1, 4)):
                v ^= 1 << bit
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = sh.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3, shard_rows)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    want = brute.groups(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {v: got.get(v, v) for v in signed} == want


def test_word_blocks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    whole = sh.fingerprint(text, 3)
    monkeypatch.setattr(sh.word_blocks, "__defaults__", (7,))
    assert sh.fingerprint(text, 3) == whole
    assert sh.fingerprint("a b", 3) & (2**64 - 1) == brute.simhash("a b")


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (600, 601)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 600: 600, 601: 600}


def test_keep_one(spark):
    df = frame(spark, AWKWARD, extra=True)
    kept = sh.keep_one(df)
    assert kept.columns == df.columns
    want = {}
    for i, _, c in brute.near_duplicates(AWKWARD):
        want[c] = i if c is None else c
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == sorted((i is None, i) for i in want.values())


def test_empty(spark):
    df = frame(spark, [])
    assert sh.near_duplicates(df).count() == 0 and sh.keep_one(df).count() == 0
