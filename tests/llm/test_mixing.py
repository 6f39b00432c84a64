import math
from collections import Counter, defaultdict

import pytest
from cases import AWKWARD, SCHEMA, frame

from quotefuse.llm import mixing


def documents(spark, sizes, extra=()):
    rows = [(f"{s}-{i}", " ".join(["w"] * (1 + (i * 7) % 23)), s) for s, n in sizes.items() for i in range(n)]
    rows = [(k, t, "en", s, len(t)) for k, (_, t, s) in enumerate(rows)] + list(extra)
    return rows, spark.createDataFrame(rows, SCHEMA)


def exponent(tokens, part, most, ratio):
    """Plain bisection."""
    total = sum(tokens.values())
    p = [t / total for t in tokens.values()]

    def at(a):
        w = [x ** a for x in p]
        z = sum(w)
        w = [x / z for x in w]
        return -sum(x * math.log(x) for x in w), max(x / y for x, y in zip(w, p)) * ratio

    def edge(good, low, high):
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if good(mid) else (low, mid)
        return (low + high) / 2

    target = at(1)[0] + part * (math.log(len(p)) - at(1)[0])
    a = edge(lambda x: at(x)[0] >= target, 0, 1)
    if at(a)[1] > most + 1e-9:
        a = edge(lambda x: at(x)[1] > most, 0, 1)
    return a


SIZES = {"a": 600, "b": 150, "c": 40, None: 25, "d": 3}


@pytest.mark.parametrize("part,most,budget,block", [(0.5, 4.0, None, 1000), (0.5, 4.0, None, 16), (1.0, 100.0, None, 16),
                                                    (0.9, 2.0, 5000, 50), (0.0, 4.0, 900, 16)])
def test_weights_quotas_and_passes(spark, part, most, budget, block):
    rows, df = documents(spark, SIZES, [(900, None, "en", "a", 0), (901, " ", "en", "z", 1)])
    n = {r[0]: len((r[1] or "").split()) for r in rows}
    src = {r[0]: r[3] for r in rows}
    tokens = Counter()
    for i, k in n.items():
        tokens[src[i]] += k
    tokens = {s: t for s, t in tokens.items() if t}
    total = sum(tokens.values())
    budget_tokens = budget or total
    got = mixing.mix(df, part, most, budget, block).collect()
    a = exponent(tokens, part, most, budget_tokens / total)
    w = {s: (t / total) ** a for s, t in tokens.items()}
    z = sum(w.values())
    used, uses = Counter(), defaultdict(list)
    for r in got:
        assert abs(r["weight"] - w[r["source"]] / z) < 1e-4 and r["n_tokens"] == n[r["doc_id"]] > 0
        used[r["source"]] += r["n_tokens"]
        uses[r["doc_id"]].append(r["epoch"])
    for s, t in tokens.items():
        quota = min(w[s] / z * budget_tokens, most * t)
        assert quota * (1 - 1e-4) - 24 <= used[s] <= quota * (1 + 1e-4) + 1, (s, quota, used[s])
        full = int(quota * (1 - 1e-4) / t)  # at the repetition limit a quota can end a token short of a pass
        for i in (i for i in n if src[i] == s and n[i]):
            assert sorted(uses[i])[:full] == list(range(full)) and len(uses[i]) <= quota * (1 + 1e-4) / t + 1
    # a pass is a permutation: (block, place) is unique in it, and whole passes use every place
    spots = Counter((r["source"], r["epoch"], r["block"], r["place"]) for r in got)
    assert max(spots.values()) == 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df, part, most, budget, block).collect()))


def test_passes_are_different_permutations(spark):
    _, df = documents(spark, {"a": 400, "b": 60})
    got = mixing.mix(df, 1.0, 10.0, None, 10).where("source = 'b'").collect()
    order = [[r["doc_id"] for r in sorted(got, key=lambda r: (r["block"], r["place"])) if r["epoch"] == e] for e in (0, 1)]
    assert sorted(order[0]) == sorted(order[1]) and order[0] != order[1]


def test_awkward_and_empty(spark):
    got = mixing.mix(frame(spark, AWKWARD, extra=True)).collect()
    assert {r["weight"] for r in got} == {1.0}
    assert Counter(str(r["doc_id"]) for r in got)["3"] == 2
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [(1, None), (2, "")])).columns == mixing.mix(frame(spark, AWKWARD)).columns


def test_many_blocks_are_ranked_in_runs(spark):
    _, df = documents(spark, {"a": 500})
    per = mixing.mix(df, block_rows=1)
    assert sorted(r["doc_id"] for r in per.collect()) == list(range(500))
    n = spark.createDataFrame([("a", 0, i, 1, hash((i, 5)) * 2654435761 % 2**63, 300) for i in range(300)],
                              "source string, epoch long, part long, tokens long, order long, blocks long")
    got = mixing.placed(n, run=16).orderBy("block").collect()
    assert [r["block"] for r in got] == list(range(300)) == [r["before"] for r in got]
    assert [r["order"] for r in got] == sorted(r["order"] for r in got)
