from collections import Counter

import pytest
from cases import AWKWARD, frame, same, small_documents

import brute
from pyspark.sql import functions as F
from quotefuse.llm import order_minhash as om

MORE = AWKWARD + [(2**60, "big id"), (-5, "négative id 😀😀😀 x"), (16, " lead and trail "), (None, "zz"), (7, "..!?"), (1, "one")]

# frequent ids among close ones, also where doubles cannot tell them apart, and frequent nulls
OFTEN = ([(i, f"t{j} of id {i}") for i in (5, 2**60, 2**60 + 1) for j in range(40)] + [(i, f"next to it {i}") for i in (3, 4, 6, 7, 8)]
         + [(2**60 + d, f"near {d}") for d in (-2, -1, 2, 3)] + [(None, f"no id {j}") for j in range(30)])


@pytest.mark.parametrize("rows,range_rows", [(MORE, 2000), (MORE, 2), (MORE, 1), (small_documents(), 2000), (small_documents(), 7),
                                             ([(5, f"t{i} of one id") for i in range(60)] + MORE, 3), ([(1, "alone here")], 2000),
                                             (OFTEN, 3), (OFTEN, 1)])
def test_against_brute_force(spark, rows, range_rows):
    got = om.report(frame(spark, rows, extra=len(rows) < 50), range_rows=range_rows).collect()
    same(got, brute.order_minhash_report(rows))


def test_order_matters_and_repeats_are_numbered():
    words = [f"w{i}" for i in range(400)]
    a = brute.order_minhash(" ".join(words), k=1)
    moved = brute.order_minhash(" ".join(words[200:] + words[:200]), k=1)
    assert brute.alike(a, a) == 1 and brute.alike(a, moved) < 0.9
    assert brute.order_minhash("a a a", k=1) != brute.order_minhash("a a", k=1)


def test_frequent_ids_are_cut_at_any_number_of_ranges(spark):
    """An id with a third of the rows fills many parts, beside more than 2,000 ranges of other ids."""
    ids = spark.range(9000).selectExpr("if(id % 3 = 0, 77, id) as doc_id", "xxhash64(id) as h").withColumn("text", F.col("h").cast("string"))
    rows = om.with_next(ids, ids.select("doc_id", "h"), ["text"], 2)
    got = rows.collect()
    want = sorted(got, key=lambda r: (-r["doc_id"], r["h"]))
    assert len(got) == 9000 and all(r["next_text"] == want[(j + 1) % 9000]["text"] for j, r in enumerate(want))
    sizes = Counter(tuple(r["place"]) for r in got)
    assert max(sizes.values()) < 40 and len(sizes) > 3000


def test_no_python_on_the_main_path(spark):
    plan = om.report(frame(spark, MORE), range_rows=3)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_empty(spark):
    assert om.report(frame(spark, [])).count() == 0
