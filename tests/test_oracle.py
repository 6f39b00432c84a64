"""Every registered key against its DuckDB oracle (the driver's gate), sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from quotefuse.plans.registry import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return (3, v.isoformat(sep=" "))
    return (4, str(v))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries()) and set(REGISTRY) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, sf_small, key):
    sdf = E.queries()[key](spark, sf_small)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    want = sorted(tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns[:2] == ["categorie", "nb_actifs"]
