"""round_half_away equals the SQL engine's ROUND on arbitrary doubles."""
import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotefuse.functions.scalar import round_half_away

_floats = st.one_of(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False),
                    st.floats(min_value=-1e19, max_value=1e19, allow_nan=False, allow_infinity=False),
                    st.builds(lambda m, e: m * 10.0**e, st.floats(min_value=-10, max_value=10), st.integers(8, 18)))
_ties = st.integers(min_value=-10**7, max_value=10**7).map(lambda i: i / 1000 + 0.0005)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(_floats, _ties), min_size=1, max_size=200), st.integers(0, 4))
def test_round_matches_duckdb(spark, xs, n):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double")
           .select(round_half_away(F.col("x"), n)).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT ROUND(?::DOUBLE, {n})", [x]).fetchone()[0] for x in xs]
    assert got == want
