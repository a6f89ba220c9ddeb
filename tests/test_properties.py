"""Property tests: the rounding and ratio rules agree with DuckDB on
random inputs (one Spark job per property, all examples in one frame)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hublytics.functions import semantics as S

finite = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)
ticks = st.integers(min_value=-10**7, max_value=10**7).map(lambda i: i / 1000.0)  # values near .xx5 ties


def _duck(sql: str, values):
    con = duckdb.connect()
    con.execute("create table t(i integer, x double)")
    con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(sql).fetchall()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(finite, ticks), min_size=50, max_size=200))
def test_round_like_equals_duckdb_round(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(S.round_like("x", 2)).collect()]
    assert got == _duck("select round(x, 2) from t order by i", values)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=50, max_size=200))
def test_pct_equals_duckdb(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    got = [r[0] for r in df.orderBy("i").select(S.pct("a", "b")).collect()]
    con = duckdb.connect()
    con.execute("create table p(i integer, a bigint, b bigint)")
    con.executemany("insert into p values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = [r[0] for r in con.execute("select round(a * 100.0 / nullif(b, 0), 2) from p order by i").fetchall()]
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(finite, ticks.map(lambda v: v * 500)), min_size=50, max_size=200))
def test_to_bigint_equals_duckdb_cast(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(S.to_bigint("x")).collect()]
    assert got == _duck("select cast(x as bigint) from t order by i", values)
