"""Property: the guarded conversions give the same answer in Spark and in the SQL oracle."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordermill.functions.text import parse_int, parse_ts
from ordermill.plans.oracle import int_of, ts_of

DIGITS = st.text(alphabet="0123456789", min_size=1, max_size=12)
INTISH = st.one_of(
    DIGITS, st.builds(lambda s, d, p: f"{p}{s}{d}{p}", st.sampled_from(["", "+", "-"]), DIGITS,
                      st.sampled_from(["", " ", "  "])),
    st.builds(lambda a, b: f"{a}.{b}", DIGITS, DIGITS), st.text(alphabet="0123456789 +-_.eE", max_size=8))
TSISH = st.one_of(
    st.builds(lambda y, m, d, h, mi, s, sep: f"{y:04d}-{m:02d}-{d:02d}{sep}{h:02d}:{mi:02d}:{s:02d}",
              st.integers(1900, 2100), st.integers(0, 13), st.integers(0, 32), st.integers(0, 25),
              st.integers(0, 61), st.integers(0, 61), st.sampled_from(["T", " ", "t", "_"])),
    st.builds(lambda y, m, d: f"{y:04d}-{m:02d}-{d:02d}", st.integers(1900, 2100), st.integers(1, 12),
              st.integers(1, 28)),
    st.text(alphabet="0123456789-T: .", max_size=20))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(ints=st.lists(INTISH, min_size=40, max_size=80), stamps=st.lists(TSISH, min_size=40, max_size=80))
def test_guarded_casts_agree(spark, ints, stamps):
    n = max(len(ints), len(stamps))
    rows = [(ints[i % len(ints)], stamps[i % len(stamps)]) for i in range(n)]
    df = spark.createDataFrame(rows, "a string, t string")
    got = [(r[0], r[1], r[2], None if r[3] is None else str(r[3]))
           for r in df.select("a", parse_int("a").alias("i"), parse_int("a", 32).alias("i32"), parse_ts("t").alias("ts"))
           .collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE x (a VARCHAR, t VARCHAR, i INTEGER)")
    con.executemany("INSERT INTO x VALUES (?, ?, ?)", [(a, t, i) for i, (a, t) in enumerate(rows)])
    want = [(r[0], r[1], r[2], None if r[3] is None else str(r[3]).replace("T", " ")) for r in con.execute(
        f"SELECT a, {int_of('a')}, {int_of('a', 32)}, {ts_of('t')} FROM x ORDER BY i").fetchall()]
    assert got == want


def test_guard_edge_cases(spark):
    cases = ["2000-01-01T24:00:00", "0000-01-01", "2000-01-01 23:59:60", "2000-02-30", "1900-02-29",
             "2000-01-01T10:00", "2000-01-01T10:00:00.123456", "2000-01-01T10:00:00.1234567", "2000-1-01",
             "2000-01-01T23:59:59", "0001-01-01"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [None if r[0] is None else r[0] for r in df.select(parse_ts("t").cast("string")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE x (t VARCHAR, i INTEGER)")
    con.executemany("INSERT INTO x VALUES (?, ?)", [(c, i) for i, c in enumerate(cases)])
    want = [r[0] for r in con.execute(f"SELECT CAST({ts_of('t')} AS VARCHAR) FROM x ORDER BY i").fetchall()]
    assert got == want
    assert got[0] is None and got[1] is None and got[-1] == "0001-01-01 00:00:00"
