"""Date rules against a plain-Python statement of the same rule, on random
inputs (one Spark job for all generated cases)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from arspark.functions import dates as D

DATES = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))
TIMES = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(DATES, DATES), min_size=50, max_size=50),
       st.lists(st.tuples(TIMES, TIMES), min_size=50, max_size=50))
def test_boundary_counts(spark, date_pairs, ts_pairs):
    df = spark.createDataFrame(date_pairs, "a date, b date")
    got = df.select("a", "b", D.months_between_boundaries("a", "b").alias("m"), D.days_between("a", "b").alias("d"),
                    D.month_start("a").alias("ms"), D.month_end("a").alias("me")).collect()
    for r in got:
        assert r.m == (r.b.year - r.a.year) * 12 + (r.b.month - r.a.month)
        assert r.d == (r.b - r.a).days
        assert r.ms == r.a.replace(day=1)
        nxt = (r.a.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        assert r.me == nxt - dt.timedelta(days=1)
    tf = spark.createDataFrame(ts_pairs, "a timestamp_ntz, b timestamp_ntz")
    for r in tf.select("a", "b", D.hours_between("a", "b").alias("h"), D.minutes_between("a", "b").alias("mi")).collect():
        ha, hb = r.a.replace(minute=0, second=0, microsecond=0), r.b.replace(minute=0, second=0, microsecond=0)
        ma, mb = r.a.replace(second=0, microsecond=0), r.b.replace(second=0, microsecond=0)
        assert r.h == int((hb - ha).total_seconds() // 3600)
        assert r.mi == int((mb - ma).total_seconds() // 60)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 5), st.integers(0, 3), st.integers(0, 1000)),
                min_size=1, max_size=200))
def test_latest_per_key_matches_python(spark, rows):
    from arspark.operators.latest import latest_per_key
    df = spark.createDataFrame(rows, "k int, ts int, tb int, v int")
    got = {(r.k, r.ts, r.tb, r.v) for r in latest_per_key(df, "k", "ts", ["tb", "v"]).collect()}
    want = {}
    for k, ts, tb, v in rows:
        if k not in want or (ts, tb, v) > want[k][1:]:
            want[k] = (k, ts, tb, v)
    assert got == set(want.values())
