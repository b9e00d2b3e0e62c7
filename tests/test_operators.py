import datetime as dt

from pyspark.sql import functions as F

from arspark.operators import latest as L

T0 = dt.datetime(2024, 1, 1, 0, 0)
T1 = dt.datetime(2024, 1, 2, 0, 0)


def test_latest_per_key_with_tie_breakers(spark):
    df = spark.createDataFrame([(1, T0, 5, "old"), (1, T1, 1, "a"), (1, T1, 2, "b"), (2, T0, 1, "only")],
                               "k int, ts timestamp_ntz, tb int, v string")
    out = {r.k: r.v for r in L.latest_per_key(df, "k", "ts", ["tb"]).collect()}
    assert out == {1: "b", 2: "only"}


def test_latest_snapshot_and_batch(spark):
    df = spark.createDataFrame([(1, T0, "x"), (1, T1, "y"), (2, T0, "z"), (2, T0, "z")],
                               "OfficeID int, LoadDatetimeUTC timestamp_ntz, v string")
    snap = L.latest_snapshot(df).collect()
    assert [(r.OfficeID, r.v) for r in snap] == [(1, "y")]  # office 2 loaded at another instant is dropped
    batch = sorted((r.OfficeID, r.v) for r in L.latest_batch(df).collect())
    assert batch == [(1, "y"), (2, "z"), (2, "z")]


def test_recent_and_changed(spark):
    df = spark.createDataFrame([(1, T0, T0, T0), (2, T1, T0, T1), (2, T1, T1, T0), (3, T0, T0, T0)],
                               "k int, LoadDatetimeUTC timestamp_ntz, upd timestamp_ntz, added timestamp_ntz")
    now = dt.datetime(2024, 1, 2, 12, 0)
    assert L.recent_window(df, now, hours=24).count() == 2
    ch = L.changed_or_added(df, "k", "upd", "added", dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3))
    assert sorted(r.k for r in ch.collect()) == [2]


def test_cdc_window(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0),), (None,)], "last timestamp_ntz")
    now = dt.datetime(2024, 1, 1, 12, 0)
    got = [r.s for r in df.select(L.cdc_window("last", now).alias("s")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 9, 45), dt.datetime(2024, 1, 1, 10, 0)]


def test_lag_split_equals_single_window(spark):
    import random

    from pyspark.sql import Window
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        cust = 1 if i % 3 else rnd.randint(2, 20)  # customer 1 holds two thirds of the rows
        day = None if rnd.random() < 0.05 else dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        rows.append((cust, rnd.randint(0, 2), day, i, rnd.randint(1, 3)))
    df = spark.createDataFrame(rows, "c int, m int, d date, id int, s int")
    w = Window.partitionBy("c", "m").orderBy("d", "id")
    want = {r.id: r.p for r in df.withColumn("p", F.lag("s").over(w)).collect()}
    got = {r.id: r.p for r in L.lag_split(df, ["c", "m"], "d", "id", "s", "p").collect()}
    assert got == want


def test_exact_median_matches_percentile(spark):
    import random
    rnd = random.Random(3)
    rows = [(1 if i % 2 else rnd.randint(2, 9), float(rnd.randint(0, 40)) / 3) for i in range(500)]
    rows += [(20, 1.5), (21, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    got = {r.g: r.median for r in L.exact_median(df, ["g"], "v").collect()}
    want.pop(21)  # all-NULL group: no histogram row
    assert got == want


def test_changes_since_uses_each_offices_own_window(spark):
    import datetime as dt

    from arspark.operators.latest import changes_since
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    raw = spark.createDataFrame([(o, t(*x)) for o in (1, 2, None) for x in ((8,), (9, 40), (9, 50), (11, 30), (13,))],
                                "OfficeID bigint, LoadDatetimeUTC timestamp_ntz")
    marks = spark.createDataFrame([(1, "ticket", t(10)), (2, "payment", t(10))],
                                  "office_id bigint, entity_name string, last_success_utc timestamp_ntz")
    got = {}
    for r in changes_since(raw, marks, "ticket", F.lit(t(12)).cast("timestamp_ntz")).collect():
        got.setdefault(r.OfficeID, set()).add((r.LoadDatetimeUTC.hour, r.LoadDatetimeUTC.minute))
    # office 1: 15 minutes before its last success; the others are on their first run: two hours back
    assert got == {1: {(9, 50), (11, 30)}, 2: {(11, 30)}, None: {(11, 30)}}


def test_not_in_has_the_null_rules_of_sql(spark):
    from arspark.operators.joins import not_in
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    for listed, want in (([2, 2, 9], [1]), ([2, None], []), ([], [None, 1, 2]), ([None], [])):
        others = spark.createDataFrame([(x,) for x in listed], "x int")
        got = not_in(df, "k", others, "x")
        assert sorted((r.k for r in got.collect()), key=lambda k: (k is not None, k)) == want
        df.createOrReplaceTempView("kept")
        others.createOrReplaceTempView("listed")
        assert got.count() == spark.sql("SELECT * FROM kept WHERE k NOT IN (SELECT x FROM listed)").count()
    plan = not_in(df, "k", others, "x")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_median_of_one_large_group(spark):
    """Millions of distinct values in one group beside small and NULL groups: percentile's value, and no task orders a whole group."""
    from arspark.operators.latest import exact_median
    big = spark.range(0, 1_000_001, 1, 8).select(F.lit("big").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10**12)) / 7).alias("v"))
    rows = [("even", 1.0), ("even", 2.0), ("even", 2.0), ("even", 9.0), (None, 5.0), (None, None), ("one", -3.5), ("nulls", None)] + [("tie", 4.0)] * 9
    df = big.unionByName(spark.createDataFrame(rows, "k string, v double"))
    got = {r.k: r.median for r in exact_median(df, ["k"], "v").collect()}
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("p")).collect() if r.p is not None}
    assert got == want and len(want) == 5
    assert exact_median(df, [], "v").first().median == df.agg(F.percentile("v", 0.5)).first()[0]
    money = df.select("k", F.col("v").cast("decimal(18,2)").alias("v"))
    assert {r.k: r.median for r in exact_median(money, ["k"], "v", buckets=4).filter("k != 'big'").collect()} == {"even": 2.0, "one": -3.5, "tie": 4.0}
