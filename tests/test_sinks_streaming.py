import datetime as dt
import json
import os

from pyspark.sql import functions as F

from arspark.operators import buckets, sinks
from arspark.operators.spec import Col, EntitySpec
from arspark.operators.stage import stage
from arspark.sources.raw import parse_raw
from arspark.streaming.ingest import land_files, run_upsert_stream

SPEC = EntitySpec("item", "itemID", [Col("itemID", ("itemID",), "bigint"), Col("v", ("v",), "string")])
T0, T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def raw(spark, rows):
    return spark.createDataFrame([(o, ts, s if isinstance(s, str) else json.dumps(s)) for o, ts, s in rows],
                                 "OfficeID bigint, LoadDatetimeUTC timestamp_ntz, RawDataString string")


def test_replace_batch_is_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "raw")
    b1 = parse_raw(raw(spark, [(1, T0, {"itemID": 1}), (1, T0, {"itemID": 2}), (2, T0, {"itemID": 3})]))[0]
    sinks.replace_batch(b1, path)
    sinks.replace_batch(b1, path)  # reload of the same batches
    assert sinks.read_raw_table(spark, path).count() == 3
    b2 = parse_raw(raw(spark, [(1, T0, {"itemID": 1})]))[0]  # office 1 batch re-pulled with fewer rows
    sinks.replace_batch(b2, path)
    t = sinks.read_raw_table(spark, path)
    assert t.count() == 2 and dict(t.groupBy("OfficeID").count().collect()) == {1: 1, 2: 1}
    assert dict(t.dtypes)["LoadDatetimeUTC"] == "timestamp_ntz"


def test_append_new_and_upsert_versions(spark, tmpdir_path):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    src = spark.createDataFrame([(1, "dup"), (2, "b")], "k int, v string")
    assert [r.k for r in sinks.new_rows(src, tgt, ["k"]).collect()] == [2]
    path = os.path.join(tmpdir_path, "items")
    s1 = stage(raw(spark, [(1, T1, {"itemID": 1, "v": "x"}), (1, T1, {"itemID": 2, "v": "y"})]), SPEC).rows
    sinks.upsert(spark, path, s1, "itemID")
    s2 = stage(raw(spark, [(1, T0, {"itemID": 1, "v": "older"}), (1, T2, {"itemID": 2, "v": "newer"})]), SPEC).rows
    cur = sinks.upsert(spark, path, s2, "itemID")
    assert {r.itemID: r.v for r in cur.collect()} == {1: "x", 2: "newer"}
    assert sorted(os.listdir(path)) == ["v=1", "v=2"]  # the previous version is never overwritten


def test_clustered_write_and_watermarks(spark, tmpdir_path):
    df = spark.range(100).select((F.col("id") % 7).alias("OfficeID"), F.col("id"))
    path = os.path.join(tmpdir_path, "clustered")
    sinks.write_clustered(df, path, ["OfficeID", "id"], 4)
    assert spark.read.parquet(path).count() == 100
    r = raw(spark, [(1, T0, {"itemID": 1}), (1, T1, "{bad"), (2, T0, {"itemID": 2})])
    good, bad = parse_raw(r)
    wm = {x.OfficeID: (x.rowsLoaded, x.badRows) for x in sinks.load_watermarks({"item": good}, {"item": bad}).collect()}
    assert wm == {1: (1, 1), 2: (1, 0)}


def test_stream_upsert_matches_batch_and_restarts(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "landing")
    target = os.path.join(tmpdir_path, "target")
    quarantine = os.path.join(tmpdir_path, "quarantine")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    f1 = raw(spark, [(1, T0, {"itemID": 1, "v": "a", "dateUpdated": "1"}), (1, T0, "{bad"),
                     (1, T0, {"itemID": 2, "v": "b", "dateUpdated": "1"})])
    # an overlapping pull re-delivers item 2's same version plus a newer item 1
    f2 = raw(spark, [(1, T0, {"itemID": 2, "v": "b", "dateUpdated": "1"}),
                     (1, T1, {"itemID": 1, "v": "a2", "dateUpdated": "2"})])
    land_files(f1, src)
    run_upsert_stream(spark, src, SPEC, target, quarantine, checkpoint=ckpt)
    land_files(f2, src)
    run_upsert_stream(spark, src, SPEC, target, quarantine, checkpoint=ckpt)  # restart from checkpoint
    cur = buckets.read(spark, target)
    got = {r.itemID: r.v for r in cur.collect()}
    batch = {r.itemID: r.v for r in stage(f1.unionByName(f2), SPEC).rows.collect()}
    assert got == batch == {1: "a2", 2: "b"}
    assert spark.read.parquet(quarantine).count() == 1


def test_stream_keeps_bad_late_and_unversioned_rows(spark, tmpdir_path):
    src, target, quarantine = (os.path.join(tmpdir_path, x) for x in ("in", "target", "bad"))
    ckpt = os.path.join(tmpdir_path, "ckpt")
    land_files(raw(spark, [(1, T1, {"itemID": 1, "v": "old"}), (1, T2, {"itemID": 1, "v": "new"}),
                           (1, T1, "{a"), (1, T1, "{b"), (2, T1, "{a")]), src)
    run_upsert_stream(spark, src, SPEC, target, quarantine, checkpoint=ckpt)
    land_files(raw(spark, [(1, T0, {"itemID": 6, "v": "late"})]), src)  # two days behind the newest load
    run_upsert_stream(spark, src, SPEC, target, quarantine, checkpoint=ckpt)
    before = buckets.versions(spark, target)
    run_upsert_stream(spark, src, SPEC, target, quarantine, checkpoint=ckpt)  # nothing new
    assert buckets.versions(spark, target) == before == [1, 2]
    assert {r.itemID: r.v for r in buckets.read(spark, target).collect()} == {1: "new", 6: "late"}
    assert spark.read.parquet(quarantine).count() == 3


def test_new_checkpoint_and_batch_upserts_share_a_target(spark, tmpdir_path):
    target, quarantine = (os.path.join(tmpdir_path, x) for x in ("target", "bad"))
    for k, rows in enumerate([[(1, T0, {"itemID": 1, "v": "a"}), (1, T0, "{x")], [(1, T1, {"itemID": 2, "v": "b"}), (1, T1, "{y")]]):
        src = os.path.join(tmpdir_path, f"in{k}")
        land_files(raw(spark, rows), src)
        run_upsert_stream(spark, src, SPEC, target, quarantine, checkpoint=os.path.join(tmpdir_path, f"ckpt{k}"))
        os.makedirs(os.path.join(target, "data", f"dead{k}", "bucket=1"))  # left by a write that failed
        batch = stage(raw(spark, [(1, T2, {"itemID": 10 + k, "v": "batch"})]), SPEC).rows
        buckets.upsert(spark, target, batch, "itemID")
    got = {r.itemID: r.v for r in buckets.read(spark, target).collect()}
    assert got == {1: "a", 2: "b", 10: "batch", 11: "batch"}
    assert spark.read.parquet(quarantine).count() == 2  # both checkpoints' epoch 0


def _items(spark, rows):
    return spark.createDataFrame(rows, "itemID long, v string, lastLoadTime timestamp_ntz")


def test_upsert_of_one_key_rewrites_one_bucket(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    buckets.upsert(spark, path, _items(spark, [(k, "a", T0) for k in range(200)]), "itemID", buckets=16)
    one = buckets.manifest(spark, path)
    got = buckets.upsert(spark, path, _items(spark, [(7, "b", T1), (7, "older", T0)]), "itemID", buckets=99)
    two = buckets.manifest(spark, path)
    assert len(one.buckets) == two.n == 16 and sum(one.buckets[b] != w for b, w in two.buckets.items()) == 1
    assert {r.itemID: r.v for r in got.collect()} == {k: "b" if k == 7 else "a" for k in range(200)}
    assert len(os.listdir(os.path.join(path, "data"))) == 2 and os.listdir(os.path.join(path, "_incoming")) == []
    changed = buckets.read_changed(spark, path, 1).collect()
    assert (7, "b") in {(r.itemID, r.v) for r in changed} and len(changed) < 60
    assert buckets.read(spark, path, 1).filter("itemID = 7").first().v == "a" and buckets.read(spark, path, 3) is None
    buckets.upsert(spark, path, _items(spark, []), "itemID")
    assert buckets.versions(spark, path) == [1, 2]


def test_write_that_dies_before_its_commit(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    buckets.upsert(spark, path, _items(spark, [(1, "a", T0), (2, "a", T0)]), "itemID", buckets=4)

    def dies(self, name, text):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(buckets._Files, "create", dies)
        try:
            buckets.upsert(spark, path, _items(spark, [(1, "b", T1)]), "itemID")
        except OSError:
            pass
    assert {r.itemID: r.v for r in buckets.read(spark, path).collect()} == {1: "a", 2: "a"}
    assert buckets.retain(spark, path, older_than_s=3600) == []  # it may still be at work
    assert len(buckets.retain(spark, path, older_than_s=-1)) == 1
    got = buckets.upsert(spark, path, _items(spark, [(1, "b", T1)]), "itemID")
    assert {r.itemID: r.v for r in got.collect()} == {1: "b", 2: "a"}


def test_of_two_writers_one_fails(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    buckets.upsert(spark, path, _items(spark, [(1, "a", T0)]), "itemID", buckets=4)
    before = buckets._Files.create
    raced = []

    def late(self, name, text):
        if not raced:  # another writer commits between this one's data and its manifest
            raced.append(1)
            buckets.upsert(spark, path, _items(spark, [(1, "first", T1)]), "itemID")
        return before(self, name, text)
    monkeypatch.setattr(buckets._Files, "create", late)
    try:
        buckets.upsert(spark, path, _items(spark, [(1, "second", T1), (5, "x", T1)]), "itemID")
        raise AssertionError("both committed")
    except buckets.ConcurrentUpsert:
        pass
    assert {r.itemID: r.v for r in buckets.read(spark, path).collect()} == {1: "first"}
    assert buckets.versions(spark, path) == [1, 2]


def test_batches_merge_once_and_columns_are_added(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    for n in (0, 0, 1, 0):
        buckets.upsert(spark, path, _items(spark, [(n, f"batch {n}", T0)]), "itemID", buckets=4, batch=("s", n))
    assert buckets.versions(spark, path) == [1, 2]
    wide = _items(spark, [(1, "wide", T1), (9, "new", T1)]).withColumn("w", F.lit(5))
    got = {r.itemID: (r.v, r.w) for r in buckets.upsert(spark, path, wide, "itemID").collect()}
    assert got == {0: ("batch 0", None), 1: ("wide", 5), 9: ("new", 5)}
    buckets.upsert(spark, path, _items(spark, [(9, "narrow", T2)]), "itemID")
    assert {r.itemID: (r.v, r.w) for r in buckets.read(spark, path).collect()} == {0: ("batch 0", None), 1: ("wide", 5), 9: ("narrow", None)}
    assert len(buckets.retain(spark, path, keep=1, older_than_s=-1)) >= 1
    assert buckets.read(spark, path).count() == 3 and buckets.versions(spark, path) == [4]


def test_equal_load_time_takes_the_replayed_row(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    for v in ("first", "corrected"):
        sinks.upsert(spark, path, stage(raw(spark, [(1, T0, {"itemID": 1, "v": v})]), SPEC).rows, "itemID")
    assert [r.v for r in sinks.read_current(spark, path).collect()] == ["corrected"]


def test_lower_case_paths_are_staged(spark):
    got = stage(raw(spark, [(1, T0, {"itemid": 4, "V": "no"}), (1, T0, {"itemID": 5, "itemid": 9, "v": "y"})]), SPEC)
    assert {(r.itemID, r.v) for r in got.rows.collect()} == {(4, None), (5, "y")}
    assert got.null_keys.count() == 0


def test_load_log_counts_a_batch_once(spark, tmpdir_path):
    import shutil

    from arspark.operators import loadlog
    path = os.path.join(tmpdir_path, "log")
    one = raw(spark, [(1, T0, {"itemID": 1}), (1, T0, "{bad"), (2, T1, {"itemID": 2})])
    assert loadlog.append(spark, path, "item", "a", one) and not loadlog.append(spark, path, "item", "a", one)
    assert loadlog.append(spark, path, "item", "b", raw(spark, [(1, T0, {"itemID": 3}), (1, T2, "{worse")]))
    assert loadlog.append(spark, path, "other", "a", raw(spark, []))
    want = {("item", 1, T0): (3, 1), ("item", 2, T1): (1, 0), ("item", 1, T2): (1, 1)}
    got = lambda: {(r.entity, r.OfficeID, r.LoadDatetimeUTC): (r.records, r.bad) for r in loadlog.read(spark, path).collect()}
    assert got() == want
    w = {(r.entity_name, r.office_id): r for r in loadlog.watermarks(loadlog.read(spark, path)).collect()}
    assert (w["item", 1].last_run_utc, w["item", 1].last_success_utc, w["item", 1].records_loaded, w["item", 1].error_count) == (T2, T0, 4, 2)
    folder = os.path.join(path, "entity=item", "batch=a")
    os.remove(os.path.join(folder, "_SUCCESS"))  # a write that died is written anew
    shutil.rmtree(os.path.join(folder, "x"), ignore_errors=True)
    assert loadlog.append(spark, path, "item", "a", one)
    assert got() == want


def test_changes_of_a_raw_table_read_only_their_folders(spark, tmpdir_path):
    from arspark.operators.latest import changes_since
    path = os.path.join(tmpdir_path, "raw")
    days = [dt.datetime(2024, 1, 1 + k, h) for k in range(20) for h in (1, 23)]
    sinks.replace_batch(parse_raw(raw(spark, [(o, t, {"itemID": o}) for o in range(6) for t in days]))[0], path)
    sinks.replace_batch(parse_raw(raw(spark, [(2, days[-1], {"itemID": 2})] * 3))[0], path)  # one load of a day again, the other stays
    table = sinks.read_raw_table(spark, path)
    assert table.count() == 6 * 40 + 2 and len(os.listdir(os.path.join(path, "OfficeID=2"))) == 20
    marks = [(0, "item", days[-3]), (1, "item", days[-20]), (2, "item", days[-1]), (3, "other", days[0]), (4, "item", None)]
    spark.createDataFrame(marks, "office_id long, entity_name string, last_success_utc timestamp_ntz").write.parquet(f"{path}-marks")
    now = days[-1] + dt.timedelta(minutes=30)
    got = changes_since(table, spark.read.parquet(f"{path}-marks"), "item", now)
    seen = {r.OfficeID: r.n for r in got.groupBy("OfficeID").agg(F.count("*").alias("n")).collect()}
    assert seen == {0: 3, 1: 20, 2: 3, 3: 1, 4: 1, 5: 1}
    plain = changes_since(table.drop("LoadDate"), spark.read.parquet(f"{path}-marks"), "item", now)
    assert {r.OfficeID: r.n for r in plain.groupBy("OfficeID").agg(F.count("*").alias("n")).collect()} == seen
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
