"""What grows with the tables: landed logs, buckets, streams, partitions."""
import datetime as dt
import glob
import json
import os
import time
from types import SimpleNamespace

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from arspark.operators import buckets
from arspark.operators.latest import latest_per_key
from arspark.operators.spec import Col, EntitySpec
from arspark.plans import quality as Q
from arspark.plans import staging
from arspark.session import FREE_SHUFFLES, INITIAL
from arspark.sources import rawlog as R
from arspark.sources import tables
from arspark.sources.specs import TASK
from arspark.sources.staged import contract
from arspark.streaming.ingest import current_rows, land_files, run_upsert_stream

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3)
RAW = StructType([StructField("OfficeID", LongType()), StructField("LoadDatetimeUTC", TimestampNTZType()), StructField("RawDataString", StringType())])
SPEC = EntitySpec("item", "itemID", [Col("itemID", ["itemID"]), Col("v", ["v"], "string")])


def raw(spark, rows):
    return spark.createDataFrame([(o, t, r if isinstance(r, str) else json.dumps(r)) for o, t, r in rows], RAW)


def test_reports_land_their_own_table_and_a_shared_log_once(spark, monkeypatch, tmpdir_path):
    built = []

    def customers(d):
        built.append("customer")
        return raw(spark, [(1, T0, {"a": 1}), (2, T0, "{bad"), (None, T1, {"a": 2})])

    def tickets(d):
        built.append("ticket")
        return raw(spark, [(1, T0, {"a": 1}), (1, T0, {"a": 1}), (1, T1, "{bad")])
    monkeypatch.setattr(Q, "RAW_TABLES", {"Customer_Dim": customers, "Ticket_Fact": tickets, "TicketItem_Fact": tickets})
    monkeypatch.setattr(Q, "_log_path", lambda d: os.path.join(tmpdir_path, "log"))
    d = SimpleNamespace(t=SimpleNamespace(spark=spark))
    assert [tuple(r) for r in Q.load_date_histogram(d).collect()] == [(T1.date(), 1), (T0.date(), 2)]
    assert built == ["customer"]
    assert [tuple(r) for r in Q.rows_per_office(d).collect()] == [(1, 3, T1)]
    assert built == ["customer", "ticket"]
    got = {(r.entity, r.OfficeID, r.LoadDatetimeUTC): (r.records, r.bad) for r in Q.load_log(d).collect()}
    assert built == ["customer", "ticket"]
    lines = {(1, T0): (2, 0), (1, T1): (1, 1)}
    assert got == {("Customer_Dim", 1, T0): (1, 0), ("Customer_Dim", 2, T0): (1, 1), ("Customer_Dim", None, T1): (1, 0)} \
        | {(e, *k): v for e in ("Ticket_Fact", "TicketItem_Fact") for k, v in lines.items()}


def test_reports_that_count_loads_read_no_text(spark, monkeypatch, tmpdir_path):
    built, unread = [], F.raise_error(F.lit("a text was read")).cast("string")

    def customers(d):
        built.append("customer")
        return raw(spark, [(1, T0, {"a": 1}), (None, T1, "{bad"), (2, T1, {"a": 2}), (2, T1, {"a": 2})]).withColumn("RawDataString", unread)

    def tickets(d):
        built.append("ticket")
        return raw(spark, [(1, T0, "{bad"), (1, None, {"a": 1})])
    monkeypatch.setattr(Q, "RAW_TABLES", {"Customer_Dim": customers, "Ticket_Fact": tickets, "TicketItem_Fact": tickets})
    monkeypatch.setattr(Q, "_log_path", lambda d: os.path.join(tmpdir_path, "log"))
    d = SimpleNamespace(t=SimpleNamespace(spark=spark))
    assert Q.load_log(d, "Ticket_Fact").count() == 2  # one table is in the full log, two are not
    fresh = {("Customer_Dim", 4, T1, 21), ("Ticket_Fact", 2, T0, 48), ("TicketItem_Fact", 2, T0, 48)}
    assert {tuple(r) for r in Q.table_freshness(d, "2024-01-03 00:00:00").collect()} == fresh
    today = {("Customer_Dim", 3, 1, T1), ("Ticket_Fact", 0, 0, None), ("TicketItem_Fact", 0, 0, None)}
    assert {tuple(r) for r in Q.loads_today(d, "2024-01-02 09:00:00").collect()} == today
    assert {tuple(r) for r in Q.stale_tables(d, "2024-01-03 00:00:00").collect()} == {("Ticket_Fact", 48), ("TicketItem_Fact", 48)}
    assert built.count("customer") == 1
    monkeypatch.setitem(Q.RAW_TABLES, "Customer_Dim", lambda d: raw(spark, [(1, T0, {"a": 1}), (None, T1, "{bad")]))
    got = {(r.entity, r.OfficeID, r.LoadDatetimeUTC, r.records, r.bad) for r in Q.load_log(d).collect()}
    lines = {(1, T0, 1, 1), (1, None, 1, 0)}  # a log of loads does not stand in for the full one
    assert got == {("Customer_Dim", 1, T0, 1, 0), ("Customer_Dim", None, T1, 1, 1)} | {(e, *x) for e in ("Ticket_Fact", "TicketItem_Fact") for x in lines}


def test_first_upsert_writes_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    rows = [(k % 5, T0 if k < 5 else T1, f"v{k}") for k in range(10)]
    source = spark.createDataFrame(rows, "itemID long, lastLoadTime timestamp_ntz, v string")
    assert {(r.itemID, r.v) for r in buckets.upsert(spark, path, source, "itemID", buckets=4).collect()} == {(k, f"v{k + 5}") for k in range(5)}
    assert not os.path.exists(os.path.join(path, "_incoming"))
    later = spark.createDataFrame([(1, T0, "old"), (9, T0, "new")], source.schema)
    assert {r.v for r in buckets.upsert(spark, path, later, "itemID").collect()} == {"v5", "v6", "v7", "v8", "v9", "new"}


def _shuffles(spark):
    return spark.sparkContext._jsc.sc().newShuffleId()


def _left(spark, ids):
    """Shuffle files of these shuffles that are still on the disk."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(k).name() for k in range(blocks.size())]
    return [x for x in names if x.startswith("shuffle_") and int(x.split("_")[1]) in ids]


def test_upsert_shuffles_a_batch_once_and_frees_its_files(spark, tmpdir_path):
    path, kept = os.path.join(tmpdir_path, "t"), {k: spark.conf.get(k, None) for k in (FREE_SHUFFLES, INITIAL, "spark.sql.shuffle.partitions")}
    source = spark.createDataFrame([(k % 40, T0 if k < 40 else T1, f"v{k}") for k in range(80)], "itemID long, lastLoadTime timestamp_ntz, v string")
    first = _shuffles(spark)
    buckets.upsert(spark, path, latest_per_key(source, "itemID", "lastLoadTime"), "itemID", buckets=4)
    made = set(range(first + 1, _shuffles(spark)))
    assert len(made) == 1
    assert max(len(os.listdir(f)) for f in glob.glob(f"{path}/data/*/bucket=*")) <= 2  # a data file and its checksum
    again = _shuffles(spark)
    buckets.upsert(spark, path, latest_per_key(source.withColumn("v", F.lit("again")), "itemID", "lastLoadTime"), "itemID")
    made |= set(range(again + 1, _shuffles(spark)))
    assert len(made) == 3  # the batch, and then what is merged
    assert {(r.itemID, r.v) for r in buckets.read(spark, path).collect()} == {(k, "again") for k in range(40)}
    until = time.time() + 20
    while _left(spark, made) and time.time() < until:
        time.sleep(0.2)
    assert not _left(spark, made)
    assert kept == {k: spark.conf.get(k, None) for k in kept}


def test_table_of_an_older_manifest_keeps_its_buckets(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    old = spark.createDataFrame([(k, T0, "old") for k in range(20)], "itemID long, lastLoadTime timestamp_ntz, v string")
    of = F.pmod(F.xxhash64("itemID"), F.lit(4)).cast("int")
    old.withColumn("bucket", of).write.partitionBy("bucket").parquet(f"{path}/data/w")
    os.makedirs(f"{path}/_manifests")
    with open(f"{path}/_manifests/1.json", "w") as f:
        json.dump({"version": 1, "n": 4, "keys": ["itemID"], "order": "lastLoadTime", "schema": old.schema.json(), "buckets": {str(k): "w" for k in range(4)}, "batches": {}}, f)
    later = spark.createDataFrame([(k, T1, "new") for k in range(10, 30)], old.schema)
    buckets.upsert(spark, path, later, "itemID")
    assert {(r.itemID, r.v) for r in buckets.read(spark, path).collect()} == {(k, "old" if k < 10 else "new") for k in range(30)}
    w = buckets.manifest(spark, path).buckets
    held = spark.read.option("basePath", path + "/data/" + w["0"]).parquet(*(f"{path}/data/{w[b]}/bucket={b}" for b in w))
    assert held.filter(F.col("bucket") != of).count() == 0


def test_a_mart_stages_the_widest_tables_first(spark, monkeypatch):
    asked = []

    class Recorded(staging.StagedDomain):
        def table(self, entity):
            asked.append(entity)
            return spark.createDataFrame([], contract(entity))
    monkeypatch.setattr(staging, "StagedDomain", Recorded)
    mart = staging.registry_entries()["payment_velocity_staged"](SimpleNamespace(t=SimpleNamespace(spark=spark)))
    assert asked[:2] == ["payment", "ticket"] and set(asked) == {"payment", "ticket", "applied_payment"} and mart.count() == 0


def test_landing_by_partition_shuffles_no_text(spark, domain, tmpdir_path):
    path, first = os.path.join(tmpdir_path, "in"), _shuffles(spark)
    rows = raw(spark, [(1, T0, {"itemID": k}) for k in range(30)]).repartition(3, "RawDataString")
    land_files(rows, path, n_files=None)
    assert set(range(first + 1, _shuffles(spark))) == {first + 1}
    assert len(glob.glob(f"{path}/*.json.gz")) == 3 and spark.read.json(path).count() == 30
    assert R.raw_ticket(domain, 5).rdd.getNumPartitions() == 5


def test_stream_keeps_the_versions_asked_for(spark, tmpdir_path):
    at = lambda x: os.path.join(tmpdir_path, x)
    land_files(raw(spark, [(1, T0, {"itemID": k, "v": "a"}) for k in range(20)] + [(1, T0, "{bad")]), at("in"), n_files=4)
    files = glob.glob(at("in/*.json*"))
    assert files and all(f.endswith(".json.gz") for f in files)
    run_upsert_stream(spark, at("in"), SPEC, at("target"), at("bad"), checkpoint=at("progress"), buckets=4, max_files_per_trigger=2, keep=1)
    assert len(buckets.versions(spark, at("target"))) == 1
    used = set(buckets.manifest(spark, at("target")).buckets.values())
    assert set(os.listdir(at("target/data"))) == used
    assert sorted(r.itemID for r in current_rows(spark, at("target"), SPEC.names).collect()) == list(range(20))
    assert spark.read.option("recursiveFileLookup", "true").parquet(at("bad")).count() == 1


def test_layer_counts_read_keys_only(domain, monkeypatch):
    read, project = [], EntitySpec.project
    monkeypatch.setattr(EntitySpec, "project", lambda self, rows: (read.append((self.name, self.names, list(self.keys) + list(self.tie_breakers))), project(self, rows))[1])
    Q.layer_row_counts(domain)
    assert len(read) == 3 and all(set(names) <= set(known) for _, names, known in read)


def test_records_are_dealt_out_before_they_are_widened(spark):
    events = spark.createDataFrame([(k, T0, k, "click", 1.0, "x") for k in range(4)],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df = R.raw_landed_fact(SimpleNamespace(t=SimpleNamespace(events=events)), TASK)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "date_format" not in plan.split("RepartitionByExpression")[1].lower()
    assert df.count() == 8


def test_shuffles_start_with_more_partitions_for_larger_tables(spark, monkeypatch, tmpdir_path):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    spark.range(1000).write.parquet(os.path.join(tmpdir_path, "lineitem.parquet"))
    try:
        spark.conf.unset(key)
        tables.load_tables(spark, tmpdir_path)
        assert spark.conf.get(key, None) is None  # a small table: the session's own number
        monkeypatch.setattr(tables, "PIECE_BYTES", 64)
        n = tables.pieces(spark, tmpdir_path)
        tables.load_tables(spark, tmpdir_path)
        assert n > 8 and spark.conf.get(key) == str(n)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
