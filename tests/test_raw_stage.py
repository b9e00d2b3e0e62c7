import datetime as dt
import json

from pyspark.sql import functions as F

from arspark.operators.spec import Col, EntitySpec
from arspark.operators.stage import stage, stage_dimension
from arspark.sources.raw import bad_json_count, bad_json_sample, explode_records, parse_raw

SPEC = EntitySpec("thing", "thingID", [
    Col("thingID", ("thingID",), "bigint"), Col("name", ("name", "firstName"), "string"),
    Col("amount", ("amount",), "money"), Col("active", ("active",), "boolean"),
    Col("dateAdded", ("dateAdded",), "date"), Col("dateUpdated", ("dateUpdated",), "timestamp"),
    Col("acct", ("acct",), "string")], tie_breakers=("amount",), sensitive=("acct",))


def raw(spark, rows):
    return spark.createDataFrame([(o, ts, s if isinstance(s, str) else json.dumps(s)) for o, ts, s in rows],
                                 "OfficeID bigint, LoadDatetimeUTC timestamp_ntz, RawDataString string")


T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_parse_and_quarantine(spark):
    df = raw(spark, [(1, T0, {"thingID": 1}), (1, T0, "{bad"), (2, T0, "")])
    good, bad = parse_raw(df)
    assert good.count() == 1 and bad.count() == 2
    counts = {r.OfficeID: (r.badRows, r.totalRows) for r in bad_json_count(df).collect()}
    assert counts == {1: (1, 2), 2: (1, 1)}
    assert bad_json_sample(df, n=5).count() == 2


def test_typed_projection_edge_values(spark):
    df = raw(spark, [
        (1, T0, {"thingID": 1, "firstName": "old-name", "amount": "12.50", "active": "1", "dateAdded": "0000-00-00",
                 "dateUpdated": "0000-00-00 00:00:00", "acct": "123"}),
        (1, T0, {"thingID": 2, "name": "n", "amount": 3, "active": True, "dateAdded": "",
                 "dateUpdated": "2024-01-01 10:00:00"}),
        (1, T0, {"thingID": 3, "active": 1, "dateAdded": "2024-02-30"}),
        (1, T0, {"name": "no key"}),
    ])
    st = stage(df, SPEC)
    rows = {r.thingID: r for r in st.rows.collect()}
    assert rows[1].name == "old-name" and float(rows[1].amount) == 12.5 and rows[1].active is True
    assert rows[1].dateAdded is None and rows[1].dateUpdated is None
    assert rows[1].acct != "123" and len(rows[1].acct) == 64  # hashed, never in clear text
    assert rows[2].active is True and rows[2].dateAdded is None
    assert rows[2].dateUpdated == dt.datetime(2024, 1, 1, 10, 0)
    assert rows[3].active is True and rows[3].dateAdded is None
    assert st.null_keys.count() == 1


def test_latest_version_and_ties(spark):
    df = raw(spark, [(1, T0, {"thingID": 1, "name": "v1", "amount": 1}),
                     (1, T1, {"thingID": 1, "name": "v2", "amount": 1}),
                     (1, T1, {"thingID": 1, "name": "v2b", "amount": 2})])
    rows = stage(df, SPEC).rows.collect()
    assert [r.name for r in rows] == ["v2b"]  # newest load, then highest tie-breaker


def test_merge_never_replaces_newer_with_older(spark):
    newer = stage(raw(spark, [(1, T1, {"thingID": 1, "name": "new"})]), SPEC).rows
    older_batch = raw(spark, [(1, T0, {"thingID": 1, "name": "old"}), (1, T0, {"thingID": 9, "name": "nine"})])
    merged = {r.thingID: r.name for r in stage(older_batch, SPEC, target=newer).rows.collect()}
    assert merged == {1: "new", 9: "nine"}
    # replaying the same batch changes nothing
    again = stage(older_batch, SPEC, target=stage(older_batch, SPEC, target=newer).rows).rows
    assert {r.thingID: r.name for r in again.collect()} == merged


def test_dimension_as_written_vs_default(spark):
    df = raw(spark, [(1, T1, {"thingID": 1, "name": "a"}), (2, T0, {"thingID": 2, "name": "b"})])
    assert stage_dimension(df, SPEC).count() == 2
    assert stage_dimension(df, SPEC, as_written=True).count() == 1


def test_explode_response_shapes(spark):
    df = raw(spark, [(1, T0, {"customers": [{"id": 1}, {"id": 2}]}),
                     (1, T0, {"propertyNameData": [{"id": 3}]}),
                     (1, T0, {"propertyNameData": {"a": {"id": 4}}}),
                     (1, T0, [{"id": 5}])])
    good, _ = parse_raw(df)
    ids = sorted(r.i for r in explode_records(good, "customers")
                 .select(F.try_variant_get("RawData", "$.id", "int").alias("i")).collect())
    assert ids == [1, 2, 3, 4, 5]


def test_merge_is_independent_of_batch_order(spark):
    a = raw(spark, [(1, T0, {"thingID": 1, "name": "a0"}), (1, T1, {"thingID": 2, "name": "a1"})])
    b = raw(spark, [(1, T1, {"thingID": 1, "name": "b1"}), (1, T0, {"thingID": 2, "name": "b0"}),
                    (1, T0, {"thingID": 3, "name": "b3"})])
    ab = stage(b, SPEC, target=stage(a, SPEC).rows).rows
    ba = stage(a, SPEC, target=stage(b, SPEC).rows).rows
    once = stage(a.unionByName(b), SPEC).rows
    as_map = lambda df: {r.thingID: r.name for r in df.collect()}
    assert as_map(ab) == as_map(ba) == as_map(once) == {1: "b1", 2: "a1", 3: "b3"}


def test_incremental_window_on_text_and_parsed_raw(spark):
    df = raw(spark, [(1, T0, {"thingID": 1, "name": "old"}), (1, T1, {"thingID": 2, "name": "new"})])
    now = dt.datetime(2024, 1, 2, 12)
    assert [r.thingID for r in stage(df, SPEC, now=now, hours=24).rows.collect()] == [2]
    parsed, _ = parse_raw(df)
    assert [r.thingID for r in stage(parsed, SPEC, now=now, hours=24).rows.collect()] == [2]


# How many columns each entity has.
COLUMN_COUNTS = {"customer": 82, "subscription": 82, "employee": 34, "ticket": 23, "payment": 27, "applied_payment": 12,
                 "appointment": 43, "note": 23, "payment_profile": 36, "route": 27}


def test_every_entity_has_its_columns():
    from arspark.sources.staged import DIMS, FACTS
    for entity, n in COLUMN_COUNTS.items():
        names = FACTS[entity][1].names
        assert len(names) == n == len({x.lower() for x in names}), entity
    wide = {e: len(spec.names) for e, (_, spec) in DIMS.items()}
    assert wide == {"office": 15, "region": 8, "service_type": 21, "customer_source": 7, "cancellation_reason": 3, "product": 11,
                    "generic_flag": 8, "reservice_reason": 4}


def test_record_is_read_once(spark):
    """However many columns: the text is parsed once and the record read once."""
    from arspark.sources.specs import CUSTOMER
    rows = stage(raw(spark, [(1, T0, {"customerID": 1})]), CUSTOMER).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("try_variant_get") == 1


def test_fields_of_one_name_and_two_kinds(spark):
    spec = EntitySpec("t", "k", [Col("k", ("k",)), Col("day", ("at",), "date"), Col("at", ("at",), "variant"), Col("n", ("N",), "int"),
                                 Col("list", ("list",), "array"), Col("time", ("clock",), "time"), Col("half", ("half",), "double")])
    df = raw(spark, [(1, T0, {"k": 1, "at": "2024-03-01 10:00:00", "N": "x", "n": 7, "list": [1, "a"], "clock": "2024-01-01 09:08:07", "half": "0.5"}),
                     (1, T0, {"K": 2}), (1, T0, "[1, 2]"), (1, T0, "3"), (1, T0, {"k": 4, "list": {"a": 1}, "at": {"b": 2}, "clock": ""})])
    st = stage(df, spec)
    got = {r.k: r for r in st.rows.select("k", "day", F.to_json("at").alias("at"), "n", F.size("list").alias("size"), "time", "half").collect()}
    assert (str(got[1].day), got[1].at, got[1].n, got[1].size, got[1].time, got[1].half) == ("2024-03-01", '"2024-03-01 10:00:00"', 7, 2, "09:08:07", 0.5)
    assert (got[4].day, got[4].at, got[4].size, got[4].time) == (None, '{"b":2}', -1, None) or got[4].size is None
    assert st.null_keys.count() == 3 and st.bad_json.count() == 0
