"""Marts over staged tables: the same rows as over the adapter; contracts."""

import pytest
from pyspark.sql import functions as F

from arspark.operators import buckets
from arspark.plans import ar, customer, measures, ops, revenue
from arspark.plans.common import decimals_to_double
from arspark.sources.staged import ENTITIES, ContractError, StagedDomain, check, stage_tables

MARTS = [
    ar.ar_aging, ar.ar_aging_prod, ar.ar_bucket_summary, ar.ar_summary_by_customer, ar.ticket_totals_12m, ar.dso_metrics, ar.dso_metrics_prod,
    ar.dso_trend, ar.cei_metrics, ar.cei_metrics_prod, ar.ar_waterfall, ar.ar_waterfall_prod, ar.payment_declines, ar.revenue_leakage,
    ar.agency_performance, ar.ar_rep_productivity, ar.ar_program_performance, ar.data_quality_flags, revenue.daily_revenue_summary,
    revenue.payment_method_analysis, revenue.collection_performance, revenue.payment_velocity, revenue.revenue_leakage_prod, revenue.revenue_by_ticket,
    customer.customer_lifetime_value, customer.customer_lifetime_value_prod, customer.customer_cancellation_reasons_fact,
    customer.customer_cancellation_reasons_view, customer.cancellation_analysis, customer.customer_acquisition, customer.monthly_recurring_revenue,
    ops.technician_productivity, ops.route_efficiency, ops.service_type_performance, ops.subscription_performance, measures.measures_by_office,
]


@pytest.fixture(scope="module")
def staged(spark, domain, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staged"))
    stage_tables(domain, root, buckets=4)
    return StagedDomain(spark, root)


def rows(df):
    df = decimals_to_double(df)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(*rounded).collect()))


@pytest.mark.parametrize("mart", MARTS, ids=lambda m: m.__name__)
def test_marts_read_staged_tables(domain, staged, mart):
    assert rows(mart(staged)) == rows(mart(domain))


def test_staging_again_changes_no_row(spark, domain, staged):
    before = rows(staged.table("office"))
    stage_tables(domain, staged.root, ["office"])
    assert rows(StagedDomain(spark, staged.root).table("office")) == before and len(before) == 25


def test_contracts(spark, domain, staged, tmp_path):
    for entity in ENTITIES:
        staged.table(entity)
    with pytest.raises(ContractError, match="no staged table of office"):
        StagedDomain(spark, str(tmp_path)).office()
    with pytest.raises(ContractError, match="officeName: missing"):
        check("office", staged.table("office").drop("officeName"))
    buckets.upsert(spark, f"{tmp_path}/region", staged.table("region").withColumn("regionID", F.col("regionID").cast("string")), "regionID", buckets=2)
    with pytest.raises(ContractError, match="regionID: string, not int"):
        StagedDomain(spark, str(tmp_path)).region()


def test_columns_are_pruned_on_staged_tables(staged):
    plan = staged.ticket().select("balance").filter("status = 'Completed'")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<balance:decimal(18,2),status:string>" in plan and "EqualTo(status,Completed)" in plan
