"""Name -> query builder. Each builder takes a :class:`Domain` and returns a
DataFrame; :func:`run` wires it to a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arspark.plans import ar, customer, measures, ops, quality, revenue, staging, views
from arspark.plans.common import decimals_to_double
from arspark.sources.adapter import Domain
from arspark.sources.tables import load_tables

BUILDERS: dict[str, Callable[[Domain], DataFrame]] = {}


def register(name: str, fn: Callable[[Domain], DataFrame]):
    BUILDERS[name] = fn


for _name in ["ar_aging", "ar_aging_prod", "ar_bucket_summary", "ar_summary_by_customer", "ticket_totals_12m",
              "dso_metrics", "dso_metrics_prod", "dso_trend", "cei_metrics", "cei_metrics_prod", "ar_waterfall",
              "ar_waterfall_prod", "payment_declines", "revenue_leakage", "agency_performance",
              "ar_rep_productivity", "ar_program_performance", "data_quality_flags"]:
    register(_name, getattr(ar, _name))


for _mod, _names in [
    (revenue, ["daily_revenue_summary", "payment_method_analysis", "collection_performance", "payment_velocity",
               "revenue_leakage_prod", "revenue_by_ticket"]),
    (customer, ["customer_lifetime_value", "customer_lifetime_value_prod", "cancellation_analysis",
                "customer_acquisition", "monthly_recurring_revenue"]),
    (ops, ["technician_productivity", "route_efficiency", "service_type_performance", "subscription_performance"]),
]:
    for _name in _names:
        register(_name, getattr(_mod, _name))
for _name in ["measures_by_office", "measures_company", "m_ar_by_office", "m_dso_by_region", "ar_daily_balance"]:
    register(_name, getattr(measures, _name))
register("fact_customer_cancellation_reasons", customer.customer_cancellation_reasons_fact)
register("view_customer_cancellation_reasons", customer.customer_cancellation_reasons_view)


for _name, _fn in {**staging.registry_entries(), **quality.REGISTRY, **views.REGISTRY}.items():
    register(_name, _fn)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(load_tables(spark, sf_dir))
    return decimals_to_double(BUILDERS[name](d))
