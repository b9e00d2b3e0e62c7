"""The domain served from staged, versioned tables: what marts read once the staging jobs have run.

A root folder holds a bucketed table for each entity (``operators.buckets``).
:class:`StagedDomain` has the same entities as the adapter over the driver's
tables, so every mart runs on either. Each table is checked against a contract,
the entity's spec: a column that is missing or has another type is an error
when the table is opened, not a NULL in a report.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType, VariantType

from arspark.operators import buckets as tables
from arspark.operators.spec import EntitySpec
from arspark.operators.stage import stage, stage_dimension
from arspark.sources import rawlog as R
from arspark.sources import specs as S
from arspark.sources.adapter import Domain
from arspark.sources.columns import further
from arspark.sources.tables import pieces

# entity -> (raw log builder, spec)
FACTS: dict[str, tuple[Callable[[Domain], DataFrame], EntitySpec]] = {
    "applied_payment": (R.raw_applied_payment, S.APPLIED_PAYMENT), "ticket": (R.raw_ticket, S.TICKET),
    "customer": (R.raw_customer, S.CUSTOMER), "payment": (R.raw_payment, S.PAYMENT),
    "appointment": (R.raw_appointment, S.APPOINTMENT), "subscription": (R.raw_subscription, S.SUBSCRIPTION),
    "note": (R.raw_note, S.NOTE), "route": (R.raw_route, S.ROUTE), "employee": (R.raw_employee, S.EMPLOYEE),
    "payment_profile": (R.raw_payment_profile, S.PAYMENT_PROFILE),
}
DIMS: dict[str, tuple[Callable[[Domain], DataFrame], EntitySpec]] = {
    "office": (R.raw_office, S.OFFICE), "region": (R.raw_region, S.REGION),
    "service_type": (R.raw_service_type, S.SERVICE_TYPE), "customer_source": (R.raw_customer_source, S.CUSTOMER_SOURCE),
    "cancellation_reason": (R.raw_cancellation_reason, S.CANCELLATION_REASON), "product": (R.raw_product, S.PRODUCT),
    "generic_flag": (R.raw_generic_flag, S.GENERIC_FLAG), "reservice_reason": (R.raw_reservice_reason, S.RESERVICE_REASON),
}
ENTITIES = FACTS | DIMS


class ContractError(ValueError):
    """A staged table lacks a column, or has it in another type."""


def contract(entity: str) -> StructType:
    """Columns and types that a staged table of the entity has, the load's own included."""
    kinds = {"money": "decimal(18,2)", "time": "string", "timestamp": "timestamp_ntz"}
    spec = ENTITIES[entity][1]
    fields = [StructField("_office", StructType.fromDDL("x bigint")["x"].dataType), StructField("lastLoadTime", StructType.fromDDL("x timestamp_ntz")["x"].dataType)]
    for c in spec.columns:
        if c.type in ("array", "variant"):
            kind = ArrayType(VariantType()) if c.type == "array" else VariantType()
        else:
            kind = StructType.fromDDL(f"x {'string' if c.name in spec.sensitive else kinds.get(c.type, c.type)}")["x"].dataType
        fields.append(StructField(c.name, kind))
    return StructType(fields)


def check(entity: str, table: DataFrame) -> DataFrame:
    have = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    wrong = [f"{f.name}: {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}" for f in contract(entity).fields
             if have.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ContractError(f"staged {entity}: {'; '.join(wrong)}")
    return table


def stage_tables(origin: Domain, root: str, entities: Iterable[str] = ENTITIES, buckets: int = 16) -> None:
    """Run the staging jobs: each entity's raw log into its table under ``root``. Running them again changes no row."""
    for e in entities:
        build, spec = ENTITIES[e]
        rows = stage(build(origin), spec).rows if e in FACTS else stage_dimension(build(origin), spec)
        tables.upsert(origin.t.spark, f"{root.rstrip('/')}/{e}", check(e, rows), spec.keys, tie_breakers=spec.tie_breakers, buckets=buckets)


class StagedDomain(Domain):
    """Entities read from the staged tables under ``root``.

    ``origin``: a domain whose raw logs fill a table that isn't there when it is first asked for;
    without one a missing table is an error."""

    def __init__(self, spark: SparkSession, root: str, origin: Domain | None = None):
        super().__init__(origin.t if origin else None)
        self.spark, self.root, self.origin = spark, root.rstrip("/"), origin

    def table(self, entity: str) -> DataFrame:
        """The newest version of a staged table, all columns."""
        found = tables.read(self.spark, f"{self.root}/{entity}")
        if found is None and self.origin is not None:
            stage_tables(self.origin, self.root, [entity], buckets=max(16, pieces(self.spark, self.origin.t.root)))
            found = tables.read(self.spark, f"{self.root}/{entity}")
        if found is None:
            raise ContractError(f"no staged table of {entity} under {self.root}")
        return check(entity, found)

    def _get(self, name, build) -> DataFrame:
        if name not in self._memo:
            # the columns that marts know; table() has all
            rest = {column for column, _, _ in further(name)}
            self._memo[name] = self.table(name).select(*(c for c in ENTITIES[name][1].names if c not in rest))
        return self._memo[name]

    def customer_cancellation_reason_ids(self) -> DataFrame:
        ids = F.transform("cancellationReasonIDs", lambda v: F.try_variant_get(v, "$", "bigint"))
        return self.customer().filter(F.col("dateCancelled").isNotNull()).select(
            "officeID", "customerID", "dateCancelled", ids.alias("cancellationReasonIDs"))
