"""Table-driven typed projection of raw JSON records.

An :class:`EntitySpec` lists, per output column, the candidate JSON paths
(variant paths are case-sensitive, and the source renamed fields over time; the
all-lower-case spelling of each path is tried after those listed), the target type and the cleaning rule. ``project`` turns raw variant rows into
typed rows: one pass reads every field of a record, and bad values become NULL instead of failing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arspark.functions.dates import clean_date, clean_time_of_day, clean_ts


#: What a kind of column is read as; texts are cleaned after reading.
_READ = {"money": "decimal(18,2)", "date": "string", "timestamp": "string", "time": "string", "array": "array<variant>"}
_CLEAN = {"date": clean_date, "timestamp": clean_ts, "time": clean_time_of_day}


@dataclass(frozen=True)
class Col:
    name: str
    paths: Sequence[str]
    type: str = "bigint"  # bigint | int | money | double | string | boolean | date | timestamp | time | array | variant

    @property
    def read_as(self) -> str:
        return _READ.get(self.type, self.type)

    @property
    def fields(self) -> list[str]:
        """Record fields that are tried, in order: each path as listed, then all in lower case."""
        plain = [p.removeprefix("$.") for p in self.paths]
        return list(dict.fromkeys([*plain, *(p.lower() for p in plain)]))

    def of(self, read: dict[str, Column]) -> Column:
        """The column's value, given what was read of each field."""
        clean = _CLEAN.get(self.type, lambda c: c)
        parts = [clean(read[f]) for f in self.fields]
        return (parts[0] if len(parts) == 1 else F.coalesce(*parts)).alias(self.name)


def read_fields(raw: DataFrame, columns: Sequence[Col]) -> tuple[DataFrame, list[dict[str, Column]]]:
    """``raw`` with all fields that ``columns`` try, read from ``RawData`` in one pass, and each column's view of them.

    The record is turned into one struct (a bad value becomes NULL in it), not
    looked up once for each field and spelling. ``inline`` keeps the optimizer
    from repeating that for each column or filter above."""
    slots: dict[tuple[str, str], str] = {}
    by_type: dict[str, list[str]] = {}
    for c in columns:
        for f in c.fields:
            kind = by_type.setdefault(f, [])
            if c.read_as not in kind:
                kind.append(c.read_as)
    for f, kinds in by_type.items():
        for k in kinds:
            slots[f, k] = f"__f{len(slots)}"
    # a field that columns of different types share is read as it is and cast for each
    read_as = {f: k[0] if len(k) == 1 else "variant" for f, k in by_type.items()}
    quoted = lambda f: "`" + f.replace("`", "``") + "`"
    first = {f: slots[f, k[0]] for f, k in by_type.items()}
    struct = F.try_variant_get("RawData", "$", "struct<" + ",".join(f"{quoted(f)}:{k}" for f, k in read_as.items()) + ">")
    struct = struct.cast("struct<" + ",".join(f"{first[f]}:{k}" for f, k in read_as.items()) + ">")  # by place: names may differ in case only
    out = raw.select("*", F.inline(F.array(struct)))
    views = [{f: F.col(first[f]) if read_as[f] == c.read_as else F.try_variant_get(first[f], "$", c.read_as) for f in c.fields} for c in columns]
    return out, views


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: object  # column name, or tuple of names for a composite key
    columns: Sequence[Col]
    plural: str = ""
    tie_breakers: Sequence[str] = field(default_factory=tuple)
    sensitive: Sequence[str] = field(default_factory=tuple)

    def project(self, raw: DataFrame) -> DataFrame:
        """Typed columns plus the load metadata (``OfficeID``, ``LoadDatetimeUTC``)."""
        rows, views = read_fields(raw.select("OfficeID", "LoadDatetimeUTC", "RawData"), self.columns)
        cols = []
        for c, view in zip(self.columns, views):
            e = c.of(view)
            if c.name in self.sensitive:  # never land bank/card numbers in clear text
                e = F.sha2(e.cast("string"), 256).alias(c.name)
            cols.append(e)
        return rows.select(F.col("OfficeID").alias("_office"), F.col("LoadDatetimeUTC").alias("lastLoadTime"), *cols)

    def only(self, *names: str) -> EntitySpec:
        """The spec with its keys and these columns: other fields aren't read."""
        return replace(self, columns=[c for c in self.columns if c.name in {*names, *self.keys}],
                       tie_breakers=tuple(t for t in self.tie_breakers if t in names))

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]
