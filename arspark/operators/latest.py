"""Versioned-record operators: keep the newest version of each business key.

The raw log holds one row per record per load; every consumer wants only the
latest version. ``latest_per_key`` is a ``row_number() == 1`` over a window
partitioned by the key. Spark (3.5+) plans this as a *partial* WindowGroupLimit
before the shuffle, so each map task already drops older versions it sees, and
the exchange is hash-partitioned on the key only (no global sort, no skew from
hot offices because the key is the record id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, key, order, tie_breakers: Sequence = ()) -> DataFrame:
    """Newest row per ``key`` by ``order`` descending (NULLs last), with
    deterministic ``tie_breakers`` (also descending)."""
    order_cols = [c.desc_nulls_last() for c in _cols(order)] + \
                 [c.desc_nulls_last() for c in _cols(list(tie_breakers))]
    w = Window.partitionBy(*_cols(key)).orderBy(*order_cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_snapshot(df: DataFrame, load_col: str = "LoadDatetimeUTC", distinct_cols=None) -> DataFrame:
    """Rows of the single newest load (as-written dimension refresh), DISTINCT.

    The max is a one-row aggregate joined back by broadcast: its size is one row
    by construction."""
    mx = df.agg(F.max(load_col).alias("__mx"))
    out = df.join(F.broadcast(mx), F.col(load_col) == F.col("__mx"), "inner").drop("__mx")
    # VARIANT values can't be compared: rows are told apart by the other columns
    plain = [f.name for f in out.schema.fields if f.dataType.typeName() != "variant"]
    return out.dropDuplicates(list(distinct_cols) if distinct_cols else plain)


def latest_batch(df: DataFrame, by: str = "OfficeID", load_col: str = "LoadDatetimeUTC") -> DataFrame:
    """Rows of the newest load of each ``by`` group (per-office latest batch).

    A two-phase aggregate (max per group, partial-aggregated map side) joined
    back on (group, load time); this avoids a window that would funnel one hot
    office into one task. The aggregate has one row per office - bounded by the
    office dimension - and is broadcast, so the newest batch of a large office
    is not a hot join key either."""
    mx = df.groupBy(F.col(by).alias("__by")).agg(F.max(load_col).alias("__mx"))
    return df.join(F.broadcast(mx), (df[by] == F.col("__by")) & (df[load_col] == F.col("__mx")), "left_semi")


def recent_window(df: DataFrame, now, hours: int = 48, load_col: str = "LoadDatetimeUTC") -> DataFrame:
    """Only rows loaded in the last ``hours`` (prunes load-time partitions)."""
    now_c = F.lit(now) if not isinstance(now, Column) else now
    return df.filter(F.col(load_col) >= now_c - F.make_interval(hours=F.lit(hours)))


def changed_or_added(df: DataFrame, key, updated: str, added: str, lo, hi) -> DataFrame:
    """Records updated OR created inside [lo, hi]; of several versions of a key the last updated (ties: last added)."""
    lo_c, hi_c = F.lit(lo), F.lit(hi)
    cond = F.col(updated).between(lo_c, hi_c) | F.col(added).between(lo_c, hi_c)
    return latest_per_key(df.filter(cond), key, updated, [added])


def cdc_window(last_run, now, overlap_minutes: int = 15, first_run_hours: int = 2) -> Column:
    """Start of the change window: last successful run minus an overlap,
    or ``now`` minus ``first_run_hours`` on the first run."""
    lr = F.col(last_run) if isinstance(last_run, str) else last_run
    now_c = now if isinstance(now, Column) else F.lit(now)
    return F.coalesce(lr - F.make_interval(mins=F.lit(overlap_minutes)),
                      now_c - F.make_interval(hours=F.lit(first_run_hours)))


def changes_since(raw: DataFrame, watermarks: DataFrame, entity: str, now, overlap_minutes: int = 15,
                  first_run_hours: int = 2, load_col: str = "LoadDatetimeUTC") -> DataFrame:
    """Raw rows of one entity inside each office's change window, up to ``now``.

    ``watermarks`` has one row per (office_id, entity_name) with
    last_success_utc; an office without one is on its first run, as is one whose
    last_success_utc is NULL. Of a landed raw table (with its ``LoadDate``) only
    the folders of the windows are read."""
    now_c = now if isinstance(now, Column) else F.lit(now)
    own = watermarks.filter(F.col("entity_name") == entity).select(
        F.col("office_id").alias("__office"), cdc_window("last_success_utc", now_c, overlap_minutes, first_run_hours).alias("__from"))
    upto = raw.filter(F.col(load_col) <= now_c)
    inside = F.col(load_col) >= F.coalesce("__from", now_c - F.make_interval(hours=F.lit(first_run_hours)))
    if "LoadDate" not in raw.columns:
        return upto.join(own, F.col("OfficeID") == F.col("__office"), "left").filter(inside).drop("__office", "__from")
    # a table with a folder for each office and day: the days of an office's window are joined to its folders, so the
    # scan is pruned by them at run time; offices on their first run have one window, which prunes before it
    days = own.withColumn("__day", F.explode(F.sequence(F.to_date("__from"), F.to_date(now_c))))
    known = upto.join(days, (F.col("OfficeID") == F.col("__office")) & (F.col("LoadDate") == F.col("__day")))
    first = now_c - F.make_interval(hours=F.lit(first_run_hours))
    new = upto.filter(F.col("LoadDate").between(F.to_date(first), F.to_date(now_c)) & (F.col(load_col) >= first))
    new = new.join(own, F.col("OfficeID") == F.col("__office"), "left_anti")
    return known.filter(inside).drop("__office", "__from", "__day").unionByName(new)


def _names(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def lag_split(df: DataFrame, group: Sequence[str], split: str, order: str, value: str, out: str) -> DataFrame:
    """``lag(value) over (partition by group order by split, order)`` without
    putting a whole group into one task.

    Rows are windowed per (group, split) - e.g. per customer *and day* - so a
    customer holding a large share of all rows is spread over many tasks. The
    first row of each (group, split) bucket takes the last value of the
    previous bucket, found with a partial aggregate (``max_by``) per bucket and
    a lag over the bucket table (one row per bucket). The result equals the
    single-window lag exactly (NULL ``split`` values sort first, as in the
    window)."""
    g = list(group)
    w_in = Window.partitionBy(*g, split).orderBy(order)
    rows = df.withColumn("__prev_in", F.lag(value).over(w_in)) \
        .withColumn("__first", F.row_number().over(w_in) == 1)
    last = df.groupBy(*g, split).agg(F.max_by(value, order).alias("__last"))
    w_b = Window.partitionBy(*g).orderBy(F.col(split).asc_nulls_first())
    prev_b = last.withColumn("__prev_b", F.lag("__last").over(w_b)).drop("__last")
    # a NULL split bucket sorts first, so its previous bucket is NULL anyway
    # null-safe: a NULL group is a group like any other, as in the window
    names = [*g, split]
    prev_b = prev_b.select(*(F.col(c).alias(f"__k{k}") for k, c in enumerate(names)), "__prev_b")
    same = [F.col(c).eqNullSafe(F.col(f"__k{k}")) for k, c in enumerate(names)]
    j = rows.join(prev_b, same, "left").drop(*(f"__k{k}" for k in range(len(names))))
    return j.withColumn(out, F.when(F.col("__first"), F.col("__prev_b")).otherwise(F.col("__prev_in"))) \
        .drop("__prev_in", "__first", "__prev_b")


def exact_median(df: DataFrame, group: Sequence[str], value: str, out: str = "median", buckets: int = 256) -> DataFrame:
    """PERCENTILE_CONT(0.5) per group; no task sees more than a small part of a group's values.

    Rows are first reduced to a histogram: one row per (group, distinct value)
    with its count, partially aggregated map side. A quantile sketch of bounded
    size cuts each group's values into ``buckets`` ranges of about equal size
    (however rough the cuts are, they are in order); the ranges' counts tell
    which of them hold the two middle ranks, and only inside those are values
    ordered. Interpolation is ``(hi - pos) * v_lo + (pos - lo) * v_hi`` at
    ``pos = (n - 1) / 2``, the same arithmetic as Spark's exact ``percentile``."""
    g = list(group)
    h = df.filter(F.col(value).isNotNull()).groupBy(*g, value).agg(F.count(F.lit(1)).alias("__c"))
    share = [k / buckets for k in range(1, buckets)]

    def renamed(t):  # a NULL group is a group like any other
        return t.select(*(F.col(c).alias(f"__k{k}") for k, c in enumerate(g)), *(c for c in t.columns if c not in g))
    same = [F.col(c).eqNullSafe(F.col(f"__k{k}")) for k, c in enumerate(g)]
    keys = [f"__k{k}" for k in range(len(g))]
    pos = (F.col("__n") - 1).cast("double") * 0.5
    cuts = h.groupBy(*g).agg(F.percentile_approx(value, share, 10 * buckets).alias("__cuts"), F.sum("__c").alias("__n"))
    step = max(2, round(buckets ** 0.5))  # a value is placed among every step-th cut first, then among those between two of them
    cuts = cuts.withColumn("__coarse", F.filter("__cuts", lambda x, i: (i + 1) % step == 0))
    cuts = cuts.withColumn("__pos", pos).withColumn("__lo", F.floor(pos)).withColumn("__hi", F.ceil(pos)).drop("__n")
    cut = h.join(renamed(cuts), same) if g else h.crossJoin(cuts)  # one row of cuts
    below = lambda a: F.size(F.filter(a, lambda x: x < F.col(value)))
    cut = cut.withColumn("__b", below("__coarse") * step)
    cut = cut.withColumn("__b", F.col("__b") + below(F.slice("__cuts", F.col("__b") + 1, F.lit(step - 1)))).drop("__cuts", "__coarse", *keys)
    per = cut.groupBy(*g, "__b").agg(F.sum("__c").alias("__in"), F.first("__lo").alias("__l"), F.first("__hi").alias("__h"))
    before = F.sum("__in").over(Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__in")
    holds = lambda r: (F.col("__before") <= F.col(r)) & (F.col(r) < F.col("__before") + F.col("__in"))
    picked = per.withColumn("__before", before).filter(holds("__l") | holds("__h")).select(*g, F.col("__b").alias("__pb"), "__before")
    m = cut.join(renamed(picked), [*same, F.col("__b") == F.col("__pb")]).drop("__pb", *keys)
    run = Window.partitionBy(*g, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("__cum", F.col("__before") + F.sum("__c").over(run))
    m = m.groupBy(*g).agg(F.first("__pos").alias("__pos"), F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"),
                          F.min(F.when(F.col("__cum") > F.col("__lo"), F.col(value))).alias("__vlo"),
                          F.min(F.when(F.col("__cum") > F.col("__hi"), F.col(value))).alias("__vhi"))
    med = F.when((F.col("__lo") == F.col("__hi")) | (F.col("__vlo") == F.col("__vhi")), F.col("__vlo").cast("double")) \
        .otherwise((F.col("__hi") - F.col("__pos")) * F.col("__vlo").cast("double")
                   + (F.col("__pos") - F.col("__lo")) * F.col("__vhi").cast("double"))
    return m.select(*g, med.alias(out))
