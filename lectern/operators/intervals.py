"""Covered periods and gaps of interval sets, by a sweep line.

Every interval becomes a ``+1`` event at its beginning and a ``-1`` event at
its end. Events of one instant are summed first (map-side), so a group's work
is bounded by its distinct instants. The prefix sum runs in two levels: over
the sums of fixed time buckets, then over the events within a bucket; so no
task ever holds all events of a hot group. Where the active count is zero a
period ends; it starts again at the next event.

Defined cases: an interval with a null, NaN or infinite bound, or whose end is
not after its beginning, is ignored; touching intervals leave no gap; repeats
count once in effect; a null group key is a group of its own; an empty table
gives empty results. Columns other than the keys and bounds are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a bucket of the two-level prefix sum, in milliseconds.
BUCKET_MS = 3_600_000


def millis(seconds: Column) -> Column:
    """Seconds as whole milliseconds, null where they are not a finite number."""
    s = seconds.cast("double")
    ok = s.isNotNull() & ~F.isnan(s) & (F.abs(s) < 9e15)
    return F.when(ok, F.round(s * 1000).cast("long"))


def _with_next(ev: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_next``: the time of the group's next event, within the bucket or at the start of the next one."""
    inner = Window.partitionBy(*keys, "_bucket").orderBy("_t")
    outer = Window.partitionBy(*keys).orderBy("_bucket")
    after = (
        ev.groupBy(*keys, "_bucket")
        .agg(F.min("_t").alias("_first"))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_kb"), F.lead("_first").over(outer).alias("_after"))
    )
    cond = F.col("_bucket") == F.col("_kb")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        ev.withColumn("_here", F.lead("_t").over(inner))
        .join(after, cond, "left")
        .select(*ev.columns, F.coalesce("_here", "_after").alias("_next"))
    )


def sweep(df: DataFrame, keys: list[str], begin_ms: str, end_ms: str, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """One row per distinct boundary instant of a group: keys, ``_t``, ``_bucket``, ``before`` and ``active``.

    ``active`` counts the intervals that cover the stretch after ``_t``,
    ``before`` those that cover the stretch before it.
    """
    iv = df.select(*keys, F.col(begin_ms).alias("_b"), F.col(end_ms).alias("_e")).filter(F.col("_e") > F.col("_b"))
    ev = (
        iv.select(
            *keys,
            F.explode(
                F.array(
                    F.struct(F.col("_b").alias("_t"), F.lit(1).cast("long").alias("_d")),
                    F.struct(F.col("_e").alias("_t"), F.lit(-1).cast("long").alias("_d")),
                )
            ).alias("_x"),
        )
        .select(*keys, "_x.*")
        .groupBy(*keys, "_t")
        .agg(F.sum("_d").alias("_d"))
        .withColumn("_bucket", F.floor(F.col("_t") / F.lit(bucket_ms)).cast("long"))
    )
    outer = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        ev.groupBy(*keys, "_bucket")
        .agg(F.sum("_d").alias("_s"))
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_bucket").alias("_kb"),
            F.coalesce(F.sum("_s").over(outer), F.lit(0).cast("long")).alias("_base"),
        )
    )
    inner = Window.partitionBy(*keys, "_bucket").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    cond = F.col("_bucket") == F.col("_kb")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        ev.withColumn("_run", F.sum("_d").over(inner))
        .join(base, cond, "inner")
        .withColumn("active", F.col("_base") + F.col("_run"))
        .withColumn("before", F.col("active") - F.col("_d"))
        .select(*keys, "_t", "_bucket", "before", "active")
    )


def gaps(df: DataFrame, keys: list[str], begin_ms: str, end_ms: str, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Maximal uncovered stretches between a group's first beginning and last end: keys, gap_from_ms, gap_to_ms."""
    ev = sweep(df, keys, begin_ms, end_ms, bucket_ms).filter((F.col("active") == 0) | (F.col("before") == 0))
    # an instant where one interval ends and another begins has active > 0 and before > 0: no gap
    nx = _with_next(ev, keys)
    return nx.filter((F.col("active") == 0) & F.col("_next").isNotNull()).select(
        *keys, F.col("_t").alias("gap_from_ms"), F.col("_next").alias("gap_to_ms")
    )


def periods(df: DataFrame, keys: list[str], begin_ms: str, end_ms: str, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Maximal covered stretches of each group: keys, from_ms, to_ms."""
    ev = sweep(df, keys, begin_ms, end_ms, bucket_ms).filter((F.col("active") == 0) | (F.col("before") == 0))
    nx = _with_next(ev, keys)
    return nx.filter(F.col("active") > 0).select(*keys, F.col("_t").alias("from_ms"), F.col("_next").alias("to_ms"))
