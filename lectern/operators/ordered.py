"""Ordered operators that stay distributed when one group holds very many rows.

``with_last`` carries the latest non-null value forward; ``chain`` follows
"next" pointers from the start of each group. Both work in buckets or blocks of
a group, with a small table of one row (or a few) per bucket in between.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import staged


def with_last(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, name: str) -> DataFrame:
    """Add ``name``: the latest non-null ``value`` at or before each row.

    ``order`` must be unique within a group, and ``bucket`` not decreasing along it.
    """
    rows = df.withColumn("_bucket", bucket)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        rows.filter(F.col(value).isNotNull())
        .groupBy(*keys, "_bucket")
        .agg(F.max_by(value, F.struct(*order)).alias("_end"))
    )
    # every bucket, also those without a value, gets the last value before it
    carry = (
        rows.select(*keys, "_bucket").distinct().join(ends, [*keys, "_bucket"], "left")
        .withColumn("_carry", F.last("_end", ignorenulls=True).over(outer)).drop("_end")
    )
    return (
        rows.withColumn("_in", F.last(value, ignorenulls=True).over(inner))
        .join(carry, [*keys, "_bucket"], "left")
        .withColumn(name, F.coalesce("_in", "_carry"))
        .drop("_in", "_carry", "_bucket")
    )


def _ranged(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` sorted by ranges and written, with ``name``: each row's place in the order of the whole table, from 0.

    Every range is counted and numbered from its offset, so no task sorts the whole table.
    """
    low = (1 << 33) - 1  # an id holds the range in its upper bits, the row within the range in its lower ones
    part = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    of = F.shiftright("_at", 33)
    counts = part.groupBy(of.alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return part.withColumn("_part", of).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit(low))).drop("_part", "_at", "_before")


def numbered(df: DataFrame, order: list[str | Column], name: str, first: int = 1) -> DataFrame:
    """Add ``name``: each row's place in the order of the whole table. The order should be total."""
    return _ranged(df, order, name).withColumn(name, (F.col(name) + first).cast("long"))


def numbered_in(df: DataFrame, group: str, order: list[str], name: str, first: int = 1) -> DataFrame:
    """Add ``name``: each row's place in the order of its group, without gaps, however many rows the group has."""
    rows = _ranged(df, [F.col(group).asc_nulls_first(), *order], "_all")
    start = rows.groupBy(F.col(group).alias("_g")).agg(F.min("_all").alias("_start"))
    return rows.join(start, F.col(group).eqNullSafe(F.col("_g"))).withColumn(name, (F.col("_all") - F.col("_start") + first).cast("long")).drop("_g", "_start", "_all")


#: Stands for "no next step" among row numbers.
END = -(1 << 62)


def _same(value, n: int) -> pd.Series:
    return pd.Series([value] * n, dtype=object)


#: Stands for "the rows at hand don't tell".
UNKNOWN = END + 1


def chain(
    df: DataFrame, group: str, no: str, payload: list[str], step: Callable[[pd.DataFrame], np.ndarray], block: int = 4096, ahead: int = 1024
) -> DataFrame:
    """group, start, stop: the steps of a greedy walk through each group's rows.

    A walk starts at the group's first row; ``step`` gets consecutive rows
    (``no`` and ``payload``, sorted by ``no``, and ``_last``, the group's last
    number) and gives for each the position, within these rows, of the row at
    which the next step starts, or -1 where the walk ends or the rows don't
    reach far enough. ``no`` counts a group's rows without gaps (``numbered_in``).

    Groups are worked on in blocks of rows, with ``ahead`` more rows in view.
    Groups in which a step needs more are worked on again with eight times as
    many, until all steps are known. A block's rows are first contracted to
    "enter here, leave there" pairs; only pairs at which some block is entered
    remain and are walked per group (a few rows for each block); then every
    block lists the steps from where it is entered.
    """
    kind = df.schema[group].dataType.simpleString()
    df = staged(df.select(group, no, *payload), "chain-rows")
    last = df.groupBy(F.col(group).alias("_g")).agg(F.max(no).alias("_last"))
    rows = df.join(last, F.col(group).eqNullSafe(F.col("_g"))).select(F.col(group).alias("grp"), F.col(no).cast("long").alias("no"), *payload, F.col("_last").cast("long").alias("_last"))
    steps, todo, size, more = None, rows, block, ahead
    while todo is not None:
        some = staged(_contracted(todo, kind, step, size, more), "chain-steps")
        open_ = some.filter(F.col("leave") == UNKNOWN).select(F.col("grp").alias("_g")).distinct()
        again = rows.join(open_, F.col("grp").eqNullSafe(F.col("_g")), "left_semi")
        todo = None if open_.isEmpty() else again
        known = some if todo is None else some.join(open_, F.col("grp").eqNullSafe(F.col("_g")), "left_anti")
        steps = known if steps is None else steps.unionByName(known)
        more *= 8
        size = max(size, more)
    return _walked(steps, group, kind)


def _contracted(rows: DataFrame, kind: str, step, block: int, ahead: int) -> DataFrame:
    """grp, block, no, nxt, leave: where each row's step leads, and where the walk from it leaves the block."""
    own = F.floor(F.col("no") / block).cast("long")
    spread = rows.withColumn("block", F.explode(F.when(F.pmod("no", F.lit(block)) < ahead, F.array(own, own - 1)).otherwise(F.array(own))))

    def contract(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no", kind="stable").reset_index(drop=True)
        b, nos = int(pdf["block"].iloc[0]), pdf["no"].to_numpy()
        mine = int(np.searchsorted(nos, (b + 1) * block))
        nxt = np.asarray(step(pdf))
        end = END if nos[-1] >= pdf["_last"].iloc[0] else UNKNOWN
        leave = np.empty(mine, np.int64)
        for i in range(mine - 1, -1, -1):
            leave[i] = end if nxt[i] < 0 else nos[nxt[i]] if nxt[i] >= mine else leave[nxt[i]]
        to = np.where(nxt[:mine] < 0, end, nos[np.maximum(nxt[:mine], 0)])
        return pd.DataFrame({"grp": _same(pdf["grp"].iloc[0], mine), "block": b, "no": nos[:mine], "nxt": to, "leave": leave})

    # a block number belongs to its size: blocks of different sizes meet later
    return spread.groupBy("grp", "block").applyInPandas(contract, f"grp {kind}, block long, no long, nxt long, leave long")


def _walked(steps: DataFrame, group: str, kind: str) -> DataFrame:
    first = steps.groupBy("grp").agg(F.min("no").alias("no"))
    entered = steps.filter(F.col("leave") != END).select("grp", F.col("leave").alias("no")).unionByName(first).distinct()
    small = entered.join(steps.withColumnRenamed("grp", "_g").withColumnRenamed("no", "_n"), F.col("grp").eqNullSafe(F.col("_g")) & (F.col("no") == F.col("_n"))).select("grp", "no", "leave", "block")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        leave, blocks = dict(zip(pdf["no"], pdf["leave"])), dict(zip(pdf["no"], pdf["block"]))
        at, out = int(pdf["no"].min()), []
        while at != END:
            out.append(at)
            at = int(leave[at])
        return pd.DataFrame({"grp": _same(pdf["grp"].iloc[0], len(out)), "block": [blocks[i] for i in out], "entry": out})

    doors = small.groupBy("grp").applyInPandas(walk, f"grp {kind}, block long, entry long")

    def expand(pdf: pd.DataFrame) -> pd.DataFrame:
        nxt = dict(zip(pdf["no"], pdf["nxt"]))
        at, out = int(pdf["entry"].iloc[0]), []
        while at in nxt:
            out.append((at, nxt[at]))
            at = nxt[at]
        return pd.DataFrame({"grp": _same(pdf["grp"].iloc[0], len(out)), "start": [a for a, _ in out], "stop": [b for _, b in out]})

    d = doors.withColumnRenamed("grp", "_g").withColumnRenamed("block", "_b")
    inside = steps.join(d, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).select("grp", "block", "no", "nxt", "entry")
    out = inside.groupBy("grp", "block").applyInPandas(expand, f"grp {kind}, start long, stop long")
    return out.select(F.col("grp").alias(group), "start", F.when(F.col("stop") != END, F.col("stop")).alias("stop"))
