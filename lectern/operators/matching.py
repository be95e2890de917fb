"""Greedy one-to-one matching by nearest value.

All pairs sorted by (difference, a, b), each taken if both sides are free. On
one axis what happens far away decides nothing here: the items of both sides
are sorted by value and dealt into blocks of neighbouring ones; within a block
the greedy walk goes through pairs by difference. A pair that an item outside
the block might take part of, being as near or nearer, can't be decided, nor
can a later pair that holds one of its items: these stay for the next round,
in blocks with other borders. Only items near a border, or without a partner,
stay, so rounds are few; where a round decides nothing, blocks grow.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.ordered import numbered
from lectern.session import staged

#: Items of a block to begin with.
BLOCK = 8192


class _Line:
    """One side's items by value, those already taken skipped."""

    def __init__(self, values: np.ndarray, ids: list[str]):
        n = len(ids)
        up = sorted(range(n), key=lambda i: (values[i], ids[i]))
        down = sorted(range(n), key=lambda i: (-values[i], ids[i]))
        self.orders = (up, down)
        self.keys = (np.array([values[i] for i in up], np.int64), np.array([-values[i] for i in down], np.int64))
        self.place = tuple({i: k for k, i in enumerate(o)} for o in self.orders)
        self.skip = (list(range(n + 1)), list(range(n + 1)))

    def at(self, side: int, k: int) -> int:
        """The first place from ``k`` on that isn't taken."""
        s = self.skip[side]
        while s[k] != k:
            s[k] = s[s[k]]
            k = s[k]
        return k

    def take(self, i: int) -> None:
        for side in (0, 1):
            k = self.place[side][i]
            self.skip[side][k] = k + 1


def walk(a_val, a_ids, b_val, b_ids, a_out, b_out) -> list[tuple[int, int, int]]:
    """(place in a, place in b, difference) of the pairs that are sure.

    ``a_out``, ``b_out``: values of the nearest items of each side below and above, None where there is none.
    """
    far = float("inf")
    gap = lambda v, out: min((abs(v - x) for x in out if x is not None), default=far)
    # an item might be taken by one outside that is this near
    a_risk, b_risk = [gap(v, b_out) for v in a_val], [gap(v, a_out) for v in b_val]
    line = _Line(np.asarray(b_val, np.int64), b_ids)
    n = len(b_ids)
    # each a's next places to look at, above (from its own value) and below
    nxt = [[int(np.searchsorted(line.keys[0], v)), int(np.searchsorted(line.keys[1], -v, side="right"))] for v in a_val]

    def candidate(i: int):
        """The nearest b not looked at yet, smallest id among equals, and from which side."""
        best = None
        for side in (0, 1):
            k = nxt[i][side] = line.at(side, nxt[i][side])
            if k < n:
                j = line.orders[side][k]
                c = (abs(int(b_val[j]) - int(a_val[i])), a_ids[i], b_ids[j], i, j, side)
                best = c if best is None or c < best else best
        return best

    heap = [c for c in map(candidate, range(len(a_ids))) if c]
    heapq.heapify(heap)
    a_free, b_free = set(range(len(a_ids))), set(range(n))
    open_a, open_b, taken, out = set(), set(), set(), []
    # once no pair of two decided-on items is left, nothing more can be sure
    while heap and len(open_a) < len(a_free) and len(open_b) < len(b_free):
        d, _, _, i, j, side = heapq.heappop(heap)
        if i not in a_free:
            continue
        if j in b_free:
            if i in open_a or j in open_b or d >= a_risk[i] or d >= b_risk[j]:
                open_a.add(i)
                open_b.add(j)
                nxt[i][side] += 1  # its later pairs are undecided too
            else:
                out.append((i, j, d))
                a_free.discard(i)
                b_free.discard(j)
                line.take(j)
                continue
        c = candidate(i)
        if c:
            heapq.heappush(heap, c)
    return out


def nearest_pairs(a: DataFrame, b: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b, diff from (id STRING, value LONG) on both sides; ids are unique per side, null values are left out."""
    side = lambda df, s: df.filter("value is not null").select("id", F.col("value").cast("long").alias("value"), F.lit(s).alias("side"))
    left = staged(side(a, "a").unionByName(side(b, "b")), "match-items")
    out, shift, size = None, 0, block
    while True:
        n = {r["side"]: r["count"] for r in left.groupBy("side").count().collect()}
        got = staged(_round(left, size, shift), "match-round")
        out = got if out is None else out.unionByName(got)
        found = got.count()
        if not min(n.get("a", 0) - found, n.get("b", 0) - found) > 0:
            return out
        left = staged(left.join(got, (F.col("id") == F.col("a")) & (F.col("side") == "a"), "left_anti").join(got, (F.col("id") == F.col("b")) & (F.col("side") == "b"), "left_anti"), "match-items")
        size = size if found else size * 4
        shift = (shift + size // 2) % size


def _round(items: DataFrame, size: int, shift: int) -> DataFrame:
    """a, b, diff: the pairs that blocks of ``size`` neighbours, the first shorter by ``shift``, can tell."""
    rows = numbered(items, ["value", "side", "id"], "at", 0).withColumn("block", F.floor((F.col("at") + shift) / size))
    ends = rows.groupBy("block").agg(*[f(F.when(F.col("side") == s, F.col("value"))).alias(f"{s}_{n}") for s in "ab" for n, f in (("min", F.min), ("max", F.max))])
    before, after = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    # one row for each block: the nearest items of each side outside of it
    near = ends.select("block", *[F.last(f"{s}_max", True).over(before).alias(f"{s}_below") for s in "ab"], *[F.first(f"{s}_min", True).over(after).alias(f"{s}_above") for s in "ab"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf[pdf["side"] == "a"], pdf[pdf["side"] == "b"]
        r = pdf.iloc[0]
        outside = [[None if pd.isna(r[f"{s}_{w}"]) else int(r[f"{s}_{w}"]) for w in ("below", "above")] for s in "ab"]
        ai, bi = p["id"].tolist(), q["id"].tolist()
        got = walk(p["value"].tolist(), ai, q["value"].tolist(), bi, *outside)
        return pd.DataFrame([(ai[i], bi[j], d) for i, j, d in got], columns=["a", "b", "diff"])

    return rows.join(F.broadcast(near), "block").groupBy("block").applyInPandas(run, "a string, b string, diff long")
