"""Filling fixed-capacity containers, by a grouping genetic algorithm on islands.

Items larger than a container are cut into full containers and a rest; all
other items stay whole. Items are dealt into groups of bounded size by hash.
A group is worked on by several islands, each with its own population of
packings. Crossover injects well-filled containers of one parent into the
other, removes the containers that hold the same items, and places the
displaced items by best fit, largest first; mutation does the same with the
emptiest containers. A packing is better if it has fewer containers, then if the
sum of squared fills is greater: room gathered in few containers can be filled
later. An island stops after ``patience`` generations without a better packing;
a packing that has the fewest possible containers isn't a reason to stop, as its
room may still be scattered. After each epoch every island's elites migrate to
the next island of the group through a shuffle, and the best packing of a group
is kept. Containers below ``done_fill`` are opened again, and their items of all
groups are dealt into new groups, until one group is left or nothing is gained.

No task holds more than a group's sizes; the driver sees counts only. Seeds
come from the group, so a lost task does the same again.

Defined cases: null, zero and negative sizes are left out; repeated keys are
separate items; a null key is an item too; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import staged


class Packing:
    """Containers as tuples of item numbers, with their fill. Packings share containers, so these are never changed."""

    __slots__ = ("bins", "fill")

    def __init__(self, bins: list[tuple[int, ...]], fill: list[int]):
        self.bins, self.fill = bins, fill

    def rank(self) -> tuple[int, int]:
        """Smaller is better: number of containers, then squared fills."""
        return len(self.bins), -sum(f * f for f in self.fill)


def best_fit(p: Packing, items, sizes, cap: int) -> Packing:
    """``p`` with items placed, in the given order, each where it leaves the least room."""
    bins, fill = list(p.bins), list(p.fill)
    room = sorted((cap - f, i) for i, f in enumerate(fill) if f < cap)
    for it in items:
        s = sizes[it]
        at = bisect.bisect_left(room, (s, -1))
        if at < len(room):
            r, b = room.pop(at)
            bins[b] += (it,)
            fill[b] += s
        else:
            r, b = cap, len(bins)
            bins.append((it,))
            fill.append(s)
        if r - s:
            bisect.insort(room, (r - s, b))
    return Packing(bins, fill)


def cross(a: Packing, b: Packing, sizes, cap: int, rng: random.Random) -> tuple[Packing, list[int]]:
    """``a`` with some of the best-filled containers of ``b`` put in whole, and the items that these displaced."""
    order = sorted(range(len(b.bins)), key=lambda i: -b.fill[i])
    pool = order[: max(1, len(order) // 2)]
    have = set(a.bins)
    take = [i for i in rng.sample(pool, max(1, min(len(pool), rng.randint(1, max(1, len(order) // 8))))) if b.bins[i] not in have]
    inside = {x for i in take for x in b.bins[i]}
    bins, fill, displaced = [], [], []
    for items, f in zip(a.bins, a.fill):
        if inside.isdisjoint(items):
            bins.append(items)
            fill.append(f)
        else:
            displaced += [x for x in items if x not in inside]
    for i in take:
        bins.append(b.bins[i])
        fill.append(b.fill[i])
    return Packing(bins, fill), displaced


def mutate(p: Packing, sizes, cap: int, rng: random.Random) -> tuple[Packing, list[int]]:
    """``p`` without its emptiest containers and a few others, and the items that were in these."""
    n = len(p.bins)
    few = max(1, n // 50)
    opened = set(sorted(range(n), key=lambda i: p.fill[i])[:few]) | {rng.randrange(n) for _ in range(few)}
    keep = [i for i in range(n) if i not in opened]
    return Packing([p.bins[i] for i in keep], [p.fill[i] for i in keep]), [x for i in opened for x in p.bins[i]]


def child(a: Packing, b: Packing, sizes, cap: int, rng: random.Random) -> Packing:
    """Crossover, mutation, and all displaced items by best fit, largest first."""
    p, out = cross(a, b, sizes, cap, rng)
    p, more = mutate(p, sizes, cap, rng)
    return best_fit(p, sorted(out + more, key=lambda x: (-sizes[x], x)), sizes, cap)


def from_labels(labels, sizes) -> Packing:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(labels):
        bins.setdefault(int(b), []).append(i)
    got = [tuple(b) for b in bins.values()]
    return Packing(got, [sum(sizes[i] for i in b) for b in got])


def labels_of(p: Packing, n: int) -> list[int]:
    out = [0] * n
    for b, items in enumerate(p.bins):
        for i in items:
            out[i] = b
    return out


def largest_first(sizes, cap: int) -> Packing:
    return best_fit(Packing([], []), sorted(range(len(sizes)), key=lambda x: (-sizes[x], x)), sizes, cap)


def evolve(sizes: list[int], cap: int, seed: int, start: list[Packing], population: int, generations: int, patience: int) -> list[Packing]:
    """The population, best first, after ``patience`` generations without a better packing; ``generations`` at most.

    ``start`` are packings to begin with; without any, largest first is one of the population.
    """
    rng = random.Random(seed)
    n = len(sizes)
    pop = list(start) or [largest_first(sizes, cap)]
    while len(pop) < population:
        # largest first, with noise that differs by individual
        noise = 0.05 + 0.3 * rng.random()
        order = sorted(range(n), key=lambda x: -sizes[x] * (1 + noise * (rng.random() - 0.5)))
        pop.append(best_fit(Packing([], []), order, sizes, cap))
    pop = sorted(((p.rank(), i, p) for i, p in enumerate(pop)))
    made, idle = len(pop), 0
    for _ in range(generations):
        if idle >= patience:
            break
        young = []
        for _ in range(max(1, len(pop) // 2)):
            a, b = sorted(rng.sample(range(len(pop)), 2)) if len(pop) > 1 else (0, 0)
            p = child(pop[a][2], pop[b][2], sizes, cap, rng)
            young.append((p.rank(), made, p))
            made += 1
        before = pop[0][0]
        # of equal rank one stays, so that the population doesn't become one packing
        pop = sorted({x[0]: x for x in reversed(sorted(pop + young))}.values())[:population]
        idle = 0 if pop[0][0] < before else idle + 1
    return [p for _, _, p in pop]


_ELITE = "grp long, island int, place int, n_bins int, squares long, labels array<int>"
_COLUMNS = ["grp", "island", "place", "n_bins", "squares", "labels"]


def _epoch(cap, population, generations, patience, epoch, elites):
    def run(key, items: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
        if not len(items):
            return pd.DataFrame(columns=_COLUMNS)
        grp, island = int(items["grp"].iloc[0]), int(items["island"].iloc[0])
        sizes = items.sort_values("no")["size"].astype(int).tolist()
        came = came.sort_values(["n_bins", "squares", "from"], ascending=[True, False, True])
        start = [from_labels(x, sizes) for x in came["labels"]]
        pop = evolve(sizes, cap, grp * 1009 + island * 31 + epoch, start, max(len(start), population), generations, patience)
        return pd.DataFrame([(grp, island, i, len(p.bins), -p.rank()[1], labels_of(p, len(sizes))) for i, p in enumerate(pop[:elites])], columns=_COLUMNS)

    return run


def pack(
    items: DataFrame,
    key: str,
    size: str,
    capacity: int,
    group_items: int = 2000,
    islands: int = 3,
    epochs: int = 2,
    population: int = 4,
    generations: int = 40,
    patience: int = 6,
    elites: int = 2,
    done_fill: float = 0.995,
    rounds: int = 4,
) -> DataFrame:
    """key, piece_no, size, container. ``piece_no`` is 0 but for the parts of an oversized item."""
    size_of = F.col("_size")
    src = items.select(F.col(key), F.col(size).cast("long").alias("_size")).filter(size_of > 0)
    last = ((size_of - 1) / capacity).cast("long")
    parts = src.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        key,
        F.col("piece_no").cast("int").alias("piece_no"),
        F.when(F.col("piece_no") < last, F.lit(capacity)).otherwise(size_of - last * capacity).cast("int").alias("size"),
    )
    # item ids that are the same whenever they are computed: written once
    parts = staged(parts.withColumn("_id", F.monotonically_increasing_id()), "pack-items")
    full = parts.filter(F.col("size") == capacity).withColumn("container", F.concat(F.lit("full-"), F.col("_id")))
    out = full.select(key, "piece_no", "size", "container")
    pool = parts.filter(F.col("size") < capacity)
    before, r = None, 0
    while True:
        n = pool.count()
        if not n:
            return out
        groups = -(-n // group_items)
        # the last round takes all that is left; so does a round that the one before didn't make much smaller
        final = groups == 1 or r == rounds - 1 or (before is not None and n > 0.9 * before)
        done = staged(_round(pool, capacity, r, groups, islands, epochs, population, generations, patience, elites), "pack-round")
        strong = F.lit(True) if final else F.col("_fill") >= F.lit(done_fill * capacity)
        name = F.concat(F.lit(f"{r}-"), F.col("grp"), F.lit("-"), F.col("bin"))
        out = out.unionByName(done.filter(strong).select(key, "piece_no", "size", name.alias("container")))
        if final:
            return out
        pool, before, r = done.filter(~strong).select(*parts.columns), n, r + 1


def _round(pool, capacity, r, groups, islands, epochs, population, generations, patience, elites) -> DataFrame:
    """``pool`` with grp, bin and the bin's fill: every group's best packing after the epochs."""
    w = Window.partitionBy("grp").orderBy("_id")  # a group's items are numbered by id
    numbered = pool.withColumn("grp", F.pmod(F.xxhash64("_id", F.lit(r)), F.lit(groups))).withColumn("no", F.row_number().over(w) - 1)
    work = numbered.select("grp", "no", "size", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    # a group is long work on few bytes: as many tasks as there are islands, within bounds
    tasks = int(max(1, min(2000, groups * islands)))
    work = work.repartition(tasks, "grp", "island")
    came = pool.sparkSession.createDataFrame([], "grp long, island int, `from` int, n_bins int, squares long, labels array<int>")
    best = None
    for e in range(epochs):
        if best is not None:
            # each island keeps its elites and gets those of the island before it
            cols = ["grp", F.col("island").alias("from"), "n_bins", "squares", "labels"]
            both = F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands)))
            came = best.select(*cols, F.explode(F.array_distinct(both)).alias("island")).select("grp", "island", "from", "n_bins", "squares", "labels")
        best = (
            work.groupBy("grp", "island")
            .cogroup(came.repartition(tasks, "grp", "island").groupBy("grp", "island"))
            .applyInPandas(_epoch(capacity, population, generations, patience, r * epochs + e, elites), _ELITE)
        )
        if e < epochs - 1:
            best = staged(best, "pack-elites")
    order = F.struct("n_bins", (-F.col("squares")).alias("f"), "island", "place", "labels")
    top = best.groupBy("grp").agg(F.min(order).alias("b"))
    placed = top.select("grp", F.posexplode("b.labels").alias("no", "bin"))
    return numbered.join(placed, ["grp", "no"]).withColumn("_fill", F.sum("size").over(Window.partitionBy("grp", "bin")))
