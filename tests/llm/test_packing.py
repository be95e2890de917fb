import math
from collections import defaultdict

from lectern.llm import packing as P
from lectern.llm import queries as Q
from lectern.llm import tokens as T


def valid(rows, sizes, cap):
    bins, parts = defaultdict(int), defaultdict(list)
    for k, no, s, c in rows:
        bins[c] += s
        parts[k].append((no, s))
    assert all(0 < v <= cap for v in bins.values())
    assert {k: sum(s for _, s in p) for k, p in parts.items()} == sizes
    for k, p in parts.items():
        assert sorted(no for no, _ in p) == list(range(len(p))) and (len(p) == 1 or sizes[k] > cap)
    return len(bins)


def test_small(spark):
    data = [("a", 5), ("b", 5), ("c", 10), ("d", 25), ("e", 0), ("f", None), ("g", -3), ("h", 10), (None, 4), ("i", 6)]
    df = spark.createDataFrame([(k, s, "x") for k, s in data], "k string, s long, container string")
    rows = [tuple(r) for r in P.pack(df, "k", "s", 10).collect()]
    assert valid(rows, {k: s for k, s in data if s and s > 0}, 10) == 7
    assert P.pack(df.limit(0), "k", "s", 10).count() == 0


def test_ties_and_many_groups(spark):
    df = spark.range(3000).selectExpr("id as k", "case when id % 3 = 0 then 350 else 1 + id * 7919 % 300 end as s")
    sizes = {r["k"]: r["s"] for r in df.collect()}
    rows = [tuple(r) for r in P.pack(df, "k", "s", 1000, group_items=500, generations=3).collect()]
    assert valid(rows, sizes, 1000) <= 1.01 * math.ceil(sum(sizes.values()) / 1000) + 2


def test_crossover_keeps_items():
    import random

    rng, sizes = random.Random(5), [random.Random(i).randint(1, 60) for i in range(80)]
    a, b = (P.best_fit(P.Packing([], []), rng.sample(range(80), 80), sizes, 100) for _ in range(2))
    for _ in range(30):
        c = P.child(a, b, sizes, 100, rng)
        assert sorted(x for q in c.bins for x in q) == list(range(80))
        assert c.fill == [sum(sizes[i] for i in q) for q in c.bins] and max(c.fill) <= 100


def triplets(n, cap, seed):
    """Sizes of which three at a time fill a container exactly: largest first needs more containers than ``n``."""
    import random

    rng, out = random.Random(seed), []
    for _ in range(n):
        a = rng.randint(cap * 38 // 100, cap * 49 // 100)
        b = rng.randint(cap * 25 // 100, (cap - a) // 2)
        out += [a, b, cap - a - b]
    rng.shuffle(out)
    return out


def test_generations_beat_largest_first():
    """Where largest first isn't the best, crossover and mutation lower the number of containers."""
    for seed in range(3):
        sizes = triplets(100, 1000, seed)
        first = P.largest_first(sizes, 1000)
        best = P.evolve(sizes, 1000, seed, [], 6, 120, 40)[0]
        assert sorted(x for q in best.bins for x in q) == list(range(300)) and max(best.fill) <= 1000
        assert 100 <= len(best.bins) < len(first.bins), (len(best.bins), len(first.bins))


def test_islands_beat_largest_first(spark):
    sizes = triplets(100, 1000, 9)
    df = spark.createDataFrame(list(enumerate(sizes)), "k long, s long")
    rows = [tuple(r) for r in P.pack(df, "k", "s", 1000, population=6, generations=60, patience=20).collect()]
    assert valid(rows, dict(enumerate(sizes)), 1000) < len(P.largest_first(sizes, 1000).bins)


def test_query(spark, sf):
    sizes = {r[0]: r[1] for r in T.token_sizes(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text").filter("n_tokens > 0").collect()}
    rows = [tuple(r) for r in Q.p7_containers(spark, sf).collect()]
    assert valid(rows, sizes, 2048) <= 1.01 * math.ceil(sum(sizes.values()) / 2048) + 1
