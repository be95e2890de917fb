import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import matching
from lectern.operators.ordered import chain, numbered_in, with_last


def jumps():
    def jump(pdf):
        """Start at i, go to i + 1 + (weight at i)."""
        n = len(pdf)
        to = np.arange(n) + 1 + pdf["w"].to_numpy()
        return np.where(to < n, to, -1)

    return jump  # by value: workers needn't import the tests


@pytest.mark.parametrize("block,ahead", [(4, 4), (16, 1), (4, 1), (4096, 1024)])
def test_chain(spark, block, ahead):
    """Also where steps reach further ahead than a block's view."""
    rng = random.Random(2)
    data = {g: [rng.randint(0, 2) + 40 * (g == "d" and i % 13 == 0) for i in range(n)] for g, n in (("a", 100), ("b", 1), ("c", 33), ("d", 300), (None, 9))}
    df = spark.createDataFrame([(g, i - 1, w) for g, ws in data.items() for i, w in enumerate(ws)], "g string, no long, w int")
    got = {}
    for r in chain(df, "g", "no", ["w"], jumps(), block=block, ahead=ahead).collect():
        got.setdefault(r["g"], []).append((r["start"], r["stop"]))
    for g, ws in data.items():
        want, at = [], 0
        while at is not None:
            to = at + 1 + ws[at]
            to = to if to < len(ws) else None
            want.append((at - 1, None if to is None else to - 1))
            at = to
        assert sorted(got[g], key=lambda x: x[0]) == want


def test_numbers_in_groups(spark):
    rows = [(g, k * 1500, "x") for g, n in (("a", 50), (None, 3), ("b", 1)) for k in range(n)]
    random.Random(1).shuffle(rows)
    got = sorted((r["g"] or "", r["k"], r["row"]) for r in numbered_in(spark.createDataFrame(rows, "g string, k long, t string").repartition(7), "g", ["k"], "row").collect())
    assert got == sorted((g or "", k, k // 1500 + 1) for g, k, _ in rows)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_with_last(spark, width):
    rows = [("a", i, None if i % 5 else i) for i in range(1, 50)] + [("b", 3, None)]
    df = spark.createDataFrame(rows, "g string, t long, v long")
    got = {(r["g"], r["t"]): r["x"] for r in with_last(df, ["g"], ["t"], F.floor(F.col("t") / width), "v", "x").collect()}
    assert got == {(g, t): (t // 5 * 5 or None) if g == "a" else None for g, t, _ in rows}


def greedy(a, b):
    used, out = set(), set()
    for d, x, y in sorted((abs(v - w), x, y) for x, v in a for y, w in b):
        if ("a", x) not in used and ("b", y) not in used:
            used |= {("a", x), ("b", y)}
            out.add((x, y, d))
    return out


@pytest.mark.parametrize("seed,block", [(1, 8192), (2, 8192), (3, 6), (4, 5)])
def test_matching_is_the_greedy_one(spark, seed, block):
    """In one block, and in several with borders amid ties."""
    rng = random.Random(seed)
    a = [(f"a{i:02d}", rng.randint(0, 60) * 100) for i in range(30)]
    b = [(f"b{i:02d}", rng.randint(0, 60) * 100) for i in range(20)]
    mk = lambda x: spark.createDataFrame(x + [(x[0][0] + "n", None)], "id string, value long")
    assert {tuple(r) for r in matching.nearest_pairs(mk(a), mk(b), block).collect()} == greedy(a, b)


def test_matching_without_blocks_of_spark():
    """The walk of one block against the plain one, and what it leaves to others near its borders."""
    rng = random.Random(8)
    for _ in range(200):
        a = [(f"a{i}", rng.randint(0, 40)) for i in range(rng.randint(0, 12))]
        b = [(f"b{i}", rng.randint(0, 40)) for i in range(rng.randint(0, 12))]
        go = lambda x, y, *out: {(x[i][0], y[j][0], d) for i, j, d in matching.walk([v for _, v in x], [k for k, _ in x], [v for _, v in y], [k for k, _ in y], *out)}
        assert go(a, b, (None, None), (None, None)) == greedy(a, b)
        # items above 20 are elsewhere: what the block is sure of is true of the whole
        low = lambda x: [r for r in x if r[1] <= 20]
        above = lambda x: (None, min((v for _, v in x if v > 20), default=None))
        assert go(low(a), low(b), above(a), above(b)) <= greedy(a, b)


def test_matching_of_shrinking_gaps(spark):
    """Each pair is decided only after the one before: no round for each."""
    at, rows = 0, []
    for i in range(60):
        rows.append(at)
        at += 1000 - 9 * i
    a = [(f"a{i:02d}", v) for i, v in enumerate(rows[::2])]
    b = [(f"b{i:02d}", v) for i, v in enumerate(rows[1::2])]
    mk = lambda x: spark.createDataFrame(x, "id string, value long")
    assert {tuple(r) for r in matching.nearest_pairs(mk(a), mk(b), 16).collect()} == greedy(a, b)


def test_matching_of_nothing(spark):
    none = spark.createDataFrame([], "id string, value long")
    some = spark.createDataFrame([("x", 1)], "id string, value long")
    assert matching.nearest_pairs(none, some).count() == matching.nearest_pairs(none, none).count() == 0
