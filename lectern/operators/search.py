"""Search over index points: sparse, dense, fused, and exact top-k for a set of queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import terms_of


def sparse_scores(weights: DataFrame, key: str, query_tf: DataFrame, idfs: DataFrame) -> DataFrame:
    """key, score: inner product of the stored weights with the query's idf (1 + ln tf). Unknown terms add nothing."""
    q = query_tf.join(idfs.select("term", "idf"), "term").select("term", (F.col("idf") * (1 + F.log("tf"))).alias("q"))
    return weights.join(q, "term").groupBy(key).agg(F.round(F.sum(F.col("q") * F.col("weight")), 4).alias("score"))


def with_cosine(points: DataFrame, dense: str, query: list[float]) -> DataFrame:
    """``points`` without ``dense``, and score: cosine with the query vector, to five places; null for a vector that isn't usable.

    One matrix-vector product for each batch, before any shuffle: vectors never leave their scan.
    """
    q = np.asarray(query, np.float64)
    q = q / np.linalg.norm(q)
    rest = [c for c in points.columns if c != dense]
    src = points.select(*rest, F.col(dense).cast("array<double>").alias("_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(len(rest))
            at = v.offsets.to_numpy()
            flat = v.values.to_numpy(zero_copy_only=False)
            score = np.full(len(b), np.nan)
            ok = np.flatnonzero((np.diff(at) == len(q)) & v.is_valid().to_numpy(zero_copy_only=False))
            if len(ok):
                x = flat[at[ok][:, None] + np.arange(len(q))]
                with np.errstate(invalid="ignore", divide="ignore"):
                    score[ok] = (x @ q) / np.linalg.norm(x, axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array(score, pa.float64(), from_pandas=True)], names=[*rest, "score"])

    schema = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in rest)
    return src.mapInArrow(run, f"{schema}, score double").withColumn("score", F.round("score", 5))


def dense_scores(points: DataFrame, key: str, dense: str, query: list[float]) -> DataFrame:
    """key, score: cosine with the query vector, to five places; points without a usable vector are left out."""
    return with_cosine(points.select(key, dense), dense, query).filter("score is not null")


def top(scores: DataFrame, key: str, k: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), key).limit(k)


def ranked(scores: DataFrame, key: str, k: int) -> DataFrame:
    """The top ``k`` and rank (from 1)."""
    return top(scores, key, k).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))


def fuse(lists: list[DataFrame], key: str, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists: key, score; ``constant`` as in the published method."""
    both = lists[0].select(key, "rank")
    for x in lists[1:]:
        both = both.unionByName(x.select(key, "rank"))
    s = both.groupBy(key).agg(F.round(F.sum(1.0 / (F.lit(constant) + F.col("rank"))), 6).alias("score"))
    return top(s, key, k)


def ranked_of_queries(scores: DataFrame, query: str, key: str, k: int) -> DataFrame:
    """The top ``k`` of every query and rank (from 1)."""
    w = Window.partitionBy(query).orderBy(F.desc("score"), key)
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def fuse_of_queries(lists: list[DataFrame], query: str, key: str, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of the ranked lists of every query: query, key, score, rank."""
    both = lists[0].select(query, key, "rank")
    for x in lists[1:]:
        both = both.unionByName(x.select(query, key, "rank"))
    s = both.groupBy(query, key).agg(F.round(F.sum(1.0 / (F.lit(constant) + F.col("rank"))), 6).alias("score"))
    return ranked_of_queries(s, query, key, k)


def _dealt(entries: DataFrame, asked: DataFrame, block_rows: int, n: int, m: int):
    """Entries and queries in pairs of blocks (eb, qb): each side once in every block pair that it belongs to, both with the same partitioning."""
    nb, qb = max(1, -(-n // block_rows)), max(1, -(-m // block_rows))
    tasks = min(2000, nb * qb)
    h = lambda b, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(b)).cast("int")
    every = lambda b: F.explode(F.sequence(F.lit(0), F.lit(b - 1)))
    e = entries.select(h(nb, 1).alias("eb"), every(qb).alias("qb"), "*").repartition(tasks, "eb", "qb")
    q = asked.select(every(nb).alias("eb"), h(qb, 2).alias("qb"), "*").repartition(tasks, "eb", "qb")
    return e, q


_FOUND = pa.schema([("key", pa.string()), ("near", pa.string()), ("score", pa.float64())])


def _counted(lists: pa.ChunkedArray, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in ``known`` and number of every term of every row's list that is in ``known``."""
    lists = lists.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    d = lists.flatten().dictionary_encode()
    place = pc.fill_null(pc.index_in(d.dictionary, value_set=known), -1).to_numpy(zero_copy_only=False)
    term = place[d.indices.to_numpy(zero_copy_only=False)] if len(d) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)[term >= 0]
    pair, n = np.unique(row * max(1, len(known)) + term[term >= 0], return_counts=True)
    return pair // max(1, len(known)), pair % max(1, len(known)), n


def sparse_top_k(docs: DataFrame, key: str, text: str, queries: DataFrame, query: str, idfs: DataFrame, k: int, block_rows: int = 16384) -> DataFrame:
    """query, key, score, rank: for every query the ``k`` points of greatest sparse score, exactly.

    ``docs`` are key and text, ``queries`` query and ``text`` under the same name; both are read more than once.
    Texts are dealt into blocks of bounded size, whole, and cut into terms only
    there, so neither terms nor weights of all texts are shuffled; the idf comes
    with the terms of a block's queries alone. In every pair of blocks the
    postings of a query's terms are summed, so a term that all texts hold makes
    no row for each pair of texts. Null texts hold no terms.
    """
    e = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    q = queries.select(F.col(query).cast("string").alias("key"), F.col(text).alias("text"))
    e, q = _dealt(e, q, block_rows, e.count(), q.count())
    asked = q.select("eb", "qb", F.explode(terms_of(F.col("text"))).alias("term")).distinct().join(idfs.select("term", "idf"), "term")
    none = F.lit(None)
    rows = q.select("eb", "qb", "key", terms_of(F.col("text")).alias("terms"), none.cast("string").alias("term"), none.cast("double").alias("idf")).unionByName(
        asked.select("eb", "qb", none.cast("string").alias("key"), none.cast("array<string>").alias("terms"), "term", "idf")
    )

    def best(mine: pa.Table, other: pa.Table) -> pa.Table:
        known = other.filter(pc.is_valid(other["term"]))
        other = other.filter(pc.is_valid(other["key"]))
        mine = mine.sort_by("key")
        idf, terms = known["idf"].to_numpy(), known["term"].combine_chunks()
        doc, term, n = _counted(mine["terms"], terms)
        weight = np.floor(idf[term] * (1 + np.log(n)) * 1e4 + 0.5) / 1e4
        order = np.argsort(term, kind="stable")
        doc, weight = doc[order], weight[order]
        at = np.searchsorted(term[order], np.arange(len(terms) + 1))
        who, qt, qn = _counted(other["terms"], terms)
        qw = idf[qt] * (1 + np.log(qn))
        ends = np.searchsorted(who, np.arange(len(other) + 1))
        qs, ds, scores = [], [], []
        for i in range(len(other)):
            spans = [(at[t], at[t + 1], w) for t, w in zip(qt[ends[i] : ends[i + 1]].tolist(), qw[ends[i] : ends[i + 1]].tolist())]
            if not sum(b - a for a, b, _ in spans):
                continue
            hit = np.concatenate([doc[a:b] for a, b, _ in spans])
            score = np.bincount(hit, np.concatenate([weight[a:b] * w for a, b, w in spans]), len(mine)).round(4)
            met = np.flatnonzero(np.bincount(hit, minlength=len(mine)))
            if len(met) > k:
                met = met[score[met] >= np.partition(score[met], len(met) - k)[len(met) - k]]
            met = met[np.argsort(-score[met], kind="stable")][:k]
            qs.append(np.full(len(met), i))
            ds.append(met)
            scores.append(score[met])
        if not qs:
            return _FOUND.empty_table()
        return pa.Table.from_arrays([other["key"].take(np.concatenate(qs)), mine["key"].take(np.concatenate(ds)), pa.array(np.concatenate(scores))], schema=_FOUND)

    texts = e.select("eb", "qb", "key", terms_of(F.col("text")).alias("terms"))
    found = texts.groupBy("eb", "qb").cogroup(rows.groupBy("eb", "qb")).applyInArrow(best, "key string, near string, score double")
    return ranked_of_queries(found.select(F.col("key").alias(query), F.col("near").alias(key), "score"), query, key, k)


def _unit_rows(v: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    """The vectors of some rows, of length 1, in double precision; nan where one isn't usable."""
    flat, at = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
    x = flat[at[rows][:, None] + np.arange(dim)].astype(np.float64)
    norm = np.linalg.norm(x, axis=1)
    norm[~(np.isfinite(norm) & (norm > 0))] = np.nan
    return x / norm[:, None]


def exact_top_k(
    entries: DataFrame, is_query: Column, key: str, dense: str, k: int, block_rows: int = 16384, queries: DataFrame | None = None, dim: int | None = None, version: str | None = None
) -> DataFrame:
    """key, near, rank, score: for every query row the ``k`` other rows of greatest cosine, exactly.

    ``queries``: rows (key, dense) to take as queries instead, of this or another collection; then a point may find itself.
    ``version`` (with ``queries``): of a key's entries the one with the greatest version counts, whether usable or not; a null is older
    than any other. All rows of a key lie in one block, so this needs no shuffle of its own.

    Queries and entries are dealt into blocks of bounded size; every pair of
    blocks is a few matrix products, and the blocks' best are merged per query.
    Rows with a null, empty, zero or other-length vector are left out; the
    length is ``dim``, or the most frequent one of all entries (the shorter of two).
    """
    if version is not None and queries is None:
        raise ValueError("versions need queries of their own")
    src = entries.select(F.col(key).cast("string").alias("key"), F.col(dense).alias("v"), is_query.alias("q"), (F.col(version) if version else F.lit(0)).alias("ver"))
    if dim is None:
        most = src.filter(F.size("v") > 0).groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
        dim = most["size"] if most else 0
    if version is None:
        src = src.filter(F.size("v") == dim)
    own = queries is not None
    asked = queries.filter(F.size(dense) == dim).select(F.col(key).cast("string").alias("key"), F.col(dense).alias("v")) if own else src.filter("q").select("key", "v")
    e, q = _dealt(src.select("key", "ver", "v"), asked, block_rows, src.count(), asked.count())

    def best(mine: pa.Table, other: pa.Table) -> pa.Table:
        order = pc.sort_indices(mine.select(["key", "ver"]), [("key", "ascending"), ("ver", "ascending")], null_placement="at_start")
        names = mine["key"].take(order).combine_chunks()
        rows = order.to_numpy()
        if version is not None and len(rows):
            # the last of each key
            ids = names.dictionary_encode().indices.to_numpy()
            rows = rows[np.append(ids[1:] != ids[:-1], True)]
        v, w = mine["v"].combine_chunks(), other["v"].combine_chunks()
        size = pc.fill_null(pc.list_value_length(v), -1).to_numpy(zero_copy_only=False)
        rows = rows[size[rows] == dim]
        names, asks = mine["key"].take(rows).combine_chunks(), other["key"].combine_chunks()
        same = pc.fill_null(pc.index_in(asks, value_set=names), -1).to_numpy(zero_copy_only=False)
        twins = len(names) != len(pc.unique(names))
        got: list[tuple] = []
        for a in range(0, len(rows), 4096):
            x = _unit_rows(v, rows[a : a + 4096], dim)
            for b in range(0, len(other), 512):
                s = np.round(_unit_rows(w, np.arange(b, min(b + 512, len(other))), dim) @ x.T, 5)
                if not own:
                    me = same[b : b + 512]
                    if twins:
                        part = pc.index_in(names.slice(a, len(x)), value_set=names).to_numpy(zero_copy_only=False)
                        s[me[:, None] == part[None, :]] = np.nan
                    else:
                        i = np.flatnonzero((me >= a) & (me < a + len(x)))
                        s[i, me[i] - a] = np.nan
                s = np.where(np.isnan(s), -np.inf, s)
                if s.shape[1] > k:
                    s[s < np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k][:, None]] = -np.inf
                i, j = np.nonzero(s > -np.inf)
                got.append((i + b, j + a, s[i, j]))
        if not got:
            return _FOUND.empty_table()
        i, j, s = (np.concatenate(c) for c in zip(*got))
        order = np.lexsort((j, -s, i))
        i, j, s = i[order], j[order], s[order]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        return pa.Table.from_arrays([asks.take(pa.array(i[keep])), names.take(pa.array(j[keep])), pa.array(s[keep])], schema=_FOUND)

    found = e.groupBy("eb", "qb").cogroup(q.groupBy("eb", "qb")).applyInArrow(best, "key string, near string, score double")
    w = Window.partitionBy("key").orderBy(F.desc("score"), "near")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
