"""Three levels of chunks: outline nodes, overlapping sub-chunks, parent chunks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import ends_sentence
from lectern.operators.ordered import chain, numbered_in, with_last

BUCKET_MS = 3_600_000


def sub_chunks(sentences: DataFrame, group: str, soft: int = 200, hard: int = 400, marks: str = "。！？?.!") -> DataFrame:
    """group, start_sent, end_sent, begin_sec, end_sec, n_chars, text.

    Sentences are collected until ``hard`` characters, or ``soft`` if the last
    one ends with a mark; the next chunk repeats the last sentence. What is
    left at the end is a chunk if it is more than one sentence. Null and empty
    texts are left out. Needs sent_no unique per group.
    """
    s = sentences.filter(F.length("text") > 0).select(group, F.col("sent_no").cast("long").alias("sent_no"), "begin_sec", "end_sec", "text")
    s = numbered_in(s, group, ["sent_no"], "row").withColumn("len", F.length("text")).withColumn("term", ends_sentence(F.col("text"), marks))
    head = s.select(group).distinct().select(group, F.lit(0).cast("long").alias("row"), F.lit(0).alias("len"), F.lit(False).alias("term"))

    def step(pdf: pd.DataFrame) -> np.ndarray:
        n = len(pdf)
        size, end = pdf["len"].to_numpy().astype(np.int64), np.flatnonzero(pdf["term"].to_numpy())
        total = np.cumsum(size)
        base = total - size
        after = np.arange(1, n + 1)
        full = np.maximum(np.searchsorted(total, base + hard), after)
        k = np.maximum(np.searchsorted(total[end], base + soft), np.searchsorted(end, after))
        soon = np.where(k < len(end), end[np.minimum(k, len(end) - 1)] if len(end) else n, n)
        to = np.minimum(full, soon)
        return np.where(to < n, to, -1)

    steps = chain(s.select(group, "row", "len", "term").unionByName(head), group, "row", ["len", "term"], step)
    last = s.groupBy(group).agg(F.max("row").alias("last"))
    # the walk begins before the first sentence; a chunk begins with the sentence its step starts at
    spans = steps.join(last, group).select(group, F.greatest("start", F.lit(1)).alias("a"), F.coalesce("stop", "last").alias("z"), F.col("stop").isNull().alias("rest"))
    inside = spans.withColumn("row", F.explode(F.sequence("a", "z"))).join(s, [group, "row"])
    out = inside.groupBy(group, "a", "z", "rest").agg(
        F.min("sent_no").alias("start_sent"),
        F.max("sent_no").alias("end_sent"),
        F.min_by("begin_sec", F.when(F.col("begin_sec").isNotNull(), F.col("sent_no"))).alias("begin_sec"),
        F.max_by("end_sec", F.when(F.col("end_sec").isNotNull(), F.col("sent_no"))).alias("end_sec"),
        F.sum("len").cast("long").alias("n_chars"),
        F.count("*").alias("n_sents"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_no", "text"))), lambda x: x["text"]), "").alias("text"),
    )
    return out.filter(~F.col("rest") | (F.col("n_sents") > 1)).drop("a", "z", "rest")


def node_bounds(breaks: DataFrame, sentences: DataFrame, group: str, least: int = 5) -> DataFrame:
    """group, start_sent, end_sent (half-open), begin_sec, end_sec: ranges between 0, the breaks and the number of sentences.

    Breaks outside are ignored; ranges of fewer than ``least`` numbers are dropped.
    """
    n = sentences.groupBy(group).agg((F.max("sent_no") + 1).cast("long").alias("n"))
    inner = breaks.join(n, group).filter("at >= 0 and at < n").select(group, F.col("at").cast("long").alias("at"))
    edge = n.select(group, F.lit(0).cast("long").alias("at")).unionByName(n.select(group, F.col("n").alias("at")))
    w = Window.partitionBy(group).orderBy("at")
    r = inner.unionByName(edge).distinct().select(group, F.col("at").alias("start_sent"), F.lead("at").over(w).alias("end_sent")).filter(F.col("end_sent") - F.col("start_sent") >= least)
    # first and last sentence of each range, found by carrying the range's start forward over the sentences
    cols = [group, F.col("sent_no").cast("long").alias("sent_no")]
    both = sentences.select(*cols, "begin_sec", "end_sec", F.lit(1).alias("side"), F.lit(None).cast("long").alias("start")).unionByName(
        r.select(group, F.col("start_sent").alias("sent_no"), F.lit(None).cast("double").alias("begin_sec"), F.lit(None).cast("double").alias("end_sec"), F.lit(0).alias("side"), F.col("start_sent").alias("start"))
    )
    carried = with_last(both, [group], ["sent_no", "side"], F.floor(F.col("sent_no") / 4096), "start", "start_sent").filter("side = 1 and start_sent is not null")
    inside = r.join(carried.select(group, "start_sent", "sent_no", "begin_sec", "end_sec"), [group, "start_sent"], "left")
    own = F.col("sent_no") < F.col("end_sent")
    return inside.groupBy(group, "start_sent", "end_sent").agg(
        F.min_by("begin_sec", F.when(own & F.col("begin_sec").isNotNull(), F.col("sent_no"))).alias("begin_sec"),
        F.max_by("end_sec", F.when(own & F.col("end_sec").isNotNull(), F.col("sent_no"))).alias("end_sec"),
    )


def assign_nodes(chunks: DataFrame, nodes: DataFrame, group: str) -> DataFrame:
    """``chunks`` and node_title: that of the latest node that begins at or before the chunk.

    Of nodes that begin together the later one (by start_sent, then title)
    counts; chunks before the first node get the first node; groups without
    nodes get the empty title; nodes without a beginning are ignored.
    """
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    n = nodes.filter(F.col("begin_sec").isNotNull()).select(group, ms("begin_sec").alias("t"), "start_sent", F.coalesce("node_title", F.lit("")).alias("title"))
    tip = n.groupBy(group, "t").agg(F.max(F.struct("start_sent", "title")).alias("x"))
    first = tip.groupBy(group).agg(F.min_by("x.title", "t").alias("_first"))
    cols = chunks.columns
    a = chunks.select(*cols, F.coalesce(ms("begin_sec"), F.lit(-1).cast("long")).alias("t"), F.lit(1).alias("side"), F.lit(None).cast("string").alias("_title"), F.col("start_sent").cast("long").alias("_tie"))
    b = tip.select(*[F.col(group) if c == group else F.lit(None).cast(chunks.schema[c].dataType).alias(c) for c in cols], "t", F.lit(0).alias("side"), F.col("x.title").alias("_title"), F.lit(0).cast("long").alias("_tie"))
    both = with_last(a.unionByName(b), [group], ["t", "side", "_tie"], F.floor(F.col("t") / BUCKET_MS), "_title", "_node")
    return both.filter("side = 1").join(first, group, "left").select(*cols, F.coalesce("_node", "_first", F.lit("")).alias("node_title"))


def parent_chunks(chunks: DataFrame, group: str, least: int = 1500, most: int = 3000) -> DataFrame:
    """group, start_sent, n_subs, n_chars, begin_sec, end_sec, node_title, text, of consecutive sub-chunks.

    A parent closes at ``least`` characters if the next sub-chunk has another
    title, at ``most`` in any case; the rest at the end is a parent too.
    """

    def step(pdf: pd.DataFrame) -> np.ndarray:
        n = len(pdf)
        total = np.cumsum(pdf["n_chars"].to_numpy().astype(np.int64))
        base = np.concatenate([[0], total[:-1]])
        title = pdf["node_title"].to_numpy()
        turn = np.flatnonzero(title[1:] != title[:-1])  # the title differs after these
        full = np.searchsorted(total, base + most)
        k = np.searchsorted(turn, np.maximum(np.searchsorted(total, base + least), np.arange(n)))
        soon = np.where(k < len(turn), turn[np.minimum(k, len(turn) - 1)] if len(turn) else n, n)
        to = np.minimum(np.maximum(full, np.arange(n)), soon) + 1
        return np.where(to < n, to, -1)

    chunks = numbered_in(chunks, group, ["start_sent"], "row")
    steps = chain(chunks, group, "row", ["n_chars", "node_title"], step)
    marked = chunks.join(steps.select(group, F.col("start").alias("row"), F.col("start").alias("_p")), [group, "row"], "left")
    full = with_last(marked, [group], ["row"], F.floor(F.col("row") / 4096), "_p", "parent")
    return full.groupBy(group, "parent").agg(
        F.min("start_sent").alias("first"),
        F.count("*").alias("n_subs"),
        F.sum("n_chars").cast("long").alias("n_chars"),
        F.min_by("begin_sec", full["start_sent"]).alias("begin_sec"),
        F.max_by("end_sec", full["start_sent"]).alias("end_sec"),
        F.min_by("node_title", full["start_sent"]).alias("node_title"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(full["start_sent"].alias("k"), "text"))), lambda x: x["text"]), "").alias("text"),
    ).drop("parent").withColumnRenamed("first", "start_sent")
