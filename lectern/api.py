"""The callable surface: search, outline and segment of a lesson, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import times
from lectern.operators import index, search
from lectern.operators.versions import current_rows
from lectern.plans.transcripts import sentence_rows
from lectern.sources.tables import table


def build_index(spark: SparkSession, root: str, home: str) -> None:
    """Save the sparse index of the current sub-chunks below ``home``; searches with ``index_home`` read it."""
    docs = current_rows(table(spark, root, "course_subs").select("id", "ingested_at", "text")).filter("text is not null")
    index.save(docs, "id", "text", home)


def search_course_notes(spark: SparkSession, root: str, query: str, vector: list[float] | None = None, top_k: int = 6, index_home: str | None = None) -> dict[str, DataFrame]:
    """``hits``: the ``top_k`` sub-chunks by fused rank; ``chapters``: the four nearest outline nodes.

    Without a query vector only the sparse list ranks, and no chapters are
    given. Without a saved index the weights of the query's terms are computed.
    """
    q = index.term_frequencies(spark.createDataFrame([("q", query)], "id string, text string"), "id", "text").select("term", "tf")
    subs = current_rows(table(spark, root, "course_subs").drop("dense"))
    if index_home is not None:
        idfs, weights = index.load(spark, index_home)
    else:
        docs = subs.filter("text is not null").select("id", "text")
        tf = index.frequencies_of(docs, "id", "text", q)
        idfs = index.idf(tf, docs.count())
        weights = index.weights(tf, idfs)
    lists = [search.ranked(search.sparse_scores(weights, "id", q, idfs), "id", 25)]
    out = {}
    if vector is not None:
        near = lambda coll: current_rows(search.with_cosine(table(spark, root, coll).select("id", "ingested_at", "dense"), "dense", vector)).filter("score is not null").select("id", "score")
        lists.append(search.ranked(near("course_subs"), "id", 25))
        nodes = current_rows(table(spark, root, "course_outline").drop("dense"))
        chapters = search.top(near("course_outline"), "id", 4)
        out["chapters"] = chapters.join(nodes, "id").select("score", "lesson", "node_title", times.hours_minutes(F.col("begin_sec")).alias("from"), times.hours_minutes(F.col("end_sec")).alias("to"), "terms")
    best = search.fuse(lists, "id", top_k)
    cols = ["score", "lesson", "node_title", times.hours_minutes(F.col("begin_sec")).alias("from"), times.hours_minutes(F.col("end_sec")).alias("to"), "text"]
    out["hits"] = best.join(subs, "id").select(*cols)
    return out


def lessons(spark: SparkSession, root: str) -> DataFrame:
    """The lessons that have an outline."""
    return table(spark, root, "course_outline").filter("id is not null").select("lesson").distinct().orderBy("lesson")


def get_lesson_outline(spark: SparkSession, root: str, lesson: str) -> DataFrame:
    """The outline of a lesson; no rows for an unknown one (``lessons`` names those there are)."""
    nodes = current_rows(table(spark, root, "course_outline").drop("dense").filter(F.col("id").isNotNull()))
    return nodes.filter(F.col("lesson") == lesson).orderBy("start_sent", "id").select("start_sent", "end_sent", "begin_sec", "end_sec", "node_title", "terms")


def get_segment(spark: SparkSession, root: str, lesson: str, begin: float, end: float) -> DataFrame:
    """What is said in a lesson between two times: begin, end, n_sentences, text. Sentences that only touch don't count."""
    s = sentence_rows(spark, root).filter((F.col("lesson") == lesson) & (F.col("end_sec") > begin) & (F.col("begin_sec") < end) & F.col("text").isNotNull())
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_no", "text"))), lambda x: x["text"]), "")
    return s.agg(F.count("*").alias("n_sentences"), text.alias("text"))
