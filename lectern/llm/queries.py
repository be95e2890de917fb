"""Queries of the numbered problems tagged llm; problem 4 is in the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import lookalikes, neighbours, packing, sentences, splitting, tokens, vocabulary
from lectern.operators.versions import current_rows
from lectern.sources.tables import table

CAPACITY = 2048


def current_texts(spark: SparkSession, sf_dir: str, one_in: int = 1) -> DataFrame:
    """id, text of the current points; or of those in a slice by id, which is cut out before rows are shuffled."""
    rows = table(spark, sf_dir, "course_subs").select("id", "ingested_at", "text")
    if one_in > 1:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0)
    return current_rows(rows).select("id", "text")


# 1: frequencies
def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = table(spark, sf_dir, "vocab_terms").select("vocab")
    # the slice decides only which of two ways a term is counted
    return vocabulary.marked(*vocabulary.term_counts(current_texts(spark, sf_dir), vocab, current_texts(spark, sf_dir, 50)))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).filter(F.col("mark").isNotNull()).select("term", "mark")


def p1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).select("term", "n", "records", "mark")


# 2: texts that look the same
def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True).select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text")
    hot = table(spark, sf_dir, "hotwords").select(F.lit("hotwords").alias("src"), F.col("hot_id").alias("id"), "text")
    return docs.unionByName(hot)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.same_looking_pairs(lookalikes.canonical_keys(_entries(spark, sf_dir), "src", "id"), "src")


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.same_looking_classes(lookalikes.canonical_keys(_entries(spark, sf_dir), "src", "id"), "src")


def p2_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.canonical_texts(_entries(spark, sf_dir)).select("src", "id", "canonical")


# 3: oversized texts
def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("item"), "text")
    subs = current_texts(spark, sf_dir).withColumnRenamed("id", "item")
    a = splitting.split_texts(docs, "item", "text", 2000).withColumn("src", F.lit("documents"))
    b = splitting.split_texts(subs, "item", "text", 400).withColumn("src", F.lit("course_subs"))
    return a.unionByName(b)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).filter("piece_no = 0").select("src", "item", "cut_kind")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).select("src", "item", "piece_no", "begin_pos", "end_pos", "piece")


# 5: nearest neighbours
COLLS = ("course_subs", "course_outline")


def _near(spark: SparkSession, sf_dir: str, coll: str) -> tuple[DataFrame, DataFrame]:
    points = table(spark, sf_dir, coll, spread=True).select("id", "ingested_at", "dense")
    return points, neighbours.nearest_neighbours(points, "id", "ingested_at", "dense")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for coll in COLLS:
        points, near = _near(spark, sf_dir, coll)
        pairs = neighbours.pairs_at_least(near, points, "id", "ingested_at", "dense", 0.80)
        parts.append(pairs.select(F.lit(coll).alias("coll"), "id_a", "id_b"))
    return parts[0].unionByName(parts[1])


def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_near(spark, sf_dir, coll)[1].select(F.lit(coll).alias("coll"), F.col("key").alias("id"), "rank", F.col("near").alias("near_id"), "cosine") for coll in COLLS]
    return parts[0].unionByName(parts[1])


# 6: token ids
def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_ids(table(spark, sf_dir, "documents", spread=True).select("doc_id", "text"), "doc_id", "text")


# 7: containers
def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = tokens.token_sizes(table(spark, sf_dir, "documents", spread=True).select("doc_id", "text"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "n_tokens", CAPACITY)


# 8: sentence units
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    outline = table(spark, sf_dir, "course_outline")
    titles = outline.select("title").union(outline.select("node_title"))
    model = sentences.train(table(spark, sf_dir, "sentences"), "lesson", "sent_no", "text", titles)
    return sentences.sentence_units(table(spark, sf_dir, "documents", spread=True).select("doc_id", "text"), "doc_id", "text", model)


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_classes, p2_texts, p3_found, p3_pieces, p5_found, p5_neighbours, p6_ids, p7_containers, p8_found)}
