"""The global sparse index: one vocabulary and one inverse document frequency per term."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import terms_of
from lectern.operators.ordered import numbered


def term_frequencies(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, term, tf. Null texts hold no terms."""
    return docs.select(F.col(key), F.explode(terms_of(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def document_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, term: every document's terms once, for ``idf``; made within a row, without a shuffle."""
    return docs.select(F.col(key), F.explode(F.array_distinct(terms_of(F.col(text)))).alias("term"))


def frequencies_of(docs: DataFrame, key: str, text: str, query_tf: DataFrame) -> DataFrame:
    """``term_frequencies`` of the terms of ``query_tf`` alone: the texts' other terms are dropped where they are read."""
    terms = docs.select(F.col(key), F.explode(terms_of(F.col(text))).alias("term"))
    return terms.join(query_tf.select("term").distinct(), "term", "left_semi").groupBy(key, "term").agg(F.count("*").alias("tf"))


def idf(tf: DataFrame, n_docs: int) -> DataFrame:
    """term, df, idf = ln(1 + (N - df + 0.5) / (df + 0.5)). One row per document and term is needed."""
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    return df.withColumn("idf", F.log1p((F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5)))


def weights(tf: DataFrame, idfs: DataFrame) -> DataFrame:
    """``tf`` and weight = idf (1 + ln tf), to four places."""
    return tf.join(idfs.select("term", "idf"), "term").withColumn("weight", F.round(F.col("idf") * (1 + F.log("tf")), 4)).drop("idf")


def vocabulary(idfs: DataFrame) -> DataFrame:
    """``idfs`` and idx: place of the term in code-point order."""
    return numbered(idfs, ["term"], "idx", 0)


def save(docs: DataFrame, key: str, text: str, home: str) -> None:
    """The index of ``docs`` as tables below ``home``: ``idf`` (term, df, idf), ``weights`` (key, term, weight), by term."""
    tf = term_frequencies(docs, key, text)
    own = idf(tf, docs.count())
    own.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{home}/idf")
    stored = weights(tf, load(docs.sparkSession, home)[0])
    # sorted by term, so that a search reads little besides its own terms
    stored.select(key, "term", "weight").repartitionByRange("term", key).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{home}/weights")


def load(spark: SparkSession, home: str) -> tuple[DataFrame, DataFrame | None]:
    """(idf, weights) of a saved index; the weights are None while they aren't written yet."""
    own = spark.read.schema("term string, df long, idf double").parquet(f"{home}/idf")
    try:
        return own, spark.read.parquet(f"{home}/weights")
    except AnalysisException:
        return own, None
