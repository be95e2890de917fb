"""Taking lessons into the index, and what its callers ask of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import api
from lectern.operators import points
from lectern.operators.versions import current_rows
from lectern.plans import search, transcripts
from lectern.session import scratch
from lectern.sources.tables import table


def ingest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All titled sub-chunks taken in, then those of the first lesson again, by another run."""
    home = scratch(spark, "index-points")
    chunks = transcripts.titled_chunks(spark, sf_dir)
    made = points.points_of(chunks, F.concat_ws(":", "lesson", F.col("start_sent").cast("string")), "text")
    points.ingest(made, home)
    stored = spark.read.schema(made.schema).parquet(home)
    first = stored.agg(F.min("lesson")).first()[0]
    points.ingest(made.filter(F.col("lesson") == first), home)
    # in units of the last place, so that the order of the sum doesn't matter
    total = F.aggregate("sparse", F.lit(0).cast("long"), lambda a, x: a + F.round(x["weight"] * 10000).cast("long"))
    return spark.read.schema(made.schema).parquet(home).select(
        "id", "lesson", "start_sent", "node_title", "n_chars", F.md5(F.encode("text", "UTF-8")).alias("text_md5"),
        F.size("dense").alias("n_dense"), F.size("sparse").alias("n_terms"), total.alias("weight_e4"),
    )


def notes_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a search for the first point's text gives."""
    docs = current_rows(table(spark, sf_dir, "course_subs").select("id", "ingested_at", "text")).filter("length(text) > 0")
    return api.search_course_notes(spark, sf_dir, docs.orderBy("id").first()["text"])["hits"]


def notes_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of the first lesson that has one."""
    got = api.get_lesson_outline(spark, sf_dir, api.lessons(spark, sf_dir).first()["lesson"])
    return got.withColumn("terms", F.concat_ws(", ", "terms"))


def notes_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said in it in the first hour."""
    return api.get_segment(spark, sf_dir, api.lessons(spark, sf_dir).first()["lesson"], 0, 3600)


QUERIES = {f.__name__: f for f in (ingest_points, notes_hits, notes_outline, notes_segment)}

_TERMS = """, rec AS (SELECT lesson || ':' || start_sent AS name, lower(text) AS t FROM titled),
  runs AS (SELECT name, unnest(regexp_extract_all(regexp_replace(t, '([\\x{4E00}-\\x{9FFF}]+)', ' \\1 ', 'g'), '[\\p{L}\\p{N}]+')) AS r FROM rec),
  occ AS (SELECT name, r AS term FROM runs WHERE NOT regexp_matches(r, '^[\\x{4E00}-\\x{9FFF}]') OR length(r) = 1
    UNION ALL SELECT name, unnest(list_transform(range(1, length(r)), lambda i: substr(r, i, 2))) FROM runs WHERE regexp_matches(r, '^[\\x{4E00}-\\x{9FFF}]') AND length(r) > 1),
  tf AS (SELECT name, term, count(*) AS tf FROM occ GROUP BY 1, 2),
  idf AS (SELECT term, ln(1 + ((SELECT count(*) FROM rec) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM tf GROUP BY term),
  w AS (SELECT name, count(*) AS n, CAST(sum(CAST(round(round(idf * (1 + ln(tf)), 4) * 10000) AS BIGINT)) AS BIGINT) AS weight FROM tf JOIN idf USING (term) GROUP BY name),
  h AS (SELECT *, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(name)) AS x FROM (SELECT *, lesson || ':' || start_sent AS name FROM titled))"""
_CLOCK = "CAST(floor({0}) AS BIGINT) // 3600 || ':' || lpad(CAST(CAST(floor({0}) AS BIGINT) % 3600 // 60 AS VARCHAR), 2, '0')"
_FIRST = "(SELECT min(lesson) FROM course_outline WHERE id IS NOT NULL)"

ORACLE = {
    "ingest_points": transcripts.SUBS_SQL
    + _TERMS
    + """ SELECT substr(x, 1, 12) || '5' || substr(x, 14, 3) || substr('89ab', CAST('0x' || substr(x, 17, 1) AS INT) % 4 + 1, 1) || substr(x, 18, 15) AS id, lesson, start_sent, node_title, n_chars, md5(text) AS text_md5,
      1024 AS n_dense, coalesce(n, 0) AS n_terms, coalesce(weight, 0) AS weight_e4 FROM h LEFT JOIN w USING (name)""",
    "notes_hits": search.INDEX_SQL
    + f"""SELECT round(1.0::DOUBLE / (60 + rank), 6) AS score, lesson, node_title, {_CLOCK.format('begin_sec')} AS "from", {_CLOCK.format('end_sec')} AS "to", text
      FROM sl JOIN cs USING (id) WHERE rank <= 6""",
    "notes_outline": f"""SELECT start_sent, end_sent, begin_sec, end_sec, node_title, coalesce(array_to_string(terms, ', '), '') AS terms
      FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM course_outline WHERE id IS NOT NULL) WHERE rn = 1 AND lesson = {_FIRST}""",
    "notes_segment": f"""SELECT count(*) AS n_sentences, coalesce(string_agg(text, '' ORDER BY sent_no), '') AS text
      FROM (SELECT *, row_number() OVER (PARTITION BY lesson, sent_no ORDER BY recv_at DESC NULLS LAST) AS rn FROM sentences WHERE sent_no IS NOT NULL)
      WHERE rn = 1 AND lesson = {_FIRST} AND end_sec > 0 AND begin_sec < 3600 AND text IS NOT NULL""",
}
