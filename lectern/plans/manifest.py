"""Manifest, catalogue, matching and identity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import ids
from lectern.operators import matching
from lectern.operators.catalog import catalogue as catalogue_rows
from lectern.operators.catalog import cohorts, rollup
from lectern.operators.ordered import numbered
from lectern.operators.versions import current_rows
from lectern.sources.tables import table


def manifest_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recording time out of the version-1 UUID in the file name."""
    m = table(spark, sf_dir, "manifest")
    return m.select("lesson", "file", ids.uuid1_micros(F.col("file")).alias("micros"))


def manifest_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort from file name and the days on which confirmed recordings of the year exist."""
    m = table(spark, sf_dir, "manifest").distinct()
    return cohorts(m, 2026).select("lesson", "file", "derived")


def cohort_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings, seconds and confirmed ones by cohort, with a total."""
    return rollup(table(spark, sf_dir, "manifest").distinct())


def manifest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each recording by time, nulls last, then file."""
    m = table(spark, sf_dir, "manifest").distinct()
    order = [F.col("platform_time").asc_nulls_last(), F.col("file"), F.col("lesson")]
    return numbered(m.select("lesson", "file", "platform_time"), order, "place").drop("platform_time")


def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version-5 id of each index point, from its lesson and number."""
    subs = table(spark, sf_dir, "course_subs").select("id", F.concat_ws(":", "lesson", F.col("block_id").cast("string")).alias("name"))
    outl = table(spark, sf_dir, "course_outline").select("id", F.concat_ws(":", "lesson", F.lit("ol"), F.col("start_sent").cast("string")).alias("name"))
    return subs.unionByName(outl).distinct().select("id", "name", ids.uuid5_hex(F.col("name")).alias("uuid"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes, points, duration and most frequent terms of every lesson."""
    nodes = current_rows(table(spark, sf_dir, "course_outline").drop("dense"))
    subs = current_rows(table(spark, sf_dir, "course_subs").select("id", "ingested_at", "lesson"))
    return catalogue_rows(nodes, subs, table(spark, sf_dir, "manifest"))


def match_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings and lessons of the outline, matched one to one by nearest duration."""
    videos, lessons = _durations(spark, sf_dir)
    return matching.nearest_pairs(videos, lessons).select("a", "b", "diff", F.when(F.col("diff") <= 90, "OK").when(F.col("diff") <= 300, "near").otherwise("doubtful").alias("label"))


def _durations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    videos = table(spark, sf_dir, "manifest").filter("duration_sec > 0").select(F.col("file").alias("id"), F.col("duration_sec").cast("long").alias("value")).groupBy("id").agg(F.max("value").alias("value"))
    o = current_rows(table(spark, sf_dir, "course_outline").select("id", "ingested_at", "lesson", "end_sec"))
    lessons = o.filter(F.col("end_sec").isNotNull()).groupBy(F.col("lesson").alias("id")).agg(F.round(F.max("end_sec")).cast("long").alias("value"))
    return videos, lessons


def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings and lessons that no match took."""
    videos, lessons = _durations(spark, sf_dir)
    m = matching.nearest_pairs(videos, lessons)
    a = videos.join(m, F.col("id") == F.col("a"), "left_anti").select(F.lit("file").alias("side"), "id")
    return a.unionByName(lessons.join(m, F.col("id") == F.col("b"), "left_anti").select(F.lit("lesson").alias("side"), "id"))


def order_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer, by key, that are dated before the order before them."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("prev", F.lag("o_orderdate").over(w))
    return o.groupBy("o_custkey").agg(F.count_if(F.col("prev") > F.col("o_orderdate")).cast("long").alias("inversions"))


QUERIES = {
    f.__name__: f
    for f in (manifest_times, manifest_cohorts, cohort_rollup, manifest_order, point_ids, catalogue, match_durations, unmatched, order_inversions)
}

_UUID = "'^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}'"
_SINCE = """((CAST('0x' || substr(file, 15, 4) AS BIGINT) & 4095) * 281474976710656 + CAST('0x' || substr(file, 10, 4) AS BIGINT) * 4294967296
  + CAST('0x' || substr(file, 1, 8) AS BIGINT) - 122192928000000000)"""
_MICROS = f"CASE WHEN regexp_matches(file, {_UUID}) THEN ({_SINCE} - ({_SINCE} % 10 + 10) % 10) // 10 END"
_CUR_OUT = "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM course_outline WHERE id IS NOT NULL) WHERE rn = 1)"
_CUR_SUB = "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM course_subs WHERE id IS NOT NULL) WHERE rn = 1)"
_MATCH = f"""
WITH RECURSIVE v AS (SELECT file AS id, max(CAST(duration_sec AS BIGINT)) AS value FROM manifest WHERE duration_sec > 0 GROUP BY file),
l AS (SELECT lesson AS id, CAST(round(max(end_sec)) AS BIGINT) AS value FROM {_CUR_OUT} WHERE end_sec IS NOT NULL GROUP BY lesson),
pairs AS (SELECT v.id AS a, l.id AS b, abs(v.value - l.value) AS diff, row_number() OVER (ORDER BY abs(v.value - l.value), v.id, l.id) AS rk FROM v, l),
run(rk, used_a, used_b, a, b, diff) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT * FROM (SELECT p.rk, list_append(used_a, p.a), list_append(used_b, p.b), p.a, p.b, p.diff
    FROM run, pairs p WHERE p.rk > run.rk AND NOT list_contains(used_a, p.a) AND NOT list_contains(used_b, p.b) ORDER BY p.rk LIMIT 1)),
m AS (SELECT a, b, diff FROM run WHERE a IS NOT NULL)
"""

ORACLE = {
    "manifest_times": f"SELECT lesson, file, {_MICROS} AS micros FROM manifest",
    "manifest_cohorts": f"""WITH m AS (SELECT DISTINCT lesson, file, platform_time, confidence, cohort, lesson_no, lesson_title, size_mb, duration_sec, {_MICROS} AS us FROM manifest),
      d AS (SELECT DISTINCT CAST(platform_time AS DATE) AS day FROM m WHERE confidence IS NOT NULL AND platform_time IS NOT NULL)
      SELECT lesson, file, CASE WHEN us IS NULL THEN 'unknown' WHEN year(make_timestamp(us)) = 2026 AND CAST(make_timestamp(us) AS DATE) IN (SELECT day FROM d)
      THEN '2026' ELSE 'archive' END AS derived FROM m""",
    "cohort_rollup": """WITH m AS (SELECT DISTINCT * FROM manifest)
      SELECT coalesce(cohort, 'unknown') AS cohort, count(*) AS n, CAST(coalesce(sum(duration_sec), 0) AS BIGINT) AS seconds, count(*) FILTER (confidence = 'confirmed') AS confirmed FROM m GROUP BY 1
      UNION ALL SELECT 'total', count(*), CAST(coalesce(sum(duration_sec), 0) AS BIGINT), count(*) FILTER (confidence = 'confirmed') FROM m""",
    "manifest_order": """WITH m AS (SELECT DISTINCT * FROM manifest)
      SELECT lesson, file, row_number() OVER (ORDER BY platform_time NULLS LAST, file, lesson) AS place FROM m""",
    "point_ids": """WITH n AS (SELECT DISTINCT id, concat_ws(':', lesson, CAST(block_id AS VARCHAR)) AS name FROM course_subs
      UNION SELECT DISTINCT id, concat_ws(':', lesson, 'ol', CAST(start_sent AS VARCHAR)) FROM course_outline),
      h AS (SELECT id, name, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(name)) AS h FROM n)
      SELECT id, name, substr(h, 1, 12) || '5' || substr(h, 14, 3) || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1, 1) || substr(h, 18, 15) AS uuid FROM h""",
    "catalogue": f"""WITH n AS (SELECT * FROM {_CUR_OUT}),
      t AS (SELECT lesson, term, count(*) AS c, min(start_sent * 1000 + pos) AS first FROM
        (SELECT lesson, start_sent, unnest(terms) AS term, unnest(range(len(terms))) AS pos FROM n) WHERE term IS NOT NULL GROUP BY lesson, term),
      r AS (SELECT lesson, term, row_number() OVER (PARTITION BY lesson ORDER BY c DESC, first, term) AS rk FROM t),
      top AS (SELECT lesson, string_agg(term, ', ' ORDER BY rk) AS terms FROM r WHERE rk <= 6 GROUP BY lesson),
      s AS (SELECT lesson, count(*) AS n_subs FROM {_CUR_SUB} GROUP BY lesson),
      g AS (SELECT lesson, count(*) AS n_nodes FROM n GROUP BY lesson),
      d AS (SELECT lesson, max(duration_sec) AS sec FROM manifest GROUP BY lesson)
      SELECT coalesce(g.lesson, s.lesson) AS lesson, coalesce(n_nodes, 0) AS n_nodes, coalesce(n_subs, 0) AS n_subs,
        CASE WHEN coalesce(sec, 0) = 0 THEN '?' ELSE CAST(sec // 3600 AS VARCHAR) || 'h' || lpad(CAST(sec % 3600 // 60 AS VARCHAR), 2, '0') || 'm' END AS duration,
        coalesce(top.terms, '—') AS terms
      FROM g FULL JOIN s ON g.lesson = s.lesson LEFT JOIN top ON top.lesson = coalesce(g.lesson, s.lesson) LEFT JOIN d ON d.lesson = coalesce(g.lesson, s.lesson)""",
    "match_durations": _MATCH + "SELECT a, b, diff, CASE WHEN diff <= 90 THEN 'OK' WHEN diff <= 300 THEN 'near' ELSE 'doubtful' END AS label FROM m",
    "unmatched": _MATCH + "SELECT 'file' AS side, id FROM v WHERE id NOT IN (SELECT a FROM m) UNION ALL SELECT 'lesson', id FROM l WHERE id NOT IN (SELECT b FROM m)",
    "order_inversions": """SELECT o_custkey, count(*) FILTER (prev > o_orderdate) AS inversions
      FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev FROM orders) GROUP BY o_custkey""",
}
