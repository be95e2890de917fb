"""Queries on resuming, replacing, sinks and streams."""

from __future__ import annotations

import os
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import segments, state
from lectern.operators.intervals import millis
from lectern.operators.versions import current_rows
from lectern.plans.manifest import ORACLE as MANIFEST_SQL
from lectern.plans.manifest import catalogue
from lectern.plans.transcripts import sentence_rows
from lectern.session import scratch
from lectern.sources import files, sinks
from lectern.sources.tables import table
from lectern.streaming import ingest


def _work(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    seg = table(spark, sf_dir, "segments").filter("end_sec > start_sec and not isnan(end_sec) and not isnan(start_sec)")
    seg = seg.select("lesson", "seg_no", millis(F.col("start_sec")).alias("start_ms"))
    s = sentence_rows(spark, sf_dir).filter("text is not null and begin_sec is not null").select("lesson", "sent_no", millis(F.col("begin_sec")).alias("begin_ms"))
    return seg.select("lesson", "seg_no").distinct(), segments.segment_of(s, seg, "lesson").filter("seg_no is not null")


def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments for which the transcript has nothing yet."""
    work, done = _work(spark, sf_dir)
    return state.pending(work, done, ["lesson", "seg_no"])


def lesson_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all segments of a lesson are transcribed."""
    work, done = _work(spark, sf_dir)
    return state.completion(work, done, "lesson", ["lesson", "seg_no"])


def failed_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a user after the last success."""
    e = table(spark, sf_dir, "events")
    return state.standing_failures(e, "user_id", "event_id", F.col("event_type") == "error", F.col("event_type") == "purchase")


def _home(spark: SparkSession) -> str:
    return scratch(spark, "table")


def replace_lesson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by lesson, whose first lesson is then replaced by its current rows, twice."""
    home, o = _home(spark), table(spark, sf_dir, "course_outline").select("id", "lesson", "start_sent", "ingested_at")
    first = o.agg(F.min("lesson")).first()[0]
    sinks.write_partitioned(o, home, "lesson")
    new = current_rows(o.filter(F.col("lesson") == first))
    for _ in range(2):
        sinks.replace_groups(new, home, "lesson")
    return spark.read.schema(o.schema).parquet(home).select("id", "lesson", "start_sent")


def upsert_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest version of every point, brought up to date with its newest one."""
    p = table(spark, sf_dir, "course_subs").select("id", "lesson", "text", "ingested_at").filter("id is not null")
    w = Window.partitionBy("id").orderBy(F.asc_nulls_first("ingested_at"))
    base = p.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    return sinks.upsert(base, current_rows(p), "id").select("id", "lesson", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts written as JSON by lesson and read again with a declared schema."""
    home, s = _home(spark), sentence_rows(spark, sf_dir).select("lesson", "sent_no", "begin_sec", "end_sec", "text")
    sinks.write_partitioned(s, home, "lesson", "json")
    back = files.json_documents(spark, home, s.schema, whole_files=False)
    return back.select("lesson", "sent_no", "begin_sec", "end_sec", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def catalogue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as a Markdown table."""
    return sinks.markdown_lines(catalogue(spark, sf_dir), ["lesson", "n_nodes", "n_subs", "duration", "terms"], ["lesson"])


def outline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lesson's outline as one JSON array."""
    o = current_rows(table(spark, sf_dir, "course_outline").drop("dense"))
    return sinks.as_json(o, "lesson", ["start_sent", "begin_sec", "end_sec", "node_title", "terms"], ["start_sent", "id"])


def _source(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, object]:
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # a stream source is a folder or a pattern
    return (path if os.path.isdir(path) else f"{sf_dir}/{name}.parque[t]"), schema


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken as a stream, each once."""
    return ingest.ingest(spark, *_source(spark, sf_dir, "events"), ["event_id", "user_id", "event_type", "value"])


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of events by type, as stream state."""
    p = ingest.progress(spark, *_source(spark, sf_dir, "events"), "event_type", "value")
    return p.select("status", "n", F.round("total", 2).alias("total"))


QUERIES = {
    f.__name__: f
    for f in (resume_plan, lesson_complete, failed_retry, replace_lesson, upsert_points, json_round_trip, catalogue_lines, outline_json, stream_ingest, stream_progress)
}

_SENT = """sent AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY lesson, sent_no ORDER BY recv_at DESC NULLS LAST) AS rn
  FROM sentences WHERE sent_no IS NOT NULL) WHERE rn = 1)"""
_WORK = f"""WITH {_SENT}, v AS (SELECT DISTINCT lesson, seg_no, CAST(round(start_sec * 1000) AS BIGINT) AS t FROM segments WHERE end_sec > start_sec),
  seg AS (SELECT lesson, t, max(seg_no) AS seg_no FROM v GROUP BY 1, 2), work AS (SELECT DISTINCT lesson, seg_no FROM v),
  s AS (SELECT lesson, CAST(round(begin_sec * 1000) AS BIGINT) AS b FROM sent WHERE text IS NOT NULL AND begin_sec IS NOT NULL),
  done AS (SELECT DISTINCT s.lesson, seg.seg_no FROM s ASOF JOIN seg ON s.lesson = seg.lesson AND s.b >= seg.t),
  w AS (SELECT work.lesson, work.seg_no, done.seg_no IS NOT NULL AS ok FROM work LEFT JOIN done ON work.lesson = done.lesson AND work.seg_no = done.seg_no)"""
ORACLE = {
    "catalogue_lines": "SELECT row_number() OVER (ORDER BY k, lesson) AS line_no, line FROM (SELECT 0 AS k, '' AS lesson, '| lesson | n_nodes | n_subs | duration | terms |' AS line UNION ALL SELECT 1, '', '|---|---|---|---|---|' "
    "UNION ALL SELECT 2, lesson, '| ' || concat_ws(' | ', replace(lesson, '|', '\\|'), n_nodes, n_subs, duration, replace(terms, '|', '\\|')) || ' |' FROM (" + MANIFEST_SQL["catalogue"] + "))",
    "resume_plan": _WORK + " SELECT lesson, seg_no FROM w WHERE NOT ok",
    "lesson_complete": _WORK + " SELECT lesson, count(*) AS n, count(*) FILTER (ok) AS n_done, bool_and(ok) AS complete FROM w GROUP BY lesson",
    "failed_retry": """WITH ok AS (SELECT user_id, max(event_id) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1)
      SELECT e.user_id, count(*) AS n, max(event_id) AS last FROM events e LEFT JOIN ok ON ok.user_id = e.user_id WHERE event_type = 'error' AND (m IS NULL OR event_id > m) GROUP BY 1""",
    "replace_lesson": """WITH f AS (SELECT min(lesson) AS l FROM course_outline)
      SELECT id, lesson, start_sent FROM course_outline WHERE lesson <> (SELECT l FROM f)
      UNION ALL SELECT id, lesson, start_sent FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn
        FROM course_outline WHERE lesson = (SELECT l FROM f) AND id IS NOT NULL) WHERE rn = 1""",
    "upsert_points": """SELECT id, lesson, md5(text) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn
      FROM course_subs WHERE id IS NOT NULL) WHERE rn = 1""",
    "json_round_trip": f"WITH {_SENT} SELECT lesson, sent_no, begin_sec, end_sec, md5(text) AS text_md5 FROM sent",
    "stream_ingest": "SELECT event_id, user_id, event_type, value FROM events",
    "stream_progress": "SELECT event_type AS status, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
}
