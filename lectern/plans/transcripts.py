"""Queries over segments, transcripts and their chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import chunking, segments
from lectern.operators.intervals import millis
from lectern.operators.versions import current_rows
from lectern.session import scratch
from lectern.sources import sinks
from lectern.sources.tables import table


def sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcript without repeats: one row per lesson and number, the latest received."""
    s = table(spark, sf_dir, "sentences").filter("sent_no is not null")
    w = Window.partitionBy("lesson", "sent_no").orderBy(F.desc_nulls_last("recv_at"))
    return s.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sentence_rows(spark, sf_dir)
    return s.withColumn("begin_ms", millis(F.col("begin_sec"))).withColumn("end_ms", millis(F.col("end_sec")))


def _results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Segments, and the lines of their result files: documents of sentences, of segments without speech, and broken ones."""
    seg = table(spark, sf_dir, "segments").filter("end_sec > start_sec and not isnan(end_sec) and not isnan(start_sec)")
    seg = seg.select("lesson", "seg_no", millis(F.col("start_sec")).alias("start_ms")).distinct()
    s = _timed(spark, sf_dir).filter("text is not null and begin_ms is not null").select("lesson", "sent_no", "begin_ms", "end_ms", "text")
    placed = segments.segment_of(s, seg, "lesson").filter("seg_no is not null")
    spoken = segments.results_as_json(placed, "lesson")
    silent = segments.no_speech(seg.join(spoken, ["lesson", "seg_no", "start_ms"], "left_anti"), "lesson")
    broken = seg.select("lesson").distinct().select("lesson", F.lit('{"meta": {"segment": "').alias("body"))
    home = scratch(spark, "results")
    sinks.write_partitioned(spoken.unionByName(silent).select("lesson", "body").unionByName(broken), home, "lesson", "text")
    return seg, spark.read.text(home).select(F.col("value").alias("body"))


def merge_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-segment result files, read as JSON, joined to their segments and merged onto the lesson's clock."""
    seg, bodies = _results(spark, sf_dir)
    return segments.merge_results(segments.results_of(bodies, seg, "lesson"), "lesson")


def segment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """done or no_speech for every segment that has a result file: neither is tried again."""
    seg, bodies = _results(spark, sf_dir)
    r = segments.results_of(bodies, seg, "lesson")
    silent = F.coalesce(F.from_json("body", segments.ASR_RESULT)["meta"]["no_speech"], F.lit(False))
    return r.select("lesson", "seg_no", "start_ms", F.when(silent, "no_speech").otherwise("done").alias("status"))


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir).groupBy("lesson").agg(F.max("end_ms").alias("dur_ms"))


def plan_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts of every lesson at pauses of its transcript."""
    marks = segments.pauses(_timed(spark, sf_dir).select("lesson", "begin_ms", "end_ms"), "lesson", "begin_ms", "end_ms")
    return segments.plan_cuts(marks, _lengths(spark, sf_dir), "lesson")


def segment_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments between the cuts."""
    return segments.bounds(plan_cuts(spark, sf_dir), _lengths(spark, sf_dir), "lesson")


def get_segment(spark: SparkSession, sf_dir: str, begin: float = 20.0, end: float = 60.0) -> DataFrame:
    """What is said between two times, in every lesson."""
    s = sentence_rows(spark, sf_dir).filter((F.col("end_sec") > begin) & (F.col("begin_sec") < end) & F.col("text").isNotNull())
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent_no", "text"))), lambda x: x["text"]), "")
    return s.groupBy("lesson").agg(F.count("*").alias("n_sentences"), text.alias("text"))


def get_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of every lesson, six terms a node."""
    o = current_rows(table(spark, sf_dir, "course_outline").drop("dense"))
    w = Window.partitionBy("lesson").orderBy("start_sent", "id")
    return o.select(
        "lesson", F.row_number().over(w).cast("long").alias("node_no"), "begin_sec", "end_sec", "node_title", F.array_join(F.slice(F.coalesce("terms", F.array()), 1, 6), ", ").alias("terms")
    )


def outline_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of sentences between the topic breaks."""
    o = current_rows(table(spark, sf_dir, "course_outline").select("id", "ingested_at", "lesson", "start_sent"))
    return chunking.node_bounds(o.select("lesson", F.col("start_sent").alias("at")), sentence_rows(spark, sf_dir), "lesson")


def _subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.sub_chunks(sentence_rows(spark, sf_dir), "lesson")


def titled_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = current_rows(table(spark, sf_dir, "course_outline").select("id", "ingested_at", "lesson", "start_sent", "begin_sec", "node_title"))
    return chunking.assign_nodes(_subs(spark, sf_dir), nodes, "lesson")


def sub_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping sub-chunks of every lesson."""
    return _subs(spark, sf_dir).select("lesson", "start_sent", "end_sent", "begin_sec", "end_sec", "n_chars", "n_sents", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def assign_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline title of every sub-chunk."""
    return titled_chunks(spark, sf_dir).select("lesson", "start_sent", "node_title")


def parent_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent chunks over the titled sub-chunks."""
    return chunking.parent_chunks(titled_chunks(spark, sf_dir), "lesson").select("lesson", "start_sent", "n_subs", "n_chars", "node_title", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


QUERIES = {
    f.__name__: f
    for f in (merge_transcript, segment_status, plan_cuts, segment_bounds, get_segment, get_outline, outline_nodes, sub_chunks, assign_nodes, parent_chunks)
}

_SENT = """sent AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY lesson, sent_no ORDER BY recv_at DESC NULLS LAST) AS rn
  FROM sentences WHERE sent_no IS NOT NULL) WHERE rn = 1)"""
_OUT = """outl AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn
  FROM course_outline WHERE id IS NOT NULL) WHERE rn = 1)"""
_MS = "CAST(round({0} * 1000) AS BIGINT)"
_CUTS = f"""WITH RECURSIVE {_SENT},
  ms AS (SELECT lesson, {_MS.format('begin_sec')} AS b, {_MS.format('end_sec')} AS e FROM sent),
  len AS (SELECT lesson, max(e) AS dur FROM ms WHERE e IS NOT NULL GROUP BY lesson),
  ok AS (SELECT lesson, b, max(e) OVER (PARTITION BY lesson ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ms WHERE e > b),
  marks AS (SELECT lesson, list((reach + b) // 2 ORDER BY b) AS m FROM ok WHERE b > reach GROUP BY lesson),
  run AS (
    SELECT lesson, dur, CAST(0 AS BIGINT) AS c0, m FROM len LEFT JOIN marks USING (lesson)
    UNION ALL
    SELECT lesson, dur, coalesce(list_min(list_transform(list_filter(m, lambda x: x >= c0 + 840000 AND x <= c0 + 1200000 AND x < dur),
      lambda x: {{'d': abs(x - c0 - 900000), 'x': x}})).x, c0 + 900000), m FROM run WHERE dur - c0 > 1200000),
  cuts AS (SELECT lesson, c0 AS cut_ms FROM run WHERE c0 > 0)"""
SUBS_SQL = f"""WITH RECURSIVE {_SENT}, {_OUT},
  s AS (SELECT lesson, sent_no, begin_sec, end_sec, text, length(text) AS len, right(text, 1) IN ('。','！','？','?','.','!') AS term,
    row_number() OVER (PARTITION BY lesson ORDER BY sent_no) AS k FROM sent WHERE length(text) > 0),
  walk AS (
    SELECT lesson, CAST(0 AS BIGINT) AS k, CAST(1 AS BIGINT) AS first, CAST(0 AS BIGINT) AS size, false AS fired, CAST(1 AS BIGINT) AS was FROM s WHERE k = 1
    UNION ALL
    SELECT w.lesson, s.k, CASE WHEN f THEN s.k ELSE first END, CASE WHEN f THEN len ELSE size + len END, f, first FROM walk w JOIN s ON s.lesson = w.lesson AND s.k = w.k + 1,
      LATERAL (SELECT size + len >= 400 OR (size + len >= 200 AND term) AS f)),
  ends AS (SELECT lesson, was AS a, k AS z FROM walk WHERE fired
    UNION ALL SELECT lesson, first, k FROM walk w WHERE k = (SELECT max(k) FROM s WHERE s.lesson = w.lesson) AND k > first),
  subs AS (SELECT e.lesson, min(sent_no) AS start_sent, max(sent_no) AS end_sent, arg_min(begin_sec, k) AS begin_sec, arg_max(end_sec, k) AS end_sec,
    CAST(sum(len) AS BIGINT) AS n_chars, count(*) AS n_sents, string_agg(text, '' ORDER BY k) AS text FROM ends e JOIN s ON s.lesson = e.lesson AND s.k BETWEEN a AND z GROUP BY e.lesson, a, z),
  tips AS (SELECT lesson, {_MS.format('begin_sec')} AS t, arg_max(coalesce(node_title, ''), (start_sent, coalesce(node_title, ''))) AS title FROM outl WHERE begin_sec IS NOT NULL GROUP BY 1, 2),
  f AS (SELECT lesson, arg_min(title, t) AS title FROM tips GROUP BY lesson),
  titled AS (SELECT u.*, coalesce(n.title, f.title, '') AS node_title FROM subs u
    ASOF LEFT JOIN tips n ON u.lesson = n.lesson AND {_MS.format('u.begin_sec')} >= n.t LEFT JOIN f ON f.lesson = u.lesson)"""

ORACLE = {
    "merge_transcript": f"""WITH {_SENT},
      seg AS (SELECT lesson, {_MS.format('start_sec')} AS t, max(seg_no) AS seg_no FROM segments WHERE end_sec > start_sec GROUP BY 1, 2),
      s AS (SELECT lesson, sent_no, {_MS.format('begin_sec')} AS b, {_MS.format('end_sec')} AS e, text FROM sent WHERE text IS NOT NULL AND begin_sec IS NOT NULL),
      j AS (SELECT s.*, seg.seg_no FROM s ASOF JOIN seg ON s.lesson = seg.lesson AND s.b >= seg.t)
      SELECT lesson, seg_no, CAST(row_number() OVER (PARTITION BY lesson, seg_no ORDER BY sent_no) - 1 AS INT) AS pos, round(b / 1000.0, 2) AS begin, round(e / 1000.0, 2) AS "end", text FROM j""",
    "segment_status": f"""WITH {_SENT},
      v AS (SELECT DISTINCT lesson, seg_no, {_MS.format('start_sec')} AS t FROM segments WHERE end_sec > start_sec),
      tip AS (SELECT lesson, t, max(seg_no) AS seg_no FROM v GROUP BY 1, 2),
      s AS (SELECT lesson, {_MS.format('begin_sec')} AS b FROM sent WHERE text IS NOT NULL AND begin_sec IS NOT NULL),
      d AS (SELECT DISTINCT s.lesson, tip.seg_no, tip.t FROM s ASOF JOIN tip ON s.lesson = tip.lesson AND s.b >= tip.t)
      SELECT v.lesson, v.seg_no, v.t AS start_ms, CASE WHEN d.t IS NULL THEN 'no_speech' ELSE 'done' END AS status
      FROM v LEFT JOIN d ON d.lesson = v.lesson AND d.seg_no = v.seg_no AND d.t = v.t""",
    "plan_cuts": _CUTS + " SELECT lesson, cut_ms FROM cuts",
    "segment_bounds": _CUTS
    + """, e AS (SELECT lesson, dur AS end_ms FROM len WHERE dur > 0 UNION ALL SELECT lesson, cut_ms FROM cuts)
      SELECT lesson, CAST(row_number() OVER w - 1 AS INT) AS seg_no, coalesce(lag(end_ms) OVER w, 0) AS start_ms, end_ms FROM e WINDOW w AS (PARTITION BY lesson ORDER BY end_ms)""",
    "get_segment": f"WITH {_SENT} SELECT lesson, count(*) AS n_sentences, string_agg(text, '' ORDER BY sent_no) AS text FROM sent WHERE end_sec > 20 AND begin_sec < 60 AND text IS NOT NULL GROUP BY lesson",
    "get_outline": f"""WITH {_OUT} SELECT lesson, row_number() OVER (PARTITION BY lesson ORDER BY start_sent, id) AS node_no, begin_sec, end_sec, node_title,
      coalesce(array_to_string(terms[1:6], ', '), '') AS terms FROM outl""",
    "outline_nodes": f"""WITH {_SENT}, {_OUT}, n AS (SELECT lesson, max(sent_no) + 1 AS n FROM sent GROUP BY lesson),
      b AS (SELECT o.lesson, start_sent AS brk FROM outl o JOIN n USING (lesson) WHERE start_sent >= 0 AND start_sent < n UNION SELECT lesson, 0 FROM n UNION SELECT lesson, n FROM n),
      r AS (SELECT lesson, brk AS start_sent, lead(brk) OVER (PARTITION BY lesson ORDER BY brk) AS end_sent FROM b)
      SELECT r.lesson, start_sent, r.end_sent, arg_min(s.begin_sec, s.sent_no) FILTER (s.begin_sec IS NOT NULL) AS begin_sec, arg_max(s.end_sec, s.sent_no) FILTER (s.end_sec IS NOT NULL) AS end_sec
      FROM r LEFT JOIN sent s ON s.lesson = r.lesson AND s.sent_no >= start_sent AND s.sent_no < r.end_sent WHERE r.end_sent - start_sent >= 5 GROUP BY 1, 2, 3""",
    "sub_chunks": SUBS_SQL + " SELECT lesson, start_sent, end_sent, begin_sec, end_sec, n_chars, n_sents, md5(text) AS text_md5 FROM subs",
    "assign_nodes": SUBS_SQL + " SELECT lesson, start_sent, node_title FROM titled",
    "parent_chunks": SUBS_SQL
    + """, o AS (SELECT *, row_number() OVER (PARTITION BY lesson ORDER BY start_sent) AS i, lead(node_title) OVER (PARTITION BY lesson ORDER BY start_sent) AS nxt FROM titled),
      pw AS (
        SELECT lesson, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS size, true AS closed, CAST(0 AS BIGINT) AS p FROM o WHERE i = 1
        UNION ALL
        SELECT o.lesson, o.i, z, z >= 1500 AND (z >= 3000 OR o.nxt IS NULL OR o.nxt <> o.node_title), CASE WHEN pw.closed THEN o.i ELSE pw.p END
        FROM pw JOIN o ON o.lesson = pw.lesson AND o.i = pw.i + 1, LATERAL (SELECT CASE WHEN pw.closed THEN 0 ELSE pw.size END + o.n_chars AS z))
      SELECT o.lesson, min(start_sent) AS start_sent, count(*) AS n_subs, CAST(sum(n_chars) AS BIGINT) AS n_chars, arg_min(node_title, o.i) AS node_title, md5(string_agg(text, '' ORDER BY o.i)) AS text_md5
      FROM o JOIN pw ON pw.lesson = o.lesson AND pw.i = o.i GROUP BY o.lesson, p""",
}
