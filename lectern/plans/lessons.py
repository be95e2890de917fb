"""Queries that choose recordings and lessons, work in blocks of sentences, and read files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators import catalog, matching
from lectern.operators import terms as terms_of
from lectern.operators.ordered import numbered, numbered_in
from lectern.operators.versions import current_rows
from lectern.plans import manifest as M
from lectern.plans import terms as PT
from lectern.plans.transcripts import sentence_rows
from lectern.session import scratch
from lectern.sources import files, sinks
from lectern.sources.tables import table


def manifest_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with a lesson number, of this year and of the archive."""
    return catalog.select_recordings(table(spark, sf_dir, "manifest").distinct(), "all").select("lesson", "file", "cohort", "lesson_no")


def _older(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Recordings of the archive or of no known cohort, and all lessons."""
    m = table(spark, sf_dir, "manifest").filter(F.col("cohort").isin("archive", "unknown") & (F.col("duration_sec") > 0))
    videos = m.groupBy(F.col("file").alias("id")).agg(F.max(F.col("duration_sec").cast("long")).alias("value"))
    return videos, M._durations(spark, sf_dir)[1]


def match_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings of the archive or of no known cohort, matched to lessons by duration."""
    return matching.nearest_pairs(*_older(spark, sf_dir))


def unmatched_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings and lessons that no such match took."""
    videos, lessons = _older(spark, sf_dir)
    m = matching.nearest_pairs(videos, lessons)
    a = videos.join(m, F.col("id") == F.col("a"), "left_anti").select(F.lit("file").alias("side"), "id")
    return a.unionByName(lessons.join(m, F.col("id") == F.col("b"), "left_anti").select(F.lit("lesson").alias("side"), "id"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = table(spark, sf_dir, "manifest").groupBy("file").agg(F.max("cohort").alias("cohort"), F.max("platform_time").alias("at"))
    return match_archive(spark, sf_dir).join(times, F.col("a") == F.col("file")).select("cohort", F.col("b").alias("lesson"), "file", "diff", "at")


def match_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches in order of cohort and lesson."""
    return numbered(_listed(spark, sf_dir), ["cohort", "lesson"], "place").select("place", "cohort", "lesson", "file", "diff")


def match_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often, within a cohort and by lesson, a matched recording is older than the one before it."""
    w = Window.partitionBy("cohort").orderBy("lesson")
    r = _listed(spark, sf_dir).withColumn("before", F.lag("at").over(w))
    return r.groupBy("cohort").agg(F.count("*").alias("n"), F.count_if(F.col("before") > F.col("at")).cast("long").alias("inversions"))


def time_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every day and every month that occurs: the first recording whose time begins with it."""
    m = table(spark, sf_dir, "manifest").filter("platform_time is not null").select("file", F.date_format("platform_time", "yyyy-MM-dd HH:mm:ss").alias("time")).distinct()
    prefixes = m.select(F.explode(F.array(F.left("time", F.lit(10)), F.left("time", F.lit(7)))).alias("prefix"))
    return catalog.first_with_prefix(m, "time", ["time", "file"], prefixes, "prefix")


def lesson_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transcribed lesson's title: of the first manifest row whose numbered name it begins with, or whose name it is."""
    m = table(spark, sf_dir, "manifest").select(F.concat(F.lit("L"), "lesson_no").alias("no"), F.col("lesson").alias("own"), F.col("lesson_title").alias("title"), "file").distinct()
    names = table(spark, sf_dir, "sentences").select("lesson")
    return catalog.first_prefix_or_equal(names, "lesson", m, "no", "own", ["file", "title"]).select("lesson", "title")


def sentence_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of 50 sentences: first and last number, how many, how many characters."""
    s = numbered_in(sentence_rows(spark, sf_dir).select("lesson", "sent_no", "text"), "lesson", ["sent_no"], "row", 0)
    b = s.withColumn("block", F.floor(F.col("row") / 50).cast("long")).groupBy("lesson", "block")
    return b.agg(F.min("sent_no").alias("first"), F.max("sent_no").alias("last"), F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars"))


def block_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence with the pairs applied that occur in its block of 50."""
    s = sentence_rows(spark, sf_dir).select("lesson", "sent_no", "text")
    c = terms_of.apply_in_blocks(s, "lesson", "sent_no", "text", PT._pairs(spark, sf_dir))
    return c.select("lesson", "sent_no", F.md5(F.encode("corrected", "UTF-8")).alias("text_md5"), F.coalesce(F.col("corrected") != F.col("text"), F.lit(False)).alias("changed"))


def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both collections made where they are absent, filled with their current points, counted."""
    home, out = scratch(spark, "table"), None
    for coll in ("course_subs", "course_outline"):
        points = current_rows(table(spark, sf_dir, coll).select("id", "ingested_at", "lesson")).select("id", "lesson")
        for _ in range(2):
            sinks.create_if_absent(spark, f"{home}/{coll}", points.schema)
        points.write.mode("append").parquet(f"{home}/{coll}")
        n = spark.read.schema(points.schema).parquet(f"{home}/{coll}").agg(F.count("*").alias("n")).select(F.lit(coll).alias("coll"), "n")
        out = n if out is None else out.unionByName(n)
    return out


def outline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lesson's outline written as one JSON array and parsed again."""
    o = current_rows(table(spark, sf_dir, "course_outline").drop("dense"))
    body = sinks.as_json(o, "lesson", ["start_sent", "begin_sec", "end_sec", "node_title", "terms"], ["start_sent", "id"])
    parsed = F.from_json("body", "array<struct<start_sent:bigint,begin_sec:double,end_sec:double,node_title:string,terms:array<string>>>")
    r = body.select("lesson", F.posexplode(parsed).alias("pos", "x")).select("lesson", "pos", "x.*")
    return r.select("lesson", "pos", "start_sent", F.round("begin_sec", 3).alias("begin_sec"), F.round("end_sec", 3).alias("end_sec"), "node_title", F.array_join("terms", ", ").alias("terms"))


def _files(spark: SparkSession, sf_dir: str) -> str:
    home = scratch(spark, "files")
    texts = table(spark, sf_dir, "documents").filter("text is not null and lesson is not null").select("lesson", "text")
    sinks.write_partitioned(texts, home, "lesson", "text")
    return home


def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents' text files that hold a letter, and how often."""
    lines = files.lines_with_letters(spark, _files(spark, sf_dir))
    return lines.groupBy(F.md5(F.encode("line", "UTF-8")).alias("line_md5")).agg(F.count("*").alias("n"))


def walked_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of these files, besides an excluded one."""
    return files.walk(spark, _files(spark, sf_dir), ".txt", ["lesson=L000"]).select(F.substring_index("source", "=", -1).alias("lesson")).distinct()


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that a listing of these files shows, with whether all have the suffix."""
    f = files.listing(spark, _files(spark, sf_dir), "*.txt")
    return f.groupBy(F.regexp_extract("path", "lesson=([^/]+)/", 1).alias("lesson")).agg(F.min(F.endswith("name", F.lit(".txt"))).alias("text_only"))


def probed_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations read out of the media tool's log lines, 0 where the probe failed."""
    d = F.col("duration_sec")
    log = F.when(d > 0, F.format_string("  Duration: %02d:%02d:%02d.40, start: 0.000", (d / 3600).cast("int"), (d % 3600 / 60).cast("int"), d % 60)).otherwise(F.lit("moov atom not found"))
    return table(spark, sf_dir, "manifest").select("lesson", "file", files.probe_seconds(log).alias("seconds"))


QUERIES = {
    f.__name__: f
    for f in (
        manifest_selected, match_archive, unmatched_archive, match_listing, match_inversions, time_lookup, lesson_titles, sentence_blocks, block_corrections,
        collection_counts, outline_rows, seed_lines, walked_folders, listed_files, probed_seconds,
    )
}

_OLDER = M._MATCH.replace("FROM manifest WHERE duration_sec > 0", "FROM manifest WHERE cohort IN ('archive', 'unknown') AND duration_sec > 0")
_LISTED = _OLDER.rstrip() + """, t AS (SELECT file, max(cohort) AS cohort, max(platform_time) AS taken FROM manifest GROUP BY file),
  listed AS (SELECT cohort, b AS lesson, file, diff, taken FROM m JOIN t ON t.file = m.a)
"""
_BLOCKS = PT._SENT + ", s AS (SELECT *, (row_number() OVER (PARTITION BY lesson ORDER BY sent_no) - 1) // 50 AS block FROM sent)"
_CUR = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM {0} WHERE id IS NOT NULL) WHERE rn = 1"
_LINES = "SELECT trim(unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')), ' ') AS line FROM documents WHERE text IS NOT NULL AND lesson IS NOT NULL"

ORACLE = {
    "manifest_selected": "SELECT DISTINCT lesson, file, cohort, lesson_no FROM manifest WHERE cohort IN ('2026', 'archive') AND lesson_no IS NOT NULL",
    "match_archive": _OLDER + "SELECT a, b, diff FROM m",
    "unmatched_archive": _OLDER + "SELECT 'file' AS side, id FROM v WHERE id NOT IN (SELECT a FROM m) UNION ALL SELECT 'lesson', id FROM l WHERE id NOT IN (SELECT b FROM m)",
    "match_listing": _LISTED + "SELECT row_number() OVER (ORDER BY cohort, lesson) AS place, cohort, lesson, file, diff FROM listed",
    "match_inversions": _LISTED + "SELECT cohort, count(*) AS n, count(*) FILTER (before > taken) AS inversions FROM (SELECT *, lag(taken) OVER (PARTITION BY cohort ORDER BY lesson) AS before FROM listed) GROUP BY cohort",
    "time_lookup": """WITH m AS (SELECT DISTINCT file, strftime(platform_time, '%Y-%m-%d %H:%M:%S') AS time FROM manifest WHERE platform_time IS NOT NULL),
      p AS (SELECT time[1:10] AS prefix FROM m UNION SELECT time[1:7] FROM m)
      SELECT prefix, file, time FROM p JOIN m ON starts_with(time, prefix) QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY time, file) = 1""",
    "lesson_titles": """WITH m AS (SELECT DISTINCT 'L' || lesson_no AS no, lesson AS own, lesson_title AS title, file FROM manifest), n AS (SELECT DISTINCT lesson FROM sentences)
      SELECT n.lesson, title FROM n JOIN m ON (no IS NOT NULL AND starts_with(n.lesson, no)) OR n.lesson = own QUALIFY row_number() OVER (PARTITION BY n.lesson ORDER BY file, title) = 1""",
    "sentence_blocks": f"WITH {_BLOCKS} SELECT lesson, block, min(sent_no) AS first, max(sent_no) AS last, count(*) AS n, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars FROM s GROUP BY 1, 2",
    "block_corrections": f"""WITH RECURSIVE {PT._PAIRS}, {_BLOCKS},
      valid AS (SELECT lesson, block, k FROM (SELECT lesson, block, string_agg(text, chr(10)) AS t FROM s GROUP BY 1, 2), pairs WHERE contains(t, wrong)),
      run AS (SELECT lesson, sent_no, block, text, replace(text, '_', chr(1)) AS t, CAST(0 AS BIGINT) AS k FROM s
        UNION ALL
        SELECT run.lesson, sent_no, run.block, text, CASE WHEN valid.k IS NULL THEN t WHEN regexp_matches(wrong, '^[A-Za-z0-9 .+-]+$') THEN regexp_replace(t, '\\b' || regexp_escape(wrong) || '\\b', "right", 'g') ELSE replace(t, wrong, "right") END, pairs.k
        FROM run JOIN pairs ON pairs.k = run.k + 1 LEFT JOIN valid ON valid.lesson = run.lesson AND valid.block = run.block AND valid.k = pairs.k),
      fixed AS (SELECT lesson, sent_no, text, replace(t, chr(1), '_') AS corrected FROM run WHERE k = (SELECT max(k) FROM pairs))
      SELECT lesson, sent_no, md5(corrected) AS text_md5, coalesce(corrected <> text, false) AS changed FROM fixed""",
    "collection_counts": "SELECT 'course_subs' AS coll, count(DISTINCT id) AS n FROM course_subs UNION ALL SELECT 'course_outline', count(DISTINCT id) FROM course_outline",
    "outline_rows": f"""WITH o AS ({_CUR.format('course_outline')})
      SELECT lesson, CAST(row_number() OVER (PARTITION BY lesson ORDER BY start_sent, id) - 1 AS INT) AS pos, start_sent, round(begin_sec, 3) AS begin_sec, round(end_sec, 3) AS end_sec, node_title,
        array_to_string(terms, ', ') AS terms FROM o""",
    "seed_lines": f"SELECT md5(line) AS line_md5, count(*) AS n FROM ({_LINES}) WHERE regexp_matches(line, '[A-Za-z]') GROUP BY 1",
    "walked_folders": "SELECT DISTINCT lesson FROM documents WHERE text IS NOT NULL AND lesson <> 'L000'",
    "listed_files": "SELECT lesson, true AS text_only FROM documents WHERE text IS NOT NULL AND lesson IS NOT NULL GROUP BY lesson",
    "probed_seconds": "SELECT lesson, file, coalesce(duration_sec, 0) AS seconds FROM manifest",
}
