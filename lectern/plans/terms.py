"""Queries on terms, hot-words and corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import terms as T
from lectern.plans.transcripts import sentence_rows
from lectern.sources.tables import table


def _mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.extract_terms(table(spark, sf_dir, "documents").select("lesson", "text"), "text", "lesson")


def term_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency of every mined term by lesson."""
    return _mined(spark, sf_dir).select("term", F.col("source").alias("lesson"), "freq")


def extract_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency of every mined term, and in how many lessons."""
    return T.total_terms(_mined(spark, sf_dir))


def substring_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary entries that no longer entry contains."""
    v = table(spark, sf_dir, "vocab_terms").select(F.lower(F.trim("vocab")).alias("term")).filter("length(term) > 0").distinct()
    return T.drop_contained(v, "term")


def hotwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot-word list: given words, then mined ones."""
    return T.hotwords(extract_terms(spark, sf_dir), table(spark, sf_dir, "hotwords").select("text"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "vocab_terms").select(F.trim("vocab").alias("term")).filter("length(term) > 1").distinct()


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    return T.term_hits(d, "doc_id", "text", _words(spark, sf_dir), "term")


def term_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each vocabulary entry occurs in each document."""
    return _hits(spark, sf_dir)


def term_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many entries each document holds, and how often in all."""
    return _hits(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.sum("hits").cast("long").alias("total"))


def lesson_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 120 hot-words, by name, that occur in each lesson's transcript."""
    from pyspark.sql import Window

    h = table(spark, sf_dir, "hotwords").select(F.trim("text").alias("term")).filter("length(term) > 1").distinct()
    s = sentence_rows(spark, sf_dir).withColumn("sid", F.struct("lesson", "sent_no"))
    got = T.term_hits(s, "sid", "text", h, "term").select("sid.lesson", "term").distinct()
    w = Window.partitionBy("lesson").orderBy("term")
    return got.withColumn("n", F.row_number().over(w).cast("long")).filter("n <= 120")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one word in the vocabulary that differ in case from the first hot-word spelling."""
    good = table(spark, sf_dir, "hotwords").select(F.trim("text").alias("right")).filter("length(right) > 1")
    good = good.groupBy(F.lower("right").alias("low")).agg(F.min("right").alias("right"))
    bad = table(spark, sf_dir, "vocab_terms").select(F.trim("vocab").alias("wrong")).filter("length(wrong) > 1").distinct()
    return bad.join(good, F.lower("wrong") == F.col("low")).filter("wrong <> right").select("wrong", "right")


def _corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sentence_rows(spark, sf_dir).select("lesson", "sent_no", "text")
    return T.apply_corrections(s, ["lesson", "sent_no"], "text", _pairs(spark, sf_dir))


def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence with the correction pairs applied."""
    return _corrected(spark, sf_dir).select("lesson", "sent_no", F.md5(F.encode("corrected", "UTF-8")).alias("text_md5"), F.coalesce(F.col("corrected") != F.col("text"), F.lit(False)).alias("changed"))


def correction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 changed sentences, before and after."""
    c = _corrected(spark, sf_dir).filter("corrected <> text").orderBy("lesson", "sent_no").limit(200)
    return c.select("lesson", "sent_no", F.substring("text", 1, 60).alias("before60"), F.substring("corrected", 1, 60).alias("after60"))


QUERIES = {
    f.__name__: f
    for f in (term_sources, extract_terms, substring_prune, hotwords, term_hits, term_coverage, lesson_terms, apply_corrections, correction_report)
}

_NOISE = ", ".join(f"'{w}'" for w in T.NOISE)
_MINED = f"""tok AS (SELECT lesson, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9+(\\-/@_\\.]{{1,40}}[A-Za-z0-9+\\)]')) AS t FROM documents),
  mined AS (SELECT lower(t) AS term, lesson, count(*) AS freq FROM tok WHERE lower(t) NOT IN ({_NOISE}) AND length(regexp_replace(t, '[^A-Za-z]', '', 'g')) >= 2
    AND NOT (t = lower(t) AND t <> upper(t) AND length(t) <= 4) GROUP BY 1, 2),
  total AS (SELECT term, CAST(sum(freq) AS BIGINT) AS freq, count(lesson) AS n_sources FROM mined GROUP BY term)"""
_HITS = """v AS (SELECT DISTINCT trim(vocab) AS term FROM vocab_terms WHERE length(trim(vocab)) > 1),
  p AS (SELECT term, regexp_matches(term, '^[\\x20-\\x7E]*[A-Za-z0-9][\\x20-\\x7E]*$') AS a, '(?i)(^|[^a-zA-Z0-9])' || regexp_escape(term) || '($|[^a-zA-Z0-9])' AS re FROM v),
  """
_PAIRS = """good AS (SELECT lower(trim(text)) AS low, min(trim(text)) AS "right" FROM hotwords WHERE length(trim(text)) > 1 GROUP BY 1),
  bad AS (SELECT DISTINCT trim(vocab) AS wrong FROM vocab_terms WHERE length(trim(vocab)) > 1),
  pairs AS (SELECT wrong, "right", row_number() OVER (ORDER BY -length(wrong), wrong, "right") AS k FROM bad JOIN good ON lower(wrong) = low WHERE wrong <> "right")"""
_SENT = """sent AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY lesson, sent_no ORDER BY recv_at DESC NULLS LAST) AS rn
  FROM sentences WHERE sent_no IS NOT NULL) WHERE rn = 1)"""
#: \b stands for the look-arounds that RE2 lacks: on texts without underscores and pairs that begin and end with a letter or digit; ideographs count as boundaries there as well.
_FIXED = f"""WITH RECURSIVE {_PAIRS}, {_SENT},
  run AS (SELECT lesson, sent_no, text, replace(text, '_', chr(1)) AS t, CAST(0 AS BIGINT) AS k FROM sent
    UNION ALL
    SELECT lesson, sent_no, text, CASE WHEN regexp_matches(wrong, '^[A-Za-z0-9 .+-]+$') THEN regexp_replace(t, '\\b' || regexp_escape(wrong) || '\\b', "right", 'g') ELSE replace(t, wrong, "right") END, pairs.k
    FROM run JOIN pairs ON pairs.k = run.k + 1),
  fixed AS (SELECT lesson, sent_no, text, replace(t, chr(1), '_') AS corrected FROM run WHERE k = (SELECT max(k) FROM pairs))"""

ORACLE = {
    "term_sources": f"WITH {_MINED} SELECT term, lesson, freq FROM mined",
    "extract_terms": f"WITH {_MINED} SELECT term, freq, n_sources FROM total",
    "substring_prune": """WITH v AS (SELECT DISTINCT lower(trim(vocab)) AS term FROM vocab_terms WHERE length(trim(vocab)) > 0)
      SELECT term FROM v WHERE NOT EXISTS (SELECT 1 FROM v b WHERE contains(b.term, v.term) AND length(b.term) > length(v.term))""",
    "hotwords": f"""WITH {_MINED}, shaped AS (SELECT term, freq FROM total WHERE NOT regexp_matches(term, '[\\[\\](){{}}"''`$;|\\\\=<>#&*!?~^]') AND length(term) BETWEEN 2 AND 25
        AND NOT (regexp_matches(term, '[0-9]') AND length(term) < 5)),
      kept AS (SELECT * FROM shaped s WHERE freq >= 3 AND NOT EXISTS (SELECT 1 FROM shaped b WHERE contains(b.term, s.term) AND length(b.term) > length(s.term))),
      own AS (SELECT lower(trim(text)) AS low, min(trim(text)) AS text FROM hotwords WHERE length(trim(text)) > 0 GROUP BY 1),
      both_ AS (SELECT text, 99 AS freq, 0 AS prio FROM own UNION ALL SELECT term, freq, 1 FROM kept WHERE term NOT IN (SELECT low FROM own))
      SELECT text, CASE WHEN freq >= 50 THEN 4 WHEN freq >= 10 THEN 3 ELSE 2 END AS weight FROM (SELECT * FROM both_ ORDER BY prio, freq DESC, text LIMIT 400)""",
    "correction_report": _FIXED + " SELECT lesson, sent_no, substr(text, 1, 60) AS before60, substr(corrected, 1, 60) AS after60 FROM fixed WHERE corrected <> text ORDER BY lesson, sent_no LIMIT 200",
    "apply_corrections": _FIXED + " SELECT lesson, sent_no, md5(corrected) AS text_md5, coalesce(corrected <> text, false) AS changed FROM fixed",
}
_COUNT = """CASE WHEN a THEN len(regexp_extract_all(replace(text, '_', ' '), '(?i)\\b' || regexp_escape(replace(term, '_', ' ')) || '\\b'))
  ELSE (length(text) - length(replace(text, term, ''))) // length(term) END"""
_HIT_ROWS = "WITH " + _HITS + f"h AS (SELECT doc_id, term, CAST({_COUNT} AS BIGINT) AS hits FROM documents, p WHERE text IS NOT NULL AND contains(lower(text), lower(term)))"
ORACLE["term_hits"] = _HIT_ROWS + " SELECT doc_id, term, hits FROM h WHERE hits > 0"
ORACLE["term_coverage"] = _HIT_ROWS + " SELECT doc_id, count(*) AS n_terms, CAST(sum(hits) AS BIGINT) AS total FROM h WHERE hits > 0 GROUP BY doc_id"
ORACLE["lesson_terms"] = f"""WITH {_SENT}, v AS (SELECT DISTINCT trim(text) AS term FROM hotwords WHERE length(trim(text)) > 1),
  p AS (SELECT term, regexp_matches(term, '^[\\x20-\\x7E]*[A-Za-z0-9][\\x20-\\x7E]*$') AS a FROM v),
  h AS (SELECT DISTINCT lesson, term FROM sent, p WHERE text IS NOT NULL AND contains(lower(text), lower(term)) AND
    CASE WHEN a THEN regexp_matches(replace(text, '_', ' '), '(?i)\\b' || regexp_escape(replace(term, '_', ' ')) || '\\b') ELSE contains(text, term) END)
  SELECT lesson, term, row_number() OVER (PARTITION BY lesson ORDER BY term) AS n FROM h QUALIFY n <= 120"""
