"""Queries of problem 4: covered periods and gaps of three tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import intervals as iv
from lectern.operators.versions import current_rows
from lectern.sources.tables import table


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, lesson, b, e in milliseconds, of segments and of the current index points."""
    seg = table(spark, sf_dir, "segments").select(
        F.lit("segments").alias("src"), "lesson", iv.millis(F.col("start_sec")).alias("b"), iv.millis(F.col("end_sec")).alias("e")
    )
    out = seg
    for name in ("course_subs", "course_outline"):
        cur = current_rows(table(spark, sf_dir, name).select("id", "ingested_at", "lesson", "begin_sec", "end_sec"))
        out = out.unionByName(
            cur.select(F.lit(name).alias("src"), "lesson", iv.millis(F.col("begin_sec")).alias("b"), iv.millis(F.col("end_sec")).alias("e"))
        )
    return out


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.gaps(spans(spark, sf_dir), ["src", "lesson"], "b", "e")


def p4_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.periods(spans(spark, sf_dir), ["src", "lesson"], "b", "e")


QUERIES = {"p4_found": p4_found, "p4_periods": p4_periods}

_SPANS = """
WITH cur AS (
  SELECT 'course_subs' AS src, lesson, begin_sec AS b, end_sec AS e FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM course_subs WHERE id IS NOT NULL) WHERE rn = 1
  UNION ALL
  SELECT 'course_outline', lesson, begin_sec, end_sec FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM course_outline WHERE id IS NOT NULL) WHERE rn = 1
  UNION ALL
  SELECT 'segments', lesson, start_sec, end_sec FROM segments),
ms AS (
  SELECT src, lesson, CAST(round(b * 1000) AS BIGINT) AS b, CAST(round(e * 1000) AS BIGINT) AS e
  FROM cur WHERE b IS NOT NULL AND e IS NOT NULL AND isfinite(b) AND isfinite(e)),
ok AS (SELECT src, lesson, b, e, max(e) OVER (PARTITION BY src, lesson ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ms WHERE e > b)
"""

ORACLE = {
    "p4_found": _SPANS + "SELECT src, lesson, reach AS gap_from_ms, b AS gap_to_ms FROM ok WHERE b > reach",
    "p4_periods": _SPANS
    + """, runs AS (SELECT src, lesson, b, e, sum(CASE WHEN reach IS NULL OR b > reach THEN 1 ELSE 0 END)
            OVER (PARTITION BY src, lesson ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM ok)
    SELECT src, lesson, min(b) AS from_ms, max(e) AS to_ms FROM runs GROUP BY src, lesson, run""",
}
