"""Manifest cohorts and totals, and the catalogue of lessons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import ids, times


def cohorts(manifest: DataFrame, year: int) -> DataFrame:
    """Add ``derived``: the year where the file's UUID time falls on a known day of that year, ``archive`` for another UUID time, else ``unknown``."""
    at = F.timestamp_micros(ids.uuid1_micros(F.col("file")))
    known = (
        manifest.filter(F.col("confidence").isNotNull() & F.col("platform_time").isNotNull())
        .select(F.to_date("platform_time").alias("_day")).distinct()
    )
    m = manifest.withColumn("_at", at)
    return (
        m.join(known, F.to_date("_at") == F.col("_day"), "left")
        .withColumn("derived", F.when(F.col("_at").isNull(), "unknown").when((F.year("_at") == year) & F.col("_day").isNotNull(), str(year)).otherwise("archive"))
        .drop("_at", "_day")
    )


def rollup(manifest: DataFrame) -> DataFrame:
    """cohort, n, seconds, confirmed; one more row for the total."""
    return (
        manifest.select(F.coalesce("cohort", F.lit("unknown")).alias("_c"), "duration_sec", "confidence")
        .rollup("_c")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("duration_sec"), F.lit(0)).cast("long").alias("seconds"),
            F.count_if(F.coalesce(F.col("confidence") == "confirmed", F.lit(False))).alias("confirmed"),
        )
        .select(F.coalesce("_c", F.lit("total")).alias("cohort"), "n", "seconds", "confirmed")
    )


def catalogue(nodes: DataFrame, subs: DataFrame, manifest: DataFrame, shown: int = 6) -> DataFrame:
    """lesson, n_nodes, n_subs, duration, terms: the most frequent terms, first seen first among equals."""
    seen = nodes.select("lesson", "start_sent", F.posexplode("terms").alias("pos", "term")).filter(F.col("term").isNotNull())
    freq = seen.groupBy("lesson", "term").agg(F.count("*").alias("c"), F.min(F.col("start_sent") * 1000 + F.col("pos")).alias("first"))
    w = Window.partitionBy("lesson").orderBy(F.desc("c"), "first", "term")
    best = freq.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= shown)
    top = best.groupBy("lesson").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rk", "term"))), lambda x: x["term"]), ", ").alias("terms")
    )
    g = nodes.groupBy("lesson").agg(F.count("*").alias("n_nodes"))
    s = subs.groupBy("lesson").agg(F.count("*").alias("n_subs"))
    d = manifest.groupBy("lesson").agg(F.max("duration_sec").alias("sec"))
    return (
        g.join(s, "lesson", "full").join(top, "lesson", "left").join(d, "lesson", "left")
        .select(
            "lesson",
            F.coalesce("n_nodes", F.lit(0).cast("long")).alias("n_nodes"),
            F.coalesce("n_subs", F.lit(0).cast("long")).alias("n_subs"),
            times.duration_text(F.col("sec")).alias("duration"),
            F.coalesce("terms", F.lit("—")).alias("terms"),
        )
    )


def select_recordings(manifest: DataFrame, cohort: str, all_of: tuple[str, ...] = ("2026", "archive")) -> DataFrame:
    """Recordings of a cohort (``all``: of every one in ``all_of``) that have a lesson number."""
    wanted = list(all_of) if cohort == "all" else [cohort]
    return manifest.filter(F.col("cohort").isin(wanted) & F.col("lesson_no").isNotNull())


def first_with_prefix(rows: DataFrame, text: str, order: list, prefixes: DataFrame, prefix: str) -> DataFrame:
    """``prefix`` and the columns of its first row, by ``order``, whose ``text`` begins with it; prefixes without one are left out.

    Each text's beginnings, of the lengths that occur, meet the prefixes by equality. Empty and null prefixes match nothing.
    """
    p = prefixes.select(F.col(prefix).alias("_p")).filter(F.length("_p") > 0).distinct()
    lengths = p.select(F.length("_p").alias("_n")).distinct()
    heads = rows.join(F.broadcast(lengths), F.length(text) >= F.col("_n")).withColumn("_p", F.expr(f"left(`{text}`, _n)"))
    w = Window.partitionBy("_p").orderBy(*order)
    return heads.join(p, "_p").withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(F.col("_p").alias(prefix), *rows.columns)


def first_prefix_or_equal(names: DataFrame, name: str, entries: DataFrame, no: str, equal: str, order: list) -> DataFrame:
    """``name`` and the columns of the first of ``entries``, by ``order``, whose ``no`` the name begins with, or whose ``equal`` it is.

    An entry without ``no`` (null or empty) matches by ``equal`` alone; names without an entry are left out.
    """
    n = names.select(F.col(name).alias("_name")).filter("_name is not null").distinct()
    heads = n.select("_name", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_name"), F.lit(1))), lambda i: F.left("_name", i))).alias("_no")).filter(F.length("_no") > 0).distinct()
    both = heads.join(entries, F.col("_no") == F.col(no)).drop("_no").unionByName(n.join(entries, F.col("_name") == F.col(equal)))
    w = Window.partitionBy("_name").orderBy(*order)
    return both.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(F.col("_name").alias(name), *entries.columns)
