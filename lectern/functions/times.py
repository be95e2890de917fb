"""Durations as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_seconds(mmss: Column) -> Column:
    """Seconds of ``MM:SS``; null for any other text."""
    p = F.split(mmss, ":")
    return F.when(mmss.rlike("^[0-9]+:[0-9]+$"), p[0].cast("int") * 60 + p[1].cast("int"))


def hours_minutes(seconds: Column) -> Column:
    """``h:mm``."""
    s = F.floor(seconds).cast("long")
    return F.concat(F.floor(s / 3600).cast("string"), F.lit(":"), F.lpad(F.floor(s % 3600 / 60).cast("string"), 2, "0"))


def duration_text(seconds: Column) -> Column:
    """``XhMMm``, or ``?`` for null and 0."""
    s = F.coalesce(seconds.cast("long"), F.lit(0).cast("long"))
    text = F.concat(F.floor(s / 3600).cast("string"), F.lit("h"), F.lpad(F.floor(s % 3600 / 60).cast("string"), 2, "0"), F.lit("m"))
    return F.when(s == 0, "?").otherwise(text)
