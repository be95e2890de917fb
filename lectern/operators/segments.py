"""Segments of recordings: silence marks, cut planning, bounds, and merging of per-segment transcripts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.ordered import chain, numbered_in, with_last

#: Rows of one bucket of time, in milliseconds.
BUCKET_MS = 3_600_000

ASR_RESULT = T.StructType(
    [
        T.StructField("meta", T.StructType([T.StructField("segment", T.StringType()), T.StructField("no_speech", T.BooleanType())])),
        T.StructField(
            "result",
            T.StructType(
                [
                    T.StructField(
                        "transcripts",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField(
                                        "sentences",
                                        T.ArrayType(
                                            T.StructType(
                                                [
                                                    T.StructField("begin_time", T.LongType()),
                                                    T.StructField("end_time", T.LongType()),
                                                    T.StructField("text", T.StringType()),
                                                ]
                                            )
                                        ),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)


def silence_marks(log: DataFrame, group: str, line: str) -> DataFrame:
    """group, t_ms: midpoints of the silences that the media tool's log lines report, in the log's order within a line.

    A start without an end counts as one second of silence.
    """
    num = r"([0-9]+(?:\.[0-9]+)?)"
    starts = F.regexp_extract_all(line, F.lit(rf"silence_start: {num}"), F.lit(1))
    ends = F.regexp_extract_all(line, F.lit(rf"silence_end: {num}"), F.lit(1))
    pairs = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    x = log.select(group, F.explode(pairs).alias("p")).filter(F.col("p.s").isNotNull())
    s, e = F.col("p.s").cast("double"), F.coalesce(F.col("p.e").cast("double"), F.col("p.s").cast("double") + 1)
    return x.select(group, F.floor((s + e) * 500).cast("long").alias("t_ms"))


def pauses(sentences: DataFrame, group: str, begin_ms: str, end_ms: str) -> DataFrame:
    """group, t_ms: midpoints of the stretches that no sentence covers, as marks for cutting."""
    from lectern.operators.intervals import gaps

    g = gaps(sentences, [group], begin_ms, end_ms)
    return g.select(group, F.floor((F.col("gap_from_ms") + F.col("gap_to_ms")) / 2).cast("long").alias("t_ms"))


def plan_cuts(marks: DataFrame, lengths: DataFrame, group: str, least: int = 840_000, most: int = 1_200_000, aim: int = 900_000) -> DataFrame:
    """group, cut_ms: where to cut recordings of ``lengths`` (group, dur_ms).

    From the last cut on, while more than ``most`` is left: the mark between
    ``least`` and ``most`` after it that is nearest to ``aim`` (the earlier of
    equals), or ``aim`` itself if there is none. Marks beyond the end and null
    marks are ignored; a recording without marks is cut at multiples of
    ``aim``; null lengths give no cuts.
    """
    start = lengths.filter(F.col("dur_ms").isNotNull()).select(group, F.lit(0).cast("long").alias("t_ms"), F.col("dur_ms").cast("long").alias("dur_ms"))
    inner = marks.filter("t_ms > 0").select(group, "t_ms").distinct().join(start.select(group, "dur_ms"), group).filter(F.col("t_ms") < F.col("dur_ms"))
    rows = numbered_in(start.unionByName(inner), group, ["t_ms"], "row")

    def step(pdf: pd.DataFrame) -> np.ndarray:
        t = pdf["t_ms"].to_numpy()
        dur, whole = int(pdf["dur_ms"].iloc[0]), pdf["no"].iloc[-1] >= pdf["_last"].iloc[0]
        out = np.full(len(t), -1)
        for i, at in enumerate(t.tolist()):
            while dur - at > most:
                if at + most > t[-1] and not whole:
                    break
                a, b = np.searchsorted(t, at + least), np.searchsorted(t, at + most, "right")
                if b > a:
                    out[i] = a + np.abs(t[a:b] - (at + aim)).argmin()
                    break
                at += aim
        return out

    steps = chain(rows, group, "row", ["t_ms", "dur_ms"], step)
    # back from rows to times
    at, to = rows.select(group, F.col("row").alias("start"), F.col("t_ms").alias("from_ms"), "dur_ms"), rows.select(group, F.col("row").alias("stop"), F.col("t_ms").alias("to_ms"))
    d = steps.join(at, [group, "start"]).join(to, [group, "stop"], "left")
    # cuts without a mark, on the way to the next mark or to the end
    far = F.coalesce("to_ms", "dur_ms") - F.col("from_ms")
    n = F.greatest(F.lit(0), F.ceil((far - most) / F.lit(aim))).cast("int")
    plain = d.withColumn("k", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array()))).select(group, (F.col("from_ms") + F.col("k") * aim).alias("cut_ms"))
    return plain.unionByName(d.filter("to_ms is not null").select(group, F.col("to_ms").alias("cut_ms")))


def bounds(cuts: DataFrame, lengths: DataFrame, group: str) -> DataFrame:
    """group, seg_no, start_ms, end_ms: the segments between 0, the cuts and the end."""
    ends = lengths.filter("dur_ms > 0").select(group, F.col("dur_ms").cast("long").alias("end_ms")).unionByName(cuts.select(group, F.col("cut_ms").alias("end_ms")))
    w = Window.partitionBy(group).orderBy("end_ms")
    return ends.select(group, (F.row_number().over(w) - 1).alias("seg_no"), F.coalesce(F.lag("end_ms").over(w), F.lit(0).cast("long")).alias("start_ms"), "end_ms")


def segment_of(sentences: DataFrame, segments: DataFrame, group: str) -> DataFrame:
    """``sentences`` (with begin_ms and sent_no) and seg_no, start_ms of the latest segment that begins at or before them.

    Of segments that begin together the one with the greatest number counts.
    """
    s = segments.groupBy(group, F.col("start_ms").alias("t")).agg(F.max("seg_no").alias("seg_no"))
    cols = [c for c in sentences.columns]
    a = sentences.select(*cols, F.col("begin_ms").alias("t"), F.lit(1).alias("side"), F.lit(None).cast("struct<seg_no:int,start_ms:bigint>").alias("seg"))
    b = s.select(
        *[F.col(group) if c == group else F.lit(-1).cast("long").alias("sent_no") if c == "sent_no" else F.lit(None).cast(sentences.schema[c].dataType).alias(c) for c in cols],
        "t", F.lit(0).alias("side"), F.struct(F.col("seg_no").cast("int").alias("seg_no"), F.col("t").cast("long").alias("start_ms")).alias("seg"),
    )
    both = with_last(a.unionByName(b), [group], ["t", "side", "sent_no"], F.floor(F.col("t") / BUCKET_MS), "seg", "in_seg")
    return both.filter("side = 1").select(*cols, F.col("in_seg.seg_no").alias("seg_no"), F.col("in_seg.start_ms").alias("start_ms"))


def segment_name(group: str) -> Column:
    """What a segment's result is named after: group, number and start."""
    return F.concat_ws("-", group, F.col("seg_no").cast("string"), F.col("start_ms").cast("string"))


def no_speech(segments: DataFrame, group: str) -> DataFrame:
    """group, seg_no, start_ms, body: the result document that stands for a segment without speech, so that it isn't tried again."""
    body = F.struct(F.struct(segment_name(group).alias("segment"), F.lit(True).alias("no_speech")).alias("meta"))
    return segments.select(group, "seg_no", "start_ms", F.to_json(body).alias("body"))


def results_as_json(sentences: DataFrame, group: str) -> DataFrame:
    """group, seg_no, start_ms, body: one JSON result document per segment, with times from the segment's start."""
    item = F.struct("sent_no", (F.col("begin_ms") - F.col("start_ms")).alias("begin_time"), (F.col("end_ms") - F.col("start_ms")).alias("end_time"), "text")
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["begin_time"].alias("begin_time"), x["end_time"].alias("end_time"), x["text"].alias("text")))
    g = sentences.groupBy(group, "seg_no", "start_ms").agg(ordered.alias("s"))
    body = F.struct(
        F.struct(segment_name(group).alias("segment"), F.lit(False).alias("no_speech")).alias("meta"),
        F.struct(F.array(F.struct(F.col("s").alias("sentences"))).alias("transcripts")).alias("result"),
    )
    return g.select(group, "seg_no", "start_ms", F.to_json(body).alias("body"))


def results_of(bodies: DataFrame, segments: DataFrame, group: str) -> DataFrame:
    """group, seg_no, start_ms, body: segments with the result document that names them; documents that name none are left out."""
    named = bodies.select(F.col("body"), F.from_json("body", ASR_RESULT)["meta"]["segment"].alias("_name"))
    own = segments.select(group, "seg_no", "start_ms").distinct().withColumn("_name", segment_name(group))
    return own.join(named, "_name").drop("_name")


def merge_results(results: DataFrame, group: str) -> DataFrame:
    """group, seg_no, pos, begin, end, text: sentences of all result documents on the recording's clock.

    Documents that hold no speech, or can't be read, are skipped.
    """
    r = results.select(group, "seg_no", "start_ms", F.from_json("body", ASR_RESULT).alias("r")).filter(~F.coalesce(F.col("r.meta.no_speech"), F.lit(False)))
    s = r.select(group, "seg_no", "start_ms", F.explode("r.result.transcripts").alias("t")).select(group, "seg_no", "start_ms", F.posexplode("t.sentences").alias("pos", "s"))
    sec = lambda c: F.round((F.col("start_ms") + F.col(c)) / 1000, 2)
    return s.select(group, "seg_no", "pos", sec("s.begin_time").alias("begin"), sec("s.end_time").alias("end"), F.col("s.text").alias("text"))
