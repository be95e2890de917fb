"""Frequency of every distinct term: heavy-light aggregation.

Terms are the maximal runs of letters and digits (Unicode L and N) outside
U+4E00-U+9FFF, and in a maximal run of U+4E00-U+9FFF every pair of neighbours
(a run of one gives that one), of the lower-cased text.

Heavy terms are detected on a slice of the records and broadcast: a bounded
list, see ``max_heavy``. Every task counts them exactly in local counter
arrays, and hands in one row with these arrays: positions, not terms. The
arrays are added up position by position into the table of heavy terms. Only the
remaining terms go through the shuffle by term, pre-combined per task, into the
table of light terms. The two tables are united; no term is in both. The slice
only decides which path a term takes; all counts are exact and over all records.

Defined cases: a null text is no record; an empty text is a record without
terms; entries of the vocabulary are freed of outer white space and
lower-cased, blank and null ones left out; a listed term without occurrence
counts 0; an empty table gives just the listed terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import terms_of
from lectern.session import staged

#: A light term (n, records), or a task's counter arrays of heavy terms and its number of texts.
PARTS = "term string, n long, records long, heavy_n array<long>, heavy_records array<long>, texts long"
_ARROW = pa.schema(
    [("term", pa.string()), ("n", pa.int64()), ("records", pa.int64()), ("heavy_n", pa.list_(pa.int64())), ("heavy_records", pa.list_(pa.int64())), ("texts", pa.int64())]
)


def heavy_terms(slice_of_records: DataFrame, share: float = 0.02, max_heavy: int = 4096) -> list[str]:
    """Terms held by more than ``share`` of these records (column ``text``); at most ``max_heavy``."""
    # one row for the slice's size (the null term), the rest its terms
    terms = F.array_append(F.array_distinct(terms_of(F.col("text"))), F.lit(None).cast("string"))
    rows = slice_of_records.filter("text is not null").select(F.explode(terms).alias("term")).groupBy("term").count().orderBy(F.desc("count"), "term").limit(max_heavy + 1).collect()
    n = max((r["count"] for r in rows if r["term"] is None), default=0)
    return [r["term"] for r in rows if r["term"] is not None and r["count"] > max(1, share * n)][:max_heavy]


def _counter(heavy: list[str], flush_at: int):
    slots = {t: i for i, t in enumerate(heavy)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(slots), np.int64)
        held = np.zeros(len(slots), np.int64)
        texts = 0
        light: dict[str, list[int]] = {}

        def flush():
            keys, m = list(light), len(light)
            nothing = pa.nulls(m, pa.list_(pa.int64()))
            out = [pa.array(keys, pa.string()), pa.array([light[k][0] for k in keys], pa.int64()), pa.array([light[k][1] for k in keys], pa.int64()), nothing, nothing, pa.nulls(m, pa.int64())]
            light.clear()
            return pa.record_batch(out, schema=_ARROW)

        for batch in batches:
            lists = batch.column(0)
            texts += len(lists)
            enc = lists.flatten().dictionary_encode()
            words, codes = enc.dictionary.to_pylist(), enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            if not words:
                continue
            lens = np.diff(lists.offsets.to_numpy())
            rec = np.repeat(np.arange(len(lens), dtype=np.int64), lens)
            occ = np.bincount(codes, minlength=len(words))
            per = np.bincount(np.unique(rec * len(words) + codes) % len(words), minlength=len(words))
            for w, a, b in zip(words, occ.tolist(), per.tolist()):
                i = slots.get(w)
                if i is not None:
                    n[i] += a
                    held[i] += b
                elif w in light:
                    light[w][0] += a
                    light[w][1] += b
                else:
                    light[w] = [a, b]
            if len(light) > flush_at:
                yield flush()
        if light:
            yield flush()
        if texts:
            yield pa.record_batch([pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), [n.tolist()], [held.tolist()], [texts]], schema=_ARROW)

    return run


def term_counts(records: DataFrame, vocab: DataFrame | None = None, detect_on: DataFrame | None = None, flush_at: int = 200_000, **detect) -> tuple[DataFrame, int]:
    """(term, n (occurrences), records (that hold it), listed (is an entry of ``vocab``)), and the number of records.

    ``records`` has one column ``text``; ``vocab`` one column ``vocab``. Heavy
    terms are detected on ``detect_on``, a part of the records; on all without it.
    """
    texts = records.select("text").filter(F.col("text").isNotNull())
    heavy = heavy_terms(detect_on if detect_on is not None else texts, **detect)
    parts = staged(texts.select(terms_of(F.col("text")).alias("terms")).mapInArrow(_counter(heavy, flush_at), PARTS), "term-parts")
    n_records = parts.agg(F.coalesce(F.sum("texts"), F.lit(0)).alias("n")).first()["n"]
    spark = records.sparkSession
    zero, no = F.lit(0).cast("long"), F.lit(False)
    light = parts.filter("term is not null").select("term", "n", "records", no.alias("listed"))
    # the heavy table: arrays added up by position
    slots = parts.filter("texts is not null").select(F.posexplode(F.arrays_zip("heavy_n", "heavy_records")).alias("slot", "c"))
    sums = slots.groupBy("slot").agg(F.sum("c.heavy_n").alias("n"), F.sum("c.heavy_records").alias("records"))
    names = F.broadcast(spark.createDataFrame(list(enumerate(heavy)), "slot int, term string"))  # at most max_heavy rows
    heavies = sums.join(names, "slot").select("term", "n", "records")
    if vocab is None:
        heavies = heavies.withColumn("listed", no)
    else:
        clean = F.lower(F.regexp_replace(F.col("vocab"), r"(?U)^\s+|\s+$", ""))
        listed = vocab.select(clean.alias("term")).filter(F.length("term") > 0).distinct()
        all_names = names.select("term")
        heavies = heavies.join(listed.select("term", F.lit(True).alias("listed")), "term", "left").withColumn("listed", F.coalesce("listed", no))
        light = light.unionByName(listed.join(all_names, "term", "left_anti").select("term", zero.alias("n"), zero.alias("records"), F.lit(True).alias("listed")))
    light = light.groupBy("term").agg(F.sum("n").alias("n"), F.sum("records").alias("records"), F.max("listed").alias("listed"))
    # a term of the slice may be in no current record
    return light.unionByName(heavies.filter("records > 0 or listed")), n_records


def marked(counts: DataFrame, n_records: int, rare: int = 2, common_over: int = 5) -> DataFrame:
    """Add ``mark``: ``rare`` for at most ``rare`` records, else ``common`` for more than one in ``common_over``, else null."""
    return counts.withColumn(
        "mark",
        F.when(F.col("records") <= rare, "rare").when(F.col("records") * common_over > n_records, "common"),
    )
