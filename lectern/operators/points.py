"""Index points of chunks: id, payload, dense vector and sparse weights, written by lesson."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import ids
from lectern.operators import index
from lectern.session import staged
from lectern.sources import sinks
from lectern.sources.providers import hashed_embedding


def points_of(chunks: DataFrame, name: Column, text: str, embed: Callable[[Column], Column] = hashed_embedding, embed_chars: int = 2000) -> DataFrame:
    """``chunks`` with id, dense and sparse (term, weight).

    The id is the version-5 UUID of ``name``: the same chunk has the same id
    whenever it is taken in. ``embed`` gets the first ``embed_chars`` characters,
    as its service takes no more; the sparse weights are those of the whole
    text, under the idf of all chunks. A null or empty text gives a point
    without sparse terms; chunks with a null name are dropped.
    """
    # written once: counted, cut into terms and joined
    rows = staged(chunks.withColumn("id", ids.uuid5_hex(name)).filter("id is not null"), "points")
    tf = index.term_frequencies(rows, "id", text)
    weights = index.weights(tf, index.idf(index.document_terms(rows, "id", text), rows.count()))
    own = weights.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("sparse"))
    none = F.array().cast("array<struct<term:string,weight:double>>")
    return rows.join(own, "id", "left").withColumn("sparse", F.coalesce("sparse", none)).withColumn("dense", embed(F.substring(F.coalesce(F.col(text), F.lit("")), 1, embed_chars)))


def ingest(points: DataFrame, home: str, group: str = "lesson") -> bool:
    """Replace the groups of ``points`` in the table at ``home``, which is made if absent (then True); doing it again changes nothing."""
    made = sinks.create_if_absent(points.sparkSession, home, points.schema)
    sinks.replace_groups(points, home, group)
    return made
