"""Index and search queries over the current points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import index, search
from lectern.operators.versions import current_rows
from lectern.session import scratch, staged
from lectern.sources.tables import table

COLLS = ("course_subs", "course_outline")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "course_subs").select("id", "ingested_at", "text")).filter("text is not null")


def _outline_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every outline node is a record; its text is title and terms."""
    o = current_rows(table(spark, sf_dir, "course_outline").select("id", "ingested_at", "node_title", "terms"))
    return o.select("id", F.concat_ws(" ", "node_title", "terms").alias("text"))


def _index(spark: SparkSession, sf_dir: str, coll: str = "course_subs") -> tuple[DataFrame, DataFrame, DataFrame]:
    # written once: counted, cut into terms and asked from
    docs = staged(_texts(spark, sf_dir) if coll == "course_subs" else _outline_texts(spark, sf_dir), "index-texts")
    tf = index.term_frequencies(docs, "id", "text")
    return docs, tf, index.idf(tf, docs.count())


def vocab_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary: place, document frequency and inverse document frequency of every term."""
    return index.vocabulary(_index(spark, sf_dir)[2]).select("term", "idx", "df", F.round("idf", 4).alias("idf"))


def sparse_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weight of every term of every point."""
    _, tf, idfs = _index(spark, sf_dir)
    return index.weights(tf, idfs).select("id", "term", "weight")


def vocab_idf_of_colls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabularies of both collections, each with its own places and frequencies."""
    parts = [index.vocabulary(_index(spark, sf_dir, c)[2]).select(F.lit(c).alias("coll"), "term", "idx", "df", F.round("idf", 4).alias("idf")) for c in COLLS]
    return parts[0].unionByName(parts[1])


def sparse_weights_of_colls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weight of every term of every point of both collections."""
    parts = []
    for c in COLLS:
        _, tf, idfs = _index(spark, sf_dir, c)
        parts.append(index.weights(tf, idfs).select(F.lit(c).alias("coll"), "id", "term", "weight"))
    return parts[0].unionByName(parts[1])


def _sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staged(_texts(spark, sf_dir), "index-texts")
    asked = index.term_frequencies(docs.filter("length(text) > 0").orderBy("id").limit(1), "id", "text").select("term", "tf")
    tf = index.frequencies_of(docs, "id", "text", asked)
    idfs = index.idf(tf, docs.count())
    return search.sparse_scores(index.weights(tf, idfs), "id", asked, idfs)


def sparse_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 points that best match the text of the first point."""
    return search.top(_sparse(spark, sf_dir), "id", 25)


def stored_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an index that was saved before: only the stored weights of the query's terms are read."""
    home = scratch(spark, "index")
    docs = staged(_texts(spark, sf_dir), "index-texts")
    index.save(docs, "id", "text", home)
    idfs, weights = index.load(spark, home)
    asked = index.term_frequencies(docs.filter("length(text) > 0").orderBy("id").limit(1), "id", "text").select("term", "tf")
    return search.top(search.sparse_scores(weights, "id", asked, idfs), "id", 25)


def _usable(df: DataFrame) -> DataFrame:
    return df.filter((F.size("dense") == 1024) & F.exists("dense", lambda x: x != 0))


def _query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector of the first point whose current one is usable: found by narrow columns, then read."""
    rows = table(spark, sf_dir, "course_subs").select("id", "ingested_at", "dense")
    flags = rows.select("id", "ingested_at", ((F.size("dense") == 1024) & F.exists("dense", lambda x: x != 0)).alias("usable"))
    first = current_rows(flags).filter("usable").agg(F.min("id")).first()[0]
    return current_rows(rows.filter(F.col("id") == first)).first()["dense"]


def _dense(spark: SparkSession, sf_dir: str, coll: str) -> DataFrame:
    rows = table(spark, sf_dir, coll).select("id", "ingested_at", "dense")
    # cosines first, then the current rows among narrow ones
    return current_rows(search.with_cosine(rows, "dense", _query_vector(spark, sf_dir))).filter("score is not null").select("id", "score")


def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 sub-chunks nearest to the first usable vector."""
    return search.top(_dense(spark, sf_dir, "course_subs"), "id", 25)


def outline_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four outline nodes nearest to it."""
    return search.top(_dense(spark, sf_dir, "course_outline"), "id", 4)


def rrf_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense and sparse lists of 25, fused by reciprocal rank, six best."""
    a = search.ranked(_dense(spark, sf_dir, "course_subs"), "id", 25)
    b = search.ranked(_sparse(spark, sf_dir), "id", 25)
    return search.fuse([a, b], "id", 6)


def _query_points(spark: SparkSession, sf_dir: str, column: str, broadcast_rows: int = 200_000) -> DataFrame:
    """Every twentieth sub-chunk of a lesson, by its number: found by narrow columns, then read."""
    rows = table(spark, sf_dir, "course_subs").select("id", "ingested_at", column)
    narrow = current_rows(table(spark, sf_dir, "course_subs").select("id", "ingested_at", "block_id")).filter("block_id % 20 = 0")
    asked = staged(narrow.select(F.col("id").alias("_id"), F.col("ingested_at").alias("_at")), "query-points")
    if asked.count() <= broadcast_rows:
        asked = F.broadcast(asked)
    # exact repeats of a current row are alike
    return rows.join(asked, (F.col("id") == F.col("_id")) & F.col("ingested_at").eqNullSafe(F.col("_at")), "left_semi").select("id", column).dropDuplicates(["id"])


def _sparse_of_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staged(_texts(spark, sf_dir), "index-texts")
    idfs = index.idf(index.document_terms(docs, "id", "text"), docs.count())
    asked = staged(_query_points(spark, sf_dir, "text").withColumnRenamed("id", "query"), "query-texts")
    return search.sparse_top_k(docs, "id", "text", asked, "query", idfs, 25)


def _dense_of_queries(spark: SparkSession, sf_dir: str, coll: str, k: int) -> DataFrame:
    points = table(spark, sf_dir, coll).select("id", "ingested_at", "dense").filter("id is not null")
    asked = staged(_usable(_query_points(spark, sf_dir, "dense")), "query-vectors")
    got = search.exact_top_k(points, F.lit(False), "id", "dense", k, queries=asked, dim=1024, version="ingested_at")
    return got.select(F.col("key").alias("query"), F.col("near").alias("id"), "score", "rank")


def sparse_search_of_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 points that best match the text, for every point whose block_id is divisible by 20."""
    return _sparse_of_queries(spark, sf_dir).select("query", "id", "score")


def dense_topk_of_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 sub-chunks nearest to each of these points."""
    return _dense_of_queries(spark, sf_dir, "course_subs", 25).select("query", "id", "score")


def outline_topk_of_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four outline nodes nearest to each of them."""
    return _dense_of_queries(spark, sf_dir, "course_outline", 4).select("query", "id", "score")


def rrf_hybrid_of_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense and sparse lists of 25 of each of them, fused by reciprocal rank, six best."""
    lists = [_dense_of_queries(spark, sf_dir, "course_subs", 25), _sparse_of_queries(spark, sf_dir)]
    return search.fuse_of_queries(lists, "query", "id", 6).select("query", "id", "score")


def dense_top_of_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every embedding whose id is divisible by 20, against all."""
    e = table(spark, sf_dir, "embeddings")
    got = search.exact_top_k(e, F.col("vec_id") % 20 == 0, "vec_id", "embedding", 10)
    return got.select(F.col("key").cast("long").alias("vec_id"), F.col("near").cast("long").alias("near"), "score")


QUERIES = {
    f.__name__: f for f in (vocab_idf, sparse_weights, sparse_search, stored_search, dense_topk, outline_topk, rrf_hybrid, dense_top_of_queries)
} | {f.__name__: f for f in (sparse_search_of_queries, dense_topk_of_queries, outline_topk_of_queries, rrf_hybrid_of_queries, vocab_idf_of_colls, sparse_weights_of_colls)}

_CUR = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn FROM {0} WHERE id IS NOT NULL) WHERE rn = 1"
INDEX_SQL = f"""WITH rec AS (SELECT id, lower(text) AS t FROM ({_CUR.format('course_subs')}) WHERE text IS NOT NULL),
  runs AS (SELECT id, unnest(regexp_extract_all(regexp_replace(t, '([\\x{{4E00}}-\\x{{9FFF}}]+)', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}]+')) AS r FROM rec),
  occ AS (SELECT id, r AS term FROM runs WHERE NOT regexp_matches(r, '^[\\x{{4E00}}-\\x{{9FFF}}]') OR length(r) = 1
    UNION ALL SELECT id, unnest(list_transform(range(1, length(r)), lambda i: substr(r, i, 2))) FROM runs WHERE regexp_matches(r, '^[\\x{{4E00}}-\\x{{9FFF}}]') AND length(r) > 1),
  tf AS (SELECT id, term, count(*) AS tf FROM occ GROUP BY 1, 2),
  idf AS (SELECT term, count(*) AS df, ln(1 + ((SELECT count(*) FROM rec) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM tf GROUP BY term),
  w AS (SELECT id, term, round(idf * (1 + ln(tf)), 4) AS weight FROM tf JOIN idf USING (term)),
  q AS (SELECT term, idf * (1 + ln(tf)) AS q FROM tf JOIN idf USING (term) WHERE id = (SELECT min(id) FROM rec WHERE length(t) > 0)),
  sp AS (SELECT id, round(sum(q * weight), 4) AS score FROM w JOIN q USING (term) GROUP BY id),
  cs AS ({_CUR.format('course_subs')}), co AS ({_CUR.format('course_outline')}),
  us AS (SELECT id, CAST(dense AS DOUBLE[]) AS v FROM cs WHERE len(dense) = 1024 AND len(list_filter(dense, lambda x: x <> 0)) > 0),
  uo AS (SELECT id, CAST(dense AS DOUBLE[]) AS v FROM co WHERE len(dense) = 1024 AND len(list_filter(dense, lambda x: x <> 0)) > 0),
  qv AS (SELECT v AS qv FROM us ORDER BY id LIMIT 1),
  ds AS (SELECT id, round(list_cosine_similarity(v, qv), 5) AS score FROM us, qv),
  dl AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (SELECT * FROM ds ORDER BY score DESC, id LIMIT 25)),
  sl AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (SELECT * FROM sp ORDER BY score DESC, id LIMIT 25))
"""

ORACLE = {
    "vocab_idf": INDEX_SQL + "SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df, round(idf, 4) AS idf FROM idf",
    "sparse_weights": INDEX_SQL + "SELECT id, term, weight FROM w",
    "sparse_search": INDEX_SQL + "SELECT id, score FROM sp ORDER BY score DESC, id LIMIT 25",
    "stored_search": INDEX_SQL + "SELECT id, score FROM sp ORDER BY score DESC, id LIMIT 25",
    "dense_topk": INDEX_SQL + "SELECT id, score FROM ds ORDER BY score DESC, id LIMIT 25",
    "outline_topk": INDEX_SQL + "SELECT id, round(list_cosine_similarity(v, qv), 5) AS score FROM uo, qv ORDER BY score DESC, id LIMIT 4",
    "rrf_hybrid": INDEX_SQL + "SELECT id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT * FROM dl UNION ALL SELECT * FROM sl) GROUP BY id ORDER BY score DESC, id LIMIT 6",
    "dense_top_of_queries": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
      p AS (SELECT a.vec_id, b.vec_id AS near, round(list_cosine_similarity(a.v, b.v), 5) AS score FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
      SELECT vec_id, near, score FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, CAST(near AS VARCHAR)) <= 10""",
}

_OF_QUERIES = INDEX_SQL + """, asked AS (SELECT id AS query FROM cs WHERE block_id % 20 = 0),
  sqs AS (SELECT query, w.id, round(sum(idf * (1 + ln(tf)) * weight), 4) AS score FROM asked JOIN tf ON tf.id = query JOIN idf USING (term) JOIN w USING (term) GROUP BY 1, 2),
  sqt AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM sqs QUALIFY rank <= 25),
  dq AS (SELECT query, v AS qv FROM asked JOIN us ON us.id = query),
  dqt AS (SELECT query, id, round(list_cosine_similarity(v, qv), 5) AS score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM us, dq QUALIFY rank <= 25),
  oqt AS (SELECT query, id, round(list_cosine_similarity(v, qv), 5) AS score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM uo, dq QUALIFY rank <= 4),
  fused AS (SELECT query, id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT query, id, rank FROM dqt UNION ALL SELECT query, id, rank FROM sqt) GROUP BY 1, 2)
"""

ORACLE |= {
    "sparse_search_of_queries": _OF_QUERIES + "SELECT query, id, score FROM sqt",
    "dense_topk_of_queries": _OF_QUERIES + "SELECT query, id, score FROM dqt",
    "outline_topk_of_queries": _OF_QUERIES + "SELECT query, id, score FROM oqt",
    "rrf_hybrid_of_queries": _OF_QUERIES + "SELECT query, id, score FROM fused QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, id) <= 6",
}

_OUTLINE_INDEX = INDEX_SQL + """, orec AS (SELECT id, lower(concat_ws(' ', node_title, array_to_string(terms, ' '))) AS t FROM co),
  oruns AS (SELECT id, unnest(regexp_extract_all(regexp_replace(t, '([\\x{4E00}-\\x{9FFF}]+)', ' \\1 ', 'g'), '[\\p{L}\\p{N}]+')) AS r FROM orec),
  oocc AS (SELECT id, r AS term FROM oruns WHERE NOT regexp_matches(r, '^[\\x{4E00}-\\x{9FFF}]') OR length(r) = 1
    UNION ALL SELECT id, unnest(list_transform(range(1, length(r)), lambda i: substr(r, i, 2))) FROM oruns WHERE regexp_matches(r, '^[\\x{4E00}-\\x{9FFF}]') AND length(r) > 1),
  otf AS (SELECT id, term, count(*) AS tf FROM oocc GROUP BY 1, 2),
  oidf AS (SELECT term, count(*) AS df, ln(1 + ((SELECT count(*) FROM orec) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM otf GROUP BY term)
"""

ORACLE |= {
    "vocab_idf_of_colls": _OUTLINE_INDEX
    + """SELECT 'course_subs' AS coll, term, row_number() OVER (ORDER BY term) - 1 AS idx, df, round(idf, 4) AS idf FROM idf
      UNION ALL SELECT 'course_outline', term, row_number() OVER (ORDER BY term) - 1, df, round(idf, 4) FROM oidf""",
    "sparse_weights_of_colls": _OUTLINE_INDEX
    + """SELECT 'course_subs' AS coll, id, term, weight FROM w
      UNION ALL SELECT 'course_outline', id, term, round(idf * (1 + ln(tf)), 4) FROM otf JOIN oidf USING (term)""",
}
