"""Term mining, hot-words, hits of terms in texts, and guarded correction."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators.ordered import numbered, numbered_in
from lectern.session import staged

# Words that are no terms.
NOISE = [
    "the", "and", "for", "with", "from", "this", "that", "www", "http", "https", "com", "cn", "org", "pdf", "png", "jpg",
    "import", "def", "class", "return", "self", "print", "true", "false", "none", "int", "float", "str", "list", "dict", "len", "range",
    "input", "output", "step", "case", "new", "api", "ai", "llm", "it", "of", "in", "on", "to", "is", "as", "by", "we",
    "ok", "no", "yes", "vs", "etc", "eg", "ie",
]


def extract_terms(df: DataFrame, text: str, source: str, noise: list[str] = NOISE) -> DataFrame:
    """term, source, freq: counts of term candidates by lower-cased form. Null texts give none."""
    tok = df.select(F.col(source).alias("source"), F.explode(X.candidates_of(F.col(text))).alias("tok"))
    ok = tok.filter(X.is_term_shape(F.col("tok")) & ~F.lower("tok").isin(noise))
    return ok.groupBy(F.lower("tok").alias("term"), "source").agg(F.count("*").alias("freq"))


def total_terms(by_source: DataFrame) -> DataFrame:
    """term, freq, n_sources."""
    return by_source.groupBy("term").agg(F.sum("freq").cast("long").alias("freq"), F.count("source").alias("n_sources"))


def drop_contained(terms: DataFrame, term: str) -> DataFrame:
    """Rows whose term is no proper substring of another row's term.

    Every proper substring of a term is formed and anti-joined by equality, so
    the work is in proportion to the terms' squared lengths, not to pairs.
    """
    t = F.col("_t")
    subs = terms.select(F.col(term).alias("_t")).distinct().filter(F.length(t) > 1)
    at = F.sequence(F.lit(1), F.length(t))
    grams = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.length(t) - i + 1), lambda n: t.substr(i, n))))
    inner = subs.select(F.explode(F.array_distinct(grams)).alias("_s"), t).filter("_s <> _t").select("_s").distinct()
    return terms.join(inner, F.col(term) == F.col("_s"), "left_anti")


def hotwords(terms: DataFrame, curated: DataFrame, cap: int = 400, least: int = 3) -> DataFrame:
    """text, weight: curated words first, then mined ones by frequency; case-insensitive, ``cap`` in all.

    ``terms``: term, freq; ``curated``: text. Weight 4 from frequency 50 on
    and for curated ones, 3 from 10 on, else 2.
    """
    shaped = terms.filter(X.is_hotword_shape(F.col("term")))
    mined = drop_contained(shaped, "term").filter(F.col("freq") >= least)
    word = F.trim("text")
    own = curated.select(word.alias("text")).filter(F.length("text") > 0).groupBy(F.lower("text").alias("low")).agg(F.min("text").alias("text"))
    rest = mined.select(F.lower("term").alias("low"), F.col("term").alias("text"), "freq").join(own.select("low"), "low", "left_anti")
    both = own.select("text", F.lit(99).cast("long").alias("freq"), F.lit(0).alias("prio")).unionByName(rest.select("text", "freq", F.lit(1).alias("prio")))
    best = both.orderBy("prio", F.desc("freq"), "text").limit(cap)
    weight = F.when(F.col("freq") >= 50, 4).when(F.col("freq") >= 10, 3).otherwise(2)
    return best.select("text", weight.alias("weight"))


def _keys(text, words: bool):
    """What a text is looked up by: its ASCII words, or its pairs of neighbouring characters."""
    if words:
        return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(..))"), F.lit(1)))


def _with_key(texts: DataFrame, keys: list[str], words: bool) -> DataFrame:
    """keys, k: what each text is looked up by; the text itself stays behind."""
    return texts.select(*keys, F.explode(_keys(F.col("_text"), words)).alias("k"))


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, null keys included."""
    names = {k: f"_r{i}" for i, k in enumerate(keys)}
    r = right.withColumnsRenamed(names)
    on = [left[k].eqNullSafe(r[n]) for k, n in names.items()]
    return left.join(r, on, how).drop(*names.values())


def term_hits(df: DataFrame, key: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """key, term, hits: how often each term occurs in each text, where it does.

    ASCII terms count where no ASCII letter or digit touches them, whatever
    their case; others count literally. Keys of texts and terms meet by equality
    of a word (or of two characters); each text then gets the terms that it may
    hold, and these are counted in it exactly. Terms of one character that is
    not an ASCII letter or digit are left out. Null texts hold none; each row of
    a repeated key is counted for itself.
    """
    t = terms.select(F.col(term).alias("term")).distinct().filter(F.length("term") > 0)
    ascii_ = lambda c: c.rlike(r"^[\x20-\x7E]*[A-Za-z0-9][\x20-\x7E]*$")
    src = df.select(F.col(key).alias("key"), F.col(text).alias("_text")).filter(F.length("_text") > 0)
    words = t.filter(ascii_(F.col("term"))).withColumn("k", F.element_at(_keys(F.col("term"), True), 1))
    chars = t.filter(~ascii_(F.col("term")) & (F.length("term") > 1)).withColumn("k", F.substring("term", 1, 2))
    near = _with_key(src, ["key"], True).join(words, "k").unionByName(_with_key(src, ["key"], False).join(chars, "k"))
    may = near.groupBy("key").agg(F.collect_set("term").alias("_may"))

    def count(term: Column) -> Column:
        at = F.concat(F.lit("(?i)(?<![A-Za-z0-9])"), X.quoted(term), F.lit("(?![A-Za-z0-9])"))
        return F.when(ascii_(term), F.regexp_count("_text", at).cast("long")).otherwise(X.literal_count(F.col("_text"), term))

    counted = F.filter(F.transform("_may", lambda x: F.struct(x.alias("term"), count(x).alias("hits"))), lambda h: h["hits"] > 0)
    hits = _same(src, may, ["key"], "inner").select("key", F.explode(counted).alias("h"))
    return hits.select(F.col("key").alias(key), F.col("h.term").alias(term), "h.hits")


def apply_corrections(df: DataFrame, keys: list[str], text: str, pairs: DataFrame, chunk: int = 2000) -> DataFrame:
    """``df`` and corrected: correction pairs (wrong, right) applied in order of length, longest first.

    A ``wrong`` of ASCII letters, digits, blank, dot, plus and hyphen is
    replaced only where no ASCII letter or digit touches it; any other by plain
    replacement; a single ideograph, an empty ``wrong`` and pairs that change
    nothing never. ``right`` is literal. Each replacement sees what those before
    it left; equal lengths go by ``wrong``, then ``right``.

    Pairs are numbered in their order and applied ``chunk`` by chunk. Texts in
    which a pair of the chunk occurs are found by equality of a word or of two
    characters; they alone are folded over the chunk's pairs (no other text can
    change, as the first replacement in it would need such an occurrence).
    ``keys`` identify a row. Null texts stay null.
    """
    p = pairs.select("wrong", "right").filter("length(wrong) > 0 and right is not null and wrong <> right").distinct()
    p = p.filter(~F.col("wrong").rlike("^[一-鿿]$"))
    p = numbered(p, [F.length("wrong").desc(), F.col("wrong"), F.col("right")], "n", 0)
    out = df.withColumn("corrected", F.col(text))
    total = p.count()
    for at in range(0, total, chunk):
        part = p.filter(F.col("n").between(at, at + chunk - 1))
        rows = [(r["wrong"], r["right"]) for r in part.orderBy("n").select("wrong", "right").collect()]
        todo = F.from_json(F.lit(json.dumps([{"w": w, "r": r} for w, r in rows])), "array<struct<w:string,r:string>>")
        fixed = F.aggregate(todo, F.col("corrected"), lambda acc, x: F.when(F.contains(acc, x["w"]), X.replace_guarded(acc, x["w"], x["r"])).otherwise(acc))
        src = out.select(*keys, F.col("corrected").alias("_text")).filter(F.col("_text").isNotNull())
        near = _with_key(src, keys, True).unionByName(_with_key(src, keys, False))
        lone = part.filter(F.length("wrong") == 1).select(F.col("wrong").alias("k"))
        # a single character that isn't a word of its own is looked up as such
        one = src.select(*keys, F.explode(F.array_distinct(F.split("_text", ""))).alias("k"))
        hit = near.join(_pair_keys(part).select("k").distinct(), "k", "left_semi").unionByName(one.join(lone, "k", "left_semi"))
        marked = _same(out, hit.select(*keys).distinct().withColumn("_hit", F.lit(True)), keys, "left")
        out = marked.withColumn("corrected", F.when(F.col("_hit"), fixed).otherwise(F.col("corrected"))).drop("_hit")
        if at + chunk < total:
            out = staged(out, "corrected")
    return out


def _pair_keys(p: DataFrame) -> DataFrame:
    word = F.element_at(_keys(F.col("wrong"), True), 1)
    has = F.size(_keys(F.col("wrong"), True)) > 0
    ascii_ = F.col("wrong").rlike(r"^[A-Za-z0-9 .+\-]+$") & has
    return p.withColumn("k", F.when(ascii_, word).otherwise(F.substring("wrong", 1, 2))).filter(F.length("k") > 0)


def apply_in_blocks(df: DataFrame, group: str, order: str, text: str, pairs: DataFrame, rows: int = 50) -> DataFrame:
    """``df`` with block and corrected: a pair counts only in the blocks of ``rows`` consecutive texts of a group that hold its ``wrong``.

    Order and guards are those of ``apply_corrections``. Null texts stay null. ``order`` is unique in a group.
    """
    src = numbered_in(df, group, [order], "_row", 0).withColumn("block", F.floor(F.col("_row") / rows).cast("long"))
    p = pairs.select("wrong", "right").filter("length(wrong) > 0 and right is not null and wrong <> right").distinct()
    p = numbered(p.filter(~F.col("wrong").rlike("^[一-鿿]$")), [F.length("wrong").desc(), F.col("wrong"), F.col("right")], "n", 0)
    texts = src.select(group, "block", F.col(text).alias("_text")).filter("_text is not null")
    keys = F.array_distinct(F.concat(_keys(F.col("_text"), True), _keys(F.col("_text"), False), F.split("_text", "")))
    # blocks and pairs meet by key; a block then looks for the pairs that it may hold
    near = texts.select(group, "block", F.explode(keys).alias("k")).distinct()
    own = _pair_keys(p).unionByName(p.filter("length(wrong) = 1").withColumn("k", F.col("wrong"))).distinct()
    may = near.join(own, "k").groupBy(group, "block").agg(F.sort_array(F.collect_set(F.struct("n", "wrong", "right"))).alias("may"))
    held = _same(texts, may, [group, "block"], "inner").select(group, "block", F.explode(F.filter("may", lambda x: F.contains("_text", x["wrong"]))).alias("x"))
    todo = held.groupBy(group, "block").agg(F.sort_array(F.collect_set("x")).alias("_todo"))
    fold = F.aggregate("_todo", F.col(text), lambda acc, x: F.when(F.contains(acc, x["wrong"]), X.replace_guarded(acc, x["wrong"], x["right"])).otherwise(acc))
    return _same(src, todo, [group, "block"], "left").withColumn("corrected", F.when(F.col("_todo").isNotNull(), fold).otherwise(F.col(text))).drop("_todo", "_row")
