from collections import Counter

import regex
from compare import duck, same

from lectern.llm import queries as Q
from lectern.llm import sql
from lectern.llm import vocabulary as V


def brute(text):
    out = []
    for run in regex.findall(r"[一-鿿]+|[[\p{L}\p{N}]--[一-鿿]]+", text.lower(), flags=regex.V1):
        if "一" <= run[0] <= "鿿" and len(run) > 1:
            out += [run[i : i + 2] for i in range(len(run) - 1)]
        else:
            out.append(run)
    return out


def test_against_brute_force_and_heavy_path(spark):
    texts = ["the cat sat", "The dog", "", None, "中文字x单 the", "É é́ ½ x²", "the the the", "a_b-c1"] * 5
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, n int").select("text")
    vocab = spark.createDataFrame([("\t The ",), ("never",), (" ",), (None,), ("NEVER",), ("two words",)], "vocab string")
    n, held = Counter(), Counter()
    for t in texts:
        if t is not None:
            n.update(brute(t))
            held.update(set(brute(t)))
    # every term heavy, some heavy, none heavy, heavy ones that no record holds: the same counts
    part = spark.createDataFrame([("the never dog",)] * 9, "text string")
    for kw in ({"share": 0.0}, {"share": 0.3}, {"share": 1.0}, {}, {"detect_on": part}, {"detect_on": part.limit(0)}):
        counts, n_records = V.term_counts(df, vocab, flush_at=3, **kw)
        assert n_records == 35
        rows = counts.collect()
        got = {r["term"]: (r["n"], r["records"], r["listed"]) for r in rows}
        assert len(rows) == len(got)
        listed = {"the", "never", "two words"}
        assert got == {t: (n[t], held[t], t in listed) for t in set(n) | listed}


def test_heavy_is_found(spark):
    df = spark.createDataFrame([("the x%d" % i,) for i in range(50)], "text string")
    assert V.heavy_terms(df, share=0.5) == ["the"]


def test_heavy_terms_don_t_go_through_the_shuffle_by_term(spark):
    """Both tables are in the plan, and the one of heavy terms is summed by position."""
    df = spark.createDataFrame([("the x%d" % i,) for i in range(50)], "text string")
    counts, n = V.term_counts(df, share=0.5)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert n == 50 and "Union" in plan and "Aggregate [slot" in plan and "Aggregate [term" in plan
    assert counts.filter("term = 'the'").first()["records"] == 50


def test_empty_and_marks(spark):
    df = spark.createDataFrame([], "text string")
    vocab = spark.createDataFrame([("a",)], "vocab string")
    counts, n = V.term_counts(df, vocab)
    assert [tuple(r) for r in counts.collect()] == [("a", 0, 0, True)] and n == 0
    assert V.term_counts(df)[0].count() == 0
    c = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4)], "term string, records long")
    assert {r["term"]: r["mark"] for r in V.marked(c, 15).collect()} == {"a": "rare", "b": None, "c": "common"}


def test_oracle(spark, sf):
    for q in ("p1_counts", "p1_found"):
        assert same(Q.QUERIES[q](spark, sf), sql.ORACLE[q], duck(sf)) > 0
