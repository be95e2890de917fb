"""Edge cases of the core operators on small fixtures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lectern import api
from lectern.functions import ids, text, times, vector
from lectern.operators import chunking, index, points, search, segments, state, terms
from lectern.operators.versions import current_rows
from lectern.sources import files, providers, sinks


def one(spark, col, **values):
    row = [tuple(values.values())] if values else [(1,)]
    names = list(values) or ["_"]
    return spark.createDataFrame(row, names).select(col.alias("x")).first()[0]


def test_uuids_and_times(spark):
    assert one(spark, ids.uuid5_hex(F.lit("L:0"))) == "659d33c1ba4050fc981615f73685b815"
    assert one(spark, ids.uuid1_micros(F.lit("62c82419-769d-41f7-b424-80497a2b5dd3_x.mp4"))) == ((0x1F7 << 48 | 0x769D << 32 | 0x62C82419) - 122192928000000000) // 10
    assert one(spark, ids.uuid1_micros(F.lit("x62c82419"))) is None
    assert one(spark, times.clock_seconds(F.lit("75:09"))) == 4509 and one(spark, times.clock_seconds(F.lit("7509"))) is None
    assert one(spark, times.hours_minutes(F.lit(3725.9))) == "1:02"
    assert [one(spark, times.duration_text(F.lit(v))) for v in (0, 3725)] == ["?", "1h02m"]


def test_term_shapes(spark):
    rows = [(t,) for t in ("vLLM", "vllm", "gpt-4", "RAG", "the", "a12", "GPU(x)")]
    df = spark.createDataFrame(rows, "t string")
    assert {r["t"] for r in df.filter(text.is_term_shape(F.col("t"))).collect()} == {"vLLM", "gpt-4", "RAG", "GPU(x)"}
    df = spark.createDataFrame([(t,) for t in ("step1", "ab1", "a(b", "x", "ok", "y" * 26, "neuralflow")], "t string")
    assert {r["t"] for r in df.filter(text.is_hotword_shape(F.col("t"))).collect()} == {"step1", "ok", "neuralflow"}


def test_drop_contained(spark):
    df = spark.createDataFrame([("euralflow",), ("neuralflow",), ("neuralflow",), ("flow",), ("x",), ("中",), ("中文",)], "t string")
    got = sorted(r["t"] for r in terms.drop_contained(df, "t").collect())
    assert got == ["neuralflow", "neuralflow", "x", "中文"]


def fix(spark, sentence, pairs):
    s = spark.createDataFrame([("k", sentence), ("n", None)], "id string, text string")
    p = spark.createDataFrame(pairs, "wrong string, right string")
    got = {r["id"]: r["corrected"] for r in terms.apply_corrections(s, ["id"], "text", p).collect()}
    assert got["n"] is None
    return got["k"]


def test_corrections(spark):
    assert fix(spark, "training ai", [("ai", "AI")]) == "training AI"
    assert fix(spark, "一二", [("一", "x")]) == "一二"
    assert fix(spark, "abc a", [("a", "b"), ("bc", "x")]) == "abc b"
    assert fix(spark, "say gpt4 and ai.", [("gpt4", r"\1$0"), ("ai", "A$1")]) == r"say \1$0 and A$1."
    assert fix(spark, "词汇表很长", [("词汇表", "词表"), ("词表很", "表")]) == "表长"
    assert fix(spark, "é中.", [("é", "e"), (".", "!")]) == "e中!"
    assert fix(spark, "x-y z", [("", "q"), ("z", None), ("z", "z"), ("x-y", "xy")]) == "xy z"


@pytest.mark.parametrize("chunk", [9, 2000])
def test_corrections_in_chunks(spark, chunk):
    """As one pair after the other on every text, whatever the chunks."""
    rng = __import__("random").Random(6)
    bits = ["ai", "b.c", "x", "词汇", "词", "表", " ", "-", "gpt", "é"]
    word = lambda n: "".join(rng.choice(bits) for _ in range(n))
    texts = [(f"k{i}", word(12)) for i in range(60)]
    pairs = [(word(rng.randint(1, 3)), word(rng.randint(0, 2))) for _ in range(25)]
    import re

    want = {}
    for k, t in texts:
        for w, r in sorted(set(pairs), key=lambda x: (-len(x[0]), *x)):
            if w != r and not re.fullmatch("[一-鿿]", w):
                t = re.sub(rf"(?<![A-Za-z0-9]){re.escape(w)}(?![A-Za-z0-9])", lambda _, r=r: r, t) if re.fullmatch(r"[A-Za-z0-9 .+\-]+", w) else t.replace(w, r)
        want[k] = t
    s, p = spark.createDataFrame(texts, "id string, text string"), spark.createDataFrame(pairs, "wrong string, right string")
    assert {r["id"]: r["corrected"] for r in terms.apply_corrections(s, ["id"], "text", p, chunk).collect()} == want


def test_replacement_expression(spark):
    for t, w, r, want in [("ai, training AI ai.", "ai", "A$1\\", "A$1\\, training AI A$1\\."), ("一二", "一", "x", "一二"), ("词词表", "词表", "T", "词T"), ("a", "", "x", "a"), ("a.b", "a.b", "c", "c"), (None, "a", "b", None)]:
        df = spark.createDataFrame([(t, w, r)], "t string, w string, r string")
        assert df.select(text.replace_guarded(F.col("t"), F.col("w"), F.col("r"))).first()[0] == want
    assert one(spark, text.safe_file_name(F.lit('a:b/c?"d|'))) == "a：b_c__d_"
    assert one(spark, text.ends_sentence(F.lit("x。"))) and not one(spark, text.ends_sentence(F.lit("")))


def test_hits(spark):
    d = spark.createDataFrame([(1, "RAG rag, xrag rag_ 召回召回"), (2, None), (3, "")], "id long, text string")
    t = spark.createDataFrame([("rag",), ("召回",), ("回召",), ("zz",), ("",), (None,)], "term string")
    assert sorted(map(tuple, terms.term_hits(d, "id", "text", t, "term").collect())) == [(1, "rag", 3), (1, "召回", 2), (1, "回召", 1)]


def sents(spark, lengths, end="。"):
    rows = [("L", i, float(i), float(i + 1), "x" * (n - 1) + end) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "lesson string, sent_no long, begin_sec double, end_sec double, text string")


@pytest.mark.parametrize("lengths,want", [([50], []), ([450], [(0, 0, 450)]), ([150, 150, 150], [(0, 1, 300), (1, 2, 300)]), ([450, 10, 10], [(0, 0, 450), (0, 1, 460), (1, 2, 20)])])
def test_sub_chunks(spark, lengths, want):
    got = chunking.sub_chunks(sents(spark, lengths), "lesson").collect()
    assert sorted((r["start_sent"], r["end_sent"], r["n_chars"]) for r in got) == want


def test_sub_chunks_empty_and_nulls(spark):
    assert chunking.sub_chunks(sents(spark, []), "lesson").count() == 0
    df = sents(spark, [150, 150]).unionByName(spark.createDataFrame([("L", 9, 9.0, 9.5, None), ("L", 10, 10.0, None, ""), ("M", 0, None, None, None)], sents(spark, []).schema))
    assert [(r["lesson"], r["n_sents"]) for r in chunking.sub_chunks(df, "lesson").collect()] == [("L", 2)]


def test_nodes(spark):
    s = sents(spark, [10] * 20)
    b = spark.createDataFrame([("L", 3), ("L", 10), ("L", 10), ("L", 99), ("L", None)], "lesson string, at long")
    assert sorted((r["start_sent"], r["end_sent"], r["begin_sec"], r["end_sec"]) for r in chunking.node_bounds(b, s, "lesson").collect()) == [(3, 10, 3.0, 10.0), (10, 20, 10.0, 20.0)]
    c = spark.createDataFrame([("L", 0, 1.0), ("L", 5, 5.0), ("L", 9, 7.0), ("M", 0, 1.0)], "lesson string, start_sent long, begin_sec double")
    n = spark.createDataFrame([("L", 2.0, 0, "first"), ("L", 5.0, 1, "a"), ("L", 5.0, 2, "b"), ("L", None, 3, "null")], "lesson string, begin_sec double, start_sent long, node_title string")
    got = {(r["lesson"], r["start_sent"]): r["node_title"] for r in chunking.assign_nodes(c, n, "lesson").collect()}
    assert got == {("L", 0): "first", ("L", 5): "b", ("L", 9): "b", ("M", 0): ""}


def test_parents(spark):
    rows = [(1499, "a"), (1, "b"), (1500, "b"), (1500, "b"), (10, "c")]
    df = spark.createDataFrame([("L", i, float(i), float(i), n, t, "x") for i, (n, t) in enumerate(rows)], "lesson string, start_sent long, begin_sec double, end_sec double, n_chars long, node_title string, text string")
    got = sorted((r["start_sent"], r["n_subs"], r["n_chars"]) for r in chunking.parent_chunks(df, "lesson").collect())
    assert got == [(0, 3, 3000), (3, 1, 1500), (4, 1, 10)]


def test_cuts(spark):
    def cuts(dur, marks):
        m = spark.createDataFrame([("L", int(x * 1000)) for x in marks], "lesson string, t_ms long")
        d = spark.createDataFrame([("L", int(dur * 1000)), ("N", None)], "lesson string, dur_ms long")
        return sorted(r["cut_ms"] / 1000 for r in segments.plan_cuts(m, d, "lesson").collect())

    assert cuts(1200, []) == [] and cuts(1200.1, []) == [900.0]
    assert cuts(2000, [890, 910]) == [890.0]
    assert cuts(5000, [100, 4990]) == [900.0, 1800.0, 2700.0, 3600.0, 4500.0]
    assert cuts(4000, [1000, 2950]) == [1000.0, 1900.0, 2950.0]


def test_cuts_far_from_any_mark(spark):
    """Marks hours apart: multiples of the aim until a mark is in reach, as the plain walk gives them."""

    def plain(dur, marks):
        at, out = 0, []
        while dur - at > 1_200_000:
            near = [m for m in sorted(set(marks)) if at + 840_000 <= m <= at + 1_200_000]
            at = min(near, key=lambda m: abs(m - at - 900_000)) if near else at + 900_000
            out.append(at)
        return out

    rng = __import__("random").Random(4)
    cases = {"a": (36_000_000, [14_000_000, 30_000_000]), "b": (200_000_000, [rng.randrange(200_000_000) for _ in range(40)]), "c": (9_000_000, []), "d": (40_000_000, [1_250_000 + 900_000 * i + j for i in range(30) for j in range(0, 400_000, 900)])}
    m = spark.createDataFrame([(k, x) for k, (_, marks) in cases.items() for x in marks], "lesson string, t_ms long")
    d = spark.createDataFrame([(k, dur) for k, (dur, _) in cases.items()], "lesson string, dur_ms long")
    got = {}
    for r in segments.plan_cuts(m, d, "lesson").collect():
        got.setdefault(r["lesson"], []).append(r["cut_ms"])
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(*v) for k, v in cases.items()}


def test_chunks_of_sparse_numbers_and_short_sentences(spark):
    """Numbers 1,500 apart, and parents that span more than a thousand numbers."""
    rows = [("L", i * 1500, float(i), i + 1.0, "x" * 149 + "。") for i in range(60)]
    df = spark.createDataFrame(rows, "lesson string, sent_no long, begin_sec double, end_sec double, text string")
    got = sorted((r["start_sent"] // 1500, r["end_sent"] // 1500, r["n_chars"]) for r in chunking.sub_chunks(df, "lesson").collect())
    assert got == [(i, i + 1, 300) for i in range(59)]
    short = spark.range(12_000).selectExpr("'L' as lesson", "id as sent_no", "double(id) as begin_sec", "double(id + 1) as end_sec", "'ab' as text")
    subs = chunking.sub_chunks(short, "lesson").withColumn("node_title", F.lit("t"))
    # the plain walks
    want, first, size = [], 0, 0
    for i in range(12_000):
        size += 2
        if size >= 400:
            want.append((first, i, size))
            first, size = i, 2
    if first < 11_999:
        want.append((first, 11_999, size))
    assert sorted((r["start_sent"], r["end_sent"], r["n_chars"]) for r in subs.collect()) == want
    parents, size, first = [], 0, 0
    for k, (_, _, n) in enumerate(want):
        size += n
        if size >= 3000 or k == len(want) - 1:
            parents.append((want[first][0], k - first + 1, size))
            first, size = k + 1, 0
    assert sorted((r["start_sent"], r["n_subs"], r["n_chars"]) for r in chunking.parent_chunks(subs, "lesson").collect()) == parents


def test_media_logs(spark):
    log = "silence_start: 10\nx silence_end: 12.5 | d\nsilence_start: 50"
    df = spark.createDataFrame([("f", log), ("g", None)], "f string, line string")
    assert [(r["f"], r["t_ms"]) for r in segments.silence_marks(df, "f", "line").collect()] == [("f", 11250), ("f", 50500)]
    assert one(spark, files.probe_seconds(F.lit("  Duration: 01:02:03.45, start"))) == 3723 and one(spark, files.probe_seconds(F.lit("bad"))) == 0


def test_merge_skips_what_is_no_speech(spark):
    body = {"meta": {"no_speech": None}, "result": {"transcripts": [{"sentences": [{"begin_time": 1234, "end_time": 2000, "text": "a"}]}]}}
    rows = [("L", 1, 900_000, json.dumps(body)), ("L", 2, 0, json.dumps(body | {"meta": {"no_speech": True}})), ("L", 3, 0, "{"), ("L", 4, 0, None)]
    df = spark.createDataFrame(rows, "lesson string, seg_no int, start_ms long, body string")
    assert [(r["seg_no"], r["begin"], r["end"], r["text"]) for r in segments.merge_results(df, "lesson").collect()] == [(1, 901.23, 902.0, "a")]


def test_index_and_search(spark):
    import math

    tf = spark.createDataFrame([("a", "t", 1)], "id string, term string, tf long")
    assert abs(index.idf(tf, 1).first()["idf"] - math.log(4 / 3)) < 1e-12
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), ("d", [1.0]), ("e", [1.0, 1.0])], "id string, v array<float>")
    assert [tuple(r) for r in search.top(search.dense_scores(v, "id", "v", [1.0, 0.0]), "id", 9).collect()] == [("a", 1.0), ("e", 0.70711)]
    got = {(r["key"], r["rank"]): r["near"] for r in search.exact_top_k(v, F.lit(True), "id", "v", 2, block_rows=1).collect()}
    assert got == {("a", 1): "e", ("e", 1): "a"}
    a = spark.createDataFrame([("x", 1), ("y", 2)], "id string, rank int")
    assert [r["id"] for r in search.fuse([a, a.filter("id = 'y'")], "id", 5).collect()] == ["y", "x"]
    assert one(spark, vector.dot(F.array(F.lit(1.0)), F.array(F.lit(2.0), F.lit(1.0)))) is None


def test_versions_and_state(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", t, 1), ("a", None, 2), ("a", t, 1), ("b", None, 3), (None, t, 4)], "id string, ingested_at timestamp_ntz, x int")
    assert sorted(tuple(r) for r in current_rows(df).select("id", "x").collect()) == [("a", 1), ("b", 3)]
    w = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "g string, n int")
    d = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "g string, n int")
    assert sorted(map(tuple, state.pending(w, d, ["g", "n"]).collect()), key=repr) == [("a", 2), (None, 1)]
    assert {r["g"]: r["complete"] for r in state.completion(w, d, "g", ["g", "n"]).collect()} == {"a": False, "b": True, None: False}


def test_sinks_and_sources(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x|y"), ("b", 2, None)], "g string, n int, t string")
    p = str(tmp_path / "t")
    sinks.write_partitioned(df, p, "g")
    for _ in range(2):
        sinks.replace_groups(df.filter("g = 'a'").withColumn("n", F.lit(7)), p, "g")
    assert sorted((r["g"], r["n"]) for r in spark.read.parquet(p).collect()) == [("a", 7), ("b", 2)]
    up = sinks.upsert(df, spark.createDataFrame([("b", 9, None), ("c", 3, "z"), (None, 1, "")], df.schema), "g", {"t": None})
    assert sorted(map(tuple, up.collect()), key=repr) == [("a", 1, "x|y"), ("b", 9, None), ("c", 3, "z")]
    assert [r["line"] for r in sinks.markdown_lines(df, ["g", "t"], ["g"]).orderBy("line_no").collect()] == ["| g | t |", "|---|---|", r"| a | x\|y |", "| b |  |"]
    (tmp_path / "d" / "skip").mkdir(parents=True)
    (tmp_path / "d" / "one.txt").write_text("Term A \n中文\n")
    (tmp_path / "d" / "skip" / "two.txt").write_text("x")
    assert [r["source"] for r in files.walk(spark, f"file://{tmp_path}/d", ".txt", ["skip"]).collect()] == ["one.txt"]
    assert [r["line"] for r in files.lines_with_letters(spark, str(tmp_path / "d" / "one.txt")).collect()] == ["Term A"]
    assert [r["name"] for r in files.listing(spark, str(tmp_path / "d"), "*.txt").collect()] == ["one.txt"]


def test_providers(spark):
    df = spark.createDataFrame([(i, f"t{i % 3} 中文") for i in range(25)], "id int, text string")
    sizes = providers.in_batches(df.coalesce(1), "text", "n", lambda xs: [len(xs)] * len(xs), "int", 10)
    assert sorted(r["n"] for r in sizes.collect()) == [5] * 5 + [10] * 20
    v = df.select(providers.hashed_embedding(F.col("text"), 16).alias("v")).collect()
    assert v[0]["v"] == v[3]["v"] and abs(sum(x * x for x in v[0]["v"]) - 1) < 1e-5
    assert one(spark, providers.hashed_embedding(F.lit(None).cast("string"), 4)) == [0.0] * 4
    assert one(spark, providers.reply(F.lit('{"breaks":[1,2],"x":3}'), providers.BREAKS)).breaks == [1, 2]
    assert one(spark, providers.numbered(F.array(F.lit("a"), F.lit("b")))) == "0. a\n1. b"


def test_api(spark, sf, tmp_path):
    out = api.search_course_notes(spark, sf, "召回", [1.0] + [0.0] * 1023)
    assert out["hits"].count() <= 6 and out["chapters"].count() == 4
    home = f"file://{tmp_path}/index"
    api.build_index(spark, sf, home)
    # a saved index gives the same
    query = "召回 the budget"
    assert [tuple(r) for r in api.search_course_notes(spark, sf, query)["hits"].orderBy("score", "text").collect()] == [
        tuple(r) for r in api.search_course_notes(spark, sf, query, index_home=home)["hits"].orderBy("score", "text").collect()
    ]
    known = [r[0] for r in api.lessons(spark, sf).collect()]
    none, some = api.get_lesson_outline(spark, sf, "none"), api.get_lesson_outline(spark, sf, "L000")
    assert "L000" in known and some.count() > 0 and none.count() == 0 and none.schema == some.schema
    assert api.get_segment(spark, sf, "L000", 0.0, 60.0).first()["n_sentences"] > 0


def test_exact_top_k_of_mixed_lengths(spark):
    """Which rows are usable doesn't depend on the blocks that they fall into."""
    v = spark.createDataFrame([(f"{i:02d}", [1.0, float(i)] if i < 7 else [1.0, 0.0, float(i)]) for i in range(12)], "id string, v array<double>")
    for block_rows in (1, 2, 100):
        got = {(r["key"], r["near"]) for r in search.exact_top_k(v, F.lit(True), "id", "v", 20, block_rows=block_rows).collect()}
        assert got == {(f"{a:02d}", f"{b:02d}") for a in range(7) for b in range(7) if a != b}


def test_failed_calls_are_kept_apart(spark):
    def call(values):
        if any(v is None or v == "bad" for v in values):
            raise RuntimeError("refused")
        return [v.upper() for v in values]

    df = spark.createDataFrame([(i, v) for i, v in enumerate(["a", "bad", "b", None, "c", "d"])], "i int, v string").coalesce(1)
    got = {r["i"]: (r["o"], r["e"]) for r in providers.in_batches(df, "v", "o", call, "string", 3, errors="e").collect()}
    assert got == {0: ("A", None), 1: (None, "RuntimeError: refused"), 2: ("B", None), 3: (None, "RuntimeError: refused"), 4: ("C", None), 5: ("D", None)}
    short = providers.in_batches(df.filter("i = 0"), "v", "o", lambda v: [], "string", errors="e").first()
    assert short["o"] is None and "0 results" in short["e"]
    assert providers.in_batches(df.filter("i > 9"), "v", "o", call, "string", errors="e").count() == 0


def test_points_of_clashing_and_empty_texts(spark, tmp_path):
    rows = spark.createDataFrame([("L1", 0, "一二三 abc", 1), ("L1", 1, None, 2), ("L2", 0, "", 3), (None, None, "x", 4)], "lesson string, n int, text string, term int")
    got = points.points_of(rows, F.concat(F.col("lesson"), F.lit(":"), F.col("n")), "text")
    home = str(tmp_path / "points")
    assert points.ingest(got, home) and not points.ingest(got.filter("lesson = 'L2'"), home)
    back = {(r["lesson"], r["n"]): (r["term"], [t["term"] for t in r["sparse"]], len(r["dense"])) for r in spark.read.parquet(home).collect()}
    assert back == {("L1", 0): (1, ["abc", "一二", "二三"], 1024), ("L1", 1): (2, [], 1024), ("L2", 0): (3, [], 1024)}


def test_versions_within_blocks(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    v = spark.createDataFrame(
        [("a", t[0], [1.0, 0.0]), ("a", t[1], [0.0, 1.0]), ("b", None, [0.0, 1.0]), ("b", t[0], [1.0, 1.0]), ("c", t[0], [0.0, 1.0]), ("c", t[2], None), ("d", t[0], [0.0, 0.0]), ("e", t[0], [1.0]), ("f", t[1], [0.0, 2.0]), ("f", t[1], [0.0, 2.0])],
        "id string, at timestamp_ntz, v array<float>",
    )
    q = spark.createDataFrame([("q", [0.0, 3.0]), ("z", [0.0, 0.0]), ("n", None)], "id string, v array<float>")
    for block_rows in (1, 3, 100):
        got = [(r["key"], r["near"], r["score"]) for r in search.exact_top_k(v, F.lit(False), "id", "v", 3, block_rows=block_rows, queries=q, dim=2, version="at").orderBy("rank").collect()]
        assert got == [("q", "a", 1.0), ("q", "f", 1.0), ("q", "b", 0.70711)]


def test_sparse_top_k_against_brute_force(spark):
    docs = [("a", "x y y 甲乙丙"), ("b", "x z"), ("c", ""), ("d", None), ("e", "y 甲乙"), ("f", "y 甲乙")]
    d = spark.createDataFrame(docs, "id string, text string")
    q = spark.createDataFrame([("1", "Y 甲乙 unknown"), ("2", ""), ("3", None), ("4", "z x z")], "query string, text string")
    idfs = index.idf(index.document_terms(d.filter("text is not null"), "id", "text"), 5)
    tf = index.term_frequencies(d, "id", "text")
    want = set()
    for name in "1234":
        asked = index.term_frequencies(q.filter(F.col("query") == name), "query", "text").select("term", "tf")
        want |= {(name, r["id"], r["score"]) for r in search.top(search.sparse_scores(index.weights(tf, idfs), "id", asked, idfs), "id", 2).collect()}
    for block_rows in (1, 2, 100):
        got = {(r["query"], r["id"], r["score"]) for r in search.sparse_top_k(d, "id", "text", q, "query", idfs, 2, block_rows=block_rows).collect()}
        assert got == want and len(got) == 4
