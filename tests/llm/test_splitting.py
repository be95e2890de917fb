import random

import regex
from compare import duck, same

from lectern.llm import queries as Q
from lectern.llm import splitting as S
from lectern.llm import sql


def check(text, pieces, limit, overlap):
    pieces = sorted(pieces)
    assert pieces[0][1] == 0 and pieces[-1][2] == len(text)
    for i, (no, b, e, piece) in enumerate(pieces):
        assert no == i and piece == text[b:e] and 0 < len(piece) <= limit
        if i:
            assert b == pieces[i - 1][2] - overlap
            assert piece[:overlap] == pieces[i - 1][3][-overlap:]
            assert e > pieces[i - 1][2]
    return [e for _, _, e, _ in pieces[:-1]]


def run(spark, texts, limit, overlap, **kw):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "k long, text string, piece_no int")
    out = {}
    for r in S.split_texts(df, "k", "text", limit, overlap, **kw).collect():
        out.setdefault(r["k"], []).append((r["piece_no"], r["begin_pos"], r["end_pos"], r["piece"], r["cut_kind"]))
    return out


def test_round_trip_and_kinds(spark):
    rng = random.Random(1)
    parts = ["word ", "Satz. ", "句子。", "x" * 30, "\n\n", "a,b ", "👩‍💻", "é", "1.5 ", "…", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(20, 200))) for _ in range(60)]
    texts += ["x" * 101, "x" * 100, "", None, "é" * 500, "👍" * 300, " " * 250, "a" * 99 + " " + "b" * 100 + "."]
    got = run(spark, texts, 100, 20)
    for i, t in enumerate(texts):
        if not t or len(t) <= 100:
            assert i not in got
            continue
        ends = check(t, [p[:4] for p in got[i]], 100, 20)
        hard = max(map(len, regex.findall(r"[\p{L}\p{N}\p{M}]+", t)), default=0) > 100
        assert {p[4] for p in got[i]} == {"hard" if hard else "soft"}
        for e in ends:
            # inside a word only if the whole room since the cut before was one word
            if regex.fullmatch(r"[\p{L}\p{N}\p{M}]{2}", t[e - 1 : e + 1]):
                start = max([20] + [x for x in ends if x < e])
                assert regex.fullmatch(r"[\p{L}\p{N}\p{M}]+", t[start:e])


def test_strong_boundary_first(spark):
    t = "One two three. Four five six seven, eight nine ten eleven twelve."
    got = run(spark, [t], 40, 5)
    assert [t[b:e] for _, b, e, _, _ in sorted(got[0])][0].rstrip() == "One two three. Four five six seven,"
    t = "Alpha beta gamma delta epsilon. Zeta eta, theta iota kappa lambda mu."
    assert run(spark, [t], 45, 5)[0][0][3].rstrip().endswith("epsilon.")


def test_overlap_over_many_short_stretches(spark):
    """The overlap may reach over several stretches before."""
    head = "aa\n\nbb. cc, dd "
    for t in (head + "e" * 300, head * 3 + "-" * 50 + "f" * 400, ("g\n\n" + "h" * 120) * 9):
        check(t, [p[:4] for p in run(spark, [t], 100, 60)[0]], 100, 60)


def test_time_grows_with_length(spark):
    """One text of two million code points, thousands of pieces."""
    import time

    rng = random.Random(2)
    words = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) + rng.choice([".", "", "", ","]) for _ in range(400_000))
    df = spark.createDataFrame([("k", words)], "k string, text string")
    took = time.time()
    got = S.split_texts(df, "k", "text", 400).collect()
    took = time.time() - took
    assert len(got) > 5000
    check(words, [(r["piece_no"], r["begin_pos"], r["end_pos"], r["piece"]) for r in got], 400, 50)
    assert took < 30, took


def test_small_ones(spark):
    got = run(spark, ["short", "", None, "y" * 30], 20, 5, oversized_only=False)
    assert [len(got.get(i, [])) for i in range(4)] == [1, 1, 0, 2]


def test_oracle(spark, sf):
    assert same(Q.p3_found(spark, sf), sql.ORACLE["p3_found"], duck(sf)) > 0


def test_pieces_of_tables(spark, sf):
    con = duck(sf)
    docs = dict(con.sql("select cast(doc_id as varchar), text from documents where length(text) > 2000").fetchall())
    got = {}
    for r in Q.p3_pieces(spark, sf).filter("src = 'documents'").collect():
        got.setdefault(r["item"], []).append((r["piece_no"], r["begin_pos"], r["end_pos"], r["piece"]))
    assert got.keys() == docs.keys()
    for k, p in got.items():
        check(docs[k], p, 2000, 50)
