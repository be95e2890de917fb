import unicodedata

import pytest
from compare import duck

from lectern.llm import lookalikes as L
from lectern.llm import queries as Q


def canon(spark, texts):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id long, text string, rid int")
    out = {r["id"]: r for r in L.canonical_texts(df).collect()}
    assert set(out[0].asDict()) == {"id", "text", "rid", "canonical"} and len(out) == len(texts)
    return [out[i]["canonical"] for i in range(len(texts))]


ONE = "Résumé: Mitalzu v1.5, \"ok\" — 見出し データ!"
SAME = [
    ONE,
    unicodedata.normalize("NFD", ONE),
    ONE.replace("Mitalzu", "Ｍｉｔａｌｚｕ").replace(",", "，").replace("1", "１"),
    ONE.replace("Mitalzu", "Mіtаlzu"),
    ONE.replace("al", "a​l﻿").replace("z", "­z"),
    ONE.replace(" ", " ").replace("  ", " "),
    ONE.replace("データ", "ﾃﾞｰﾀ").replace("見", "⾒"),
    "　" + ONE + "\t\n",
    ONE.replace("é", "е́"),
]
OTHER = [ONE.lower(), ONE.replace("é", "e"), ONE.replace("1", "¹"), ONE.replace("1", "2"), ONE.replace("!", "?"), ONE.replace("ok", "oK"), ONE.replace(" ", "  "), ONE.replace("Mitalzu", "Mitalz")]


def test_same_and_other(spark):
    out = canon(spark, SAME + OTHER)
    assert set(out[: len(SAME)]) == {ONE}
    assert len(set(out)) == 1 + len(OTHER)


def test_most_frequent_form_of_fewest_scripts(spark):
    ru = ["Он же сор и рост, словарь.", "Вот сор."]
    la = ["The cop is here.", "a cop", "cop"]
    out = canon(spark, [*ru, *la, "Он же cop и рост, cлoварь.", "The сор is here.", "сор", "Таоѕ"])
    assert out[:5] == ru + la
    # words of one script are equal by the skeleton alone; what looks like no other text stays
    assert out[5:] == [ru[0], la[0], "cop", "Таоѕ"]


def test_edges(spark):
    assert canon(spark, [None, "", " \t ", "​", "👩‍💻 ⚠️", "น้ํา", "น้ำ", "x\r\ny"]) == [None, "", "", "", "👩‍💻 ⚠️", "น้ำ", "น้ำ", "x\ny"]
    df = spark.createDataFrame([], "id long, text string")
    assert L.canonical_texts(df).count() == 0
    assert len(L.SIGNS) == len(L.SIGNS_AS)


def test_repair_goes_by_token_and_vocabulary():
    assert L.in_dominant_script("Mіtаlzu") == "Mitalzu"
    assert L.in_dominant_script("cлoварь") == "словарь"
    assert L.in_dominant_script("жz") is None  # z has no look-alike there
    assert L.in_dominant_script("Résumе́") == "Résumé"


def test_only_forms_of_the_corpus_are_repaired(spark):
    texts = ["Mitalzu runs", "Mіtаlzu stops", "Qоrvan waits", "wоrd сор"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    rows, own = L.repaired_texts(df)
    got = {r[own[0]]: r["repaired"] for r in rows.collect()}
    # no text holds Qorvan or word; the last word is of one script
    assert got == {0: texts[0], 1: "Mitalzu stops", 2: texts[2], 3: texts[3]}


#: Pairs that public lists of confusable characters give, independent of the tables here, and pairs that a reader can tell apart.
ALIKE = [("ρ", "p"), ("ι", "i"), ("α", "a"), ("υ", "u"), ("κ", "k"), ("к", "k"), ("ү", "y"), ("Ү", "Y"), ("ԁ", "d"), ("ѵ", "v"), ("Ӏ", "I"), ("ϲ", "c"), ("ց", "g"), ("Ꭺ", "A"), ("ı", "i"),
         ("ɑ", "a"), ("ɡ", "g"), ("﹐", ","), ("ﺍ", "ا"), ("𝐚", "a"), ("𝟗", "9"), ("ⅰ", "i"), ("Ⅴ", "V"), ("\u3164x", "x"), ("\u115fx", "x"), ("ｑ", "q"), ("ﬁ", "fi"), ("⼀", "一"), ("ﾃﾞ", "デ"),
         ("К", "K"), ("Ω", "Ω"), ("µ", "μ"), ("\u2060x", "x"), ("x\u2009y", "x y"), ("−", "-"), ("∶", ":"), ("е", "e"), ("ο", "o"), ("ѕ", "s"), ("Ζ", "Z"), ("ꓮ", "A"), ("ロ", "口"), ("β", "ß")]
APART = [("A", "a"), ("é", "e"), ("²", "2"), ("①", "1"), ("O", "0"), ("l", "I"), ("!", "?"), ("«", "\""), ("x  y", "x y"), ("ñ", "n"), ("æ", "ae"), ("…", "."), ("ь", "b"), ("ж", "x"), ("х", "k"), ("л", "n")]


@pytest.mark.parametrize("a,b,same", [(*p, True) for p in ALIKE] + [(*p, False) for p in APART])
def test_public_confusables(a, b, same):
    look = lambda t: L.skeleton(L.plain_form(f"m{t}n"))
    assert (look(a) == look(b)) is same


def test_pairs_of_hot_copies(spark):
    rows = [("a", i, "same") for i in range(50)] + [("a", 50, "sаme"), ("a", 51, " same "), ("b", 52, "ѕame"), ("a", 53, None), ("a", 54, "​"), ("a", 55, " "), ("a", None, "ѕame")]
    df = spark.createDataFrame(rows, "src string, id long, text string")
    keys = L.canonical_keys(df, "src", "id")
    got = {tuple(r) for r in L.same_looking_pairs(keys, "src").collect()}
    assert got == {("a", i, 50) for i in range(50)} | {("a", 50, 51)}
    classes = {tuple(r) for r in L.same_looking_classes(keys, "src").collect()}
    assert classes == {("a", i, 0, 2) for i in range(52)}
    assert L.same_looking_pairs(L.canonical_keys(df.limit(0), "src", "id"), "src").count() == 0


def test_tables_against_brute_force(spark, sf):
    con = duck(sf)
    want = set()
    for src, key in (("documents", "doc_id"), ("hotwords", "hot_id")):
        groups = {}
        for i, t in con.sql(f"select {key}, text from {src} where text is not null").fetchall():
            p = L.plain_form(t)
            if p:
                groups.setdefault(unicodedata.normalize("NFC", unicodedata.normalize("NFD", p).translate(L._PLAIN)), []).append((i, t.strip()))
        for g in groups.values():
            want |= {(src, *sorted((x, y))) for x, s in g for y, t in g if x != y and s != t}
    assert {tuple(r) for r in Q.p2_found(spark, sf).collect()} == want != set()
    members = {tuple(r) for r in Q.p2_classes(spark, sf).select("src", "id").collect()}
    assert members == {(s, i) for s, a, b in want for i in (a, b)}
    texts = {(r["src"], r["id"]): r["canonical"] for r in Q.p2_texts(spark, sf).collect()}
    assert all(texts[s, a] == texts[s, b] for s, a, b in want)
