import os
import random

import pytest
from compare import duck

from lectern.llm import queries as Q
from lectern.llm import tokens as T

tokenizers = pytest.importorskip("tokenizers")
if not os.path.exists(T.tokenizer_path()):
    pytest.skip("no tokenizer files here", allow_module_level=True)


@pytest.fixture(scope="module")
def public():
    t = tokenizers.Tokenizer.from_file(T.tokenizer_path())
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


ODD = ["", "a", "<|endoftext|> x", "  two  blanks \n\n", "中文。かな ไทย हिन्दी عربي", "👩‍💻⚠️", "é", "\x00\x7f", "a" * 3000, "aaaabaaaab" * 99, " " * 500, "don't WE'LL"]


def test_odd_texts(public):
    enc = T.Encoder(T.tokenizer_path())
    for s in ODD:
        assert enc.encode(s) == public(s), s[:40]
    assert enc.encode(None) == []


def test_append_and_edit(public):
    rng = random.Random(3)
    enc = T.Encoder(T.tokenizer_path())
    pieces = ["ing", " the", "中", "文字", "x9", " ", "  ", "\n", "'s", "é", "!!", "tokenization"]
    for _ in range(200):
        old = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        at = rng.randint(0, len(old))
        new = old[:at] + rng.choice(pieces) + old[at + rng.randint(0, 2) :]
        for b in (new, old + new):
            assert T.reencode(enc, old, enc.encode(old), b) == public(b), (old, b)
        word = new.encode().decode("latin-1")
        whole = T.Prefixes(enc.m, word)
        cut = rng.randint(0, len(word))
        grown = T.Prefixes(enc.m, word[:cut])
        grown.append(word[cut:])
        assert grown.ids() == whole.ids()
        grown.truncate(cut)
        assert grown.ids() == T.Prefixes(enc.m, word[:cut]).ids()


def test_every_token_encodes_to_itself():
    m = T.merges(T.tokenizer_path())
    assert all(T.Prefixes(m, s).ids() == [i] for s, i in m.ids.items())


def test_frames(spark, public, sf):
    df = spark.createDataFrame([("k", None, 1), ("k", "", 2), (None, "a b", 3)], "id string, text string, ids int")
    assert sorted(map(tuple, T.token_ids(df, "id", "text").collect()), key=repr) == sorted([("k", []), ("k", []), (None, public("a b"))], key=repr)
    assert T.token_ids(df.limit(0), "id", "text").count() == 0
    want = duck(sf).sql("select doc_id, coalesce(text, '') from documents").fetchall()
    assert {r["doc_id"]: list(r["ids"]) for r in Q.p6_ids(spark, sf).collect()} == {k: public(t) for k, t in want}
