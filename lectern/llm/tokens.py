"""Token ids of a public byte-level BPE, by prefix dynamic programming.

A text is cut into words by the tokenizer's public pattern. Within a word, for
every byte prefix exactly one token can be the last one of the prefix's
encoding: the token ``t`` ending there for which the pair (last token of the
prefix before ``t``, ``t``) is what the merges give for the two together. A
table of these last tokens is filled from left to right: an Aho-Corasick
automaton names the tokens that end at each byte, longest first, and the pair
test runs down the two tokens' merge trees. Reading the table backwards gives
the ids. As an entry depends only on what lies before it, appending bytes just
extends the table, and after an edit only what follows it is done again
(:class:`Prefixes`, :func:`reencode`).

Defined cases: null and empty texts give an empty list; strings of special
tokens are ordinary text; every text is encoded whole. Columns other than key
and text are not looked at.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public tokenizers' files lie; a parameter everywhere below.
TOKENIZERS = os.environ.get("LECTERN_TOKENIZERS", "/opt/tokenizers")
#: The public word pattern of this tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a task keeps at most.
MEMO = 300_000


def _letters_to_bytes() -> dict[str, int]:
    """The usual stand-in letters of byte-level BPE files: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary and merge trees. Words are handled as str of code points 0-255, one per byte."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        stand = _letters_to_bytes()
        raw = lambda s: "".join(chr(stand[c]) for c in s)
        self.ids = {raw(k): v for k, v in model["vocab"].items() if all(c in stand for c in k)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y = self.ids[raw(a)], self.ids[raw(b)]
            to = self.ids[raw(a + b)]
            self.merged[x, y] = to
            self.parts.setdefault(to, (x, y))
        self.longest = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ids.items():
            if len(s) == 1 or i in self.parts:
                self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def joins(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side. An id is its merge's rank."""
        a, b, bound = left, right, 1 << 30
        parts, merged = self.parts, self.merged
        while True:
            to = merged.get((a, b))
            if to is not None and to < bound:
                return False
            if a > b:
                # the later merge of the two comes apart: look at its inner side
                bound, split = a, parts.get(a)
                if split is not None:
                    a = split[1]
                    continue
                bound, split = b + 1, parts.get(b)
                if split is None:
                    return True
                b = split[0]
            else:
                bound, split = b + 1, parts.get(b)
                if split is not None:
                    b = split[0]
                    continue
                bound, split = a, parts.get(a)
                if split is None:
                    return True
                a = split[1]


@functools.lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


class Prefixes:
    """The last token of every prefix of one word."""

    def __init__(self, m: Merges, word: str = ""):
        self.m, self.word, self.last, self.size = m, "", [0], [0]
        if word:
            self.append(word)

    def append(self, more: str) -> None:
        m, done = self.m, len(self.word)
        self.word += more
        last, size = self.last, self.size
        last.extend([-1] * len(more))
        size.extend([0] * len(more))
        pairs, joins = m.pairs, m.joins
        at = max(0, done - m.longest + 1)  # tokens that end in the new part begin after this
        for end, (tok, n) in m.automaton.iter(self.word[at:] if at else self.word):
            end += at + 1
            if end <= done or last[end] >= 0:
                continue
            start = end - n
            if start:
                key = last[start] << 20 | tok
                ok = pairs.get(key)
                if ok is None:
                    if len(pairs) > 2_000_000:
                        pairs.clear()
                    ok = pairs[key] = joins(last[start], tok)
                if not ok:
                    continue
            last[end] = tok
            size[end] = n

    def truncate(self, n: int) -> None:
        self.word = self.word[:n]
        del self.last[n + 1 :], self.size[n + 1 :]

    def ids(self) -> list[int]:
        out, at = [], len(self.word)
        while at:
            out.append(self.last[at])
            at -= self.size[at]
        return out[::-1]


class Encoder:
    def __init__(self, path: str, pattern: str = PATTERN):
        self.m = merges(path)
        self.find = regex.compile(pattern).findall
        self.memo: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        ids = self.memo.get(w)
        if ids is None:
            s = w.encode("utf-8").decode("latin-1")
            one = self.m.ids.get(s)
            ids = [one] if one is not None and (len(s) == 1 or one in self.m.parts) else Prefixes(self.m, s).ids()
            if len(self.memo) > MEMO:
                self.memo.clear()
            self.memo[w] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if text:
            memo = self.memo
            for w in self.find(text):
                out += memo.get(w) or self.word(w)
        return out


def reencode(enc: Encoder, old: str, ids: list[int], new: str) -> list[int]:
    """Ids of ``new``, from those of ``old``: only words from the first change on are done again.

    A word's cut may depend on the character after it, so the last word before
    the change, and the one before that (white space looks one word ahead), are
    done again too.
    """
    same = len(os.path.commonprefix([old, new]))
    spans = [m.span() for m in regex.finditer(PATTERN, old[: same + 1])]
    keep = [s for s in spans if s[1] < same][:-2]
    cut = keep[-1][1] if keep else 0
    n = sum(len(enc.word(old[a:b])) for a, b in keep)
    return ids[:n] + enc.encode(new[cut:])


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_path(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> str:
    return f"{folder}/{name}.json"


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            lists = [enc.encode(t) for t in b.column(1).to_pylist()]
            offs = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=offs[1:])
            flat = np.fromiter((i for x in lists for i in x), np.int32, int(offs[-1]))
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))], names=[b.schema.names[0], "ids"])

    return run


def _sizes(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [len(enc.encode(t)) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64())], names=[b.schema.names[0], "n_tokens"])

    return run


def _typed(df: DataFrame, key: str, tail: str) -> str:
    return f"`{key}` {df.schema[key].dataType.simpleString()}, {tail}"


def token_ids(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """key, ids: every row's token ids, without special tokens."""
    src = df.select(key, F.col(text).alias("_text"))
    return src.mapInArrow(_ids(path or tokenizer_path()), _typed(df, key, "ids array<int>"))


def token_sizes(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """key, n_tokens."""
    src = df.select(key, F.col(text).alias("_text"))
    return src.mapInArrow(_sizes(path or tokenizer_path()), _typed(df, key, "n_tokens long"))
