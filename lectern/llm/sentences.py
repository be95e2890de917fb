"""Sentence units of texts in many languages and layouts, by a maximum-entropy classifier.

Lines are split at line breaks. Within a line every run of final marks with
the closing quotes and brackets after it is a candidate, and so is every space
in Thai and in Chinese written without marks. A logistic (maximum-entropy)
model over hashed features decides: the tokens around, their case, length,
digits and script, the mark, and whether a quote or bracket is open there or
was just closed, and where it was opened. The model is trained on reliable
boundaries: rows of a table that holds one sentence per row are joined again,
the joints are the boundaries, all other candidates inside a row are not. At
most ``max_rows`` rows are used for training (a documented bound; a fixed-size
weight vector results); every document is then split whole.

Positions are code points of the text as stored. Units neither begin nor end
with white space and hold every other character exactly once; invisible
characters stay with what is before them.

Defined cases: null, empty and blank texts give no units; equal rows give
equal units each; a null key is kept; other columns are not looked at.
"""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import lookalikes

#: Size of the weight vector.
SLOTS = 1 << 17

_LINE = regex.compile(r"[^\n\r\x0b\x0c\x1c-\x1e\x85  ]+")
_HIDDEN = regex.compile(r"[\p{Cf}\p{Mn}--[̀-ͯऀ-๿ً-ٟ]]", regex.V1)
_CLUSTER = regex.compile(r"(?:[.!?。…؟।॥]+(?:[ ]?»|[\"'”’“」』)\]】》])*)+")
_SPACES = regex.compile(r"(?<=\S) +(?=\S)")
_THAI = regex.compile(r"[฀-๿]")
_HAN = regex.compile(r"[一-鿿]")
_MARKED = regex.compile(r"[。、…]|[,;](?!\d)|[!?](?![a-z0-9])")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_LAST = regex.compile(r"(?r)[\p{L}\p{M}\p{N}_]+")
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_DIGITS = regex.compile(r"\p{N}+")
_CLOSER = {")": "(", "]": "[", "”": "“", "»": "«", "」": "「", "』": "『", "》": "《", "】": "【", "’": "‘"}
_OPENERS = frozenset(_CLOSER.values()) | {"„"}
_PAIRED = regex.compile("[" + regex.escape("".join([*_CLOSER, *sorted(_OPENERS)])) + "\"']")


def _fold_table() -> dict[int, str]:
    """One character for one: plain form of width variants, look-alikes and spaces, for features only."""
    table = {k: v for k, v in lookalikes._CHARS.items() if len(v) == 1}
    table |= {k: chr(v) for k, v in lookalikes._PLAIN.items() if chr(v).isascii() and chr(v).isalpha()}
    table[ord("\t")] = " "
    return table


_FOLD = _fold_table()


def kind(c: str) -> str:
    """A character's class: script and case of letters, digits, marks."""
    if not c:
        return "$"
    if c.isascii():
        return "U" if c.isupper() else "l" if c.islower() else "0" if c.isdigit() else c
    o = ord(c)
    if 0x4E00 <= o <= 0x9FFF:
        return "H"
    if 0x3040 <= o <= 0x30FF:
        return "K"
    if 0x0E00 <= o <= 0x0E7F:
        return "T"
    if 0x0900 <= o <= 0x097F:
        return "D" if unicodedata.category(c)[0] in "LM" else c
    if 0x0600 <= o <= 0x06FF:
        return "A" if unicodedata.category(c)[0] in "LM" else c
    if c.isupper():
        return "U"
    if c.islower():
        return "l"
    return c


def _shape(w: str) -> str:
    """Class of a word: script or case, digits, and a class of its length."""
    if not w:
        return ""
    if w.isdigit():
        return f"0{min(len(w), 4)}"
    n = "1" if len(w) == 1 else "2" if len(w) < 4 else "4"
    return kind(w[0]) + ("U" if len(w) > 1 and w.isupper() else "") + n


def pairs_of(line: str) -> list[tuple[int, int]]:
    """Matching quotes and brackets of a line, as (opener, closer) positions; pairs are nested or apart.

    A straight quote opens or closes by what it stands between, and by whether
    one is open where both can be; an opener that is never closed is none.
    """
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    where: dict[str, list[int]] = {}  # places in the stack of each kind of opener

    def opens(c: str, i: int) -> None:
        where.setdefault(c, []).append(len(stack))
        stack.append((c, i))

    def drop_to(k: int) -> None:
        while len(stack) > k:
            where[stack.pop()[0]].pop()

    for m in _PAIRED.finditer(line):
        i, c = m.start(), m[0]
        if c in "\"'":
            before, after = line[i - 1 : i], line[i + 1 : i + 2]
            if c == "'" and before.isalnum() and after.isalnum():
                continue
            at = where.get(c)
            only_opens = (not before or before.isspace()) and after.isalnum()
            if at and not (only_opens and c == '"'):
                out.append((stack[at[-1]][1], i))
                drop_to(at[-1])
            elif at:
                drop_to(at[-1])
                opens(c, i)
            elif c == '"' or (not before.isalnum() and after.isalnum()):
                opens(c, i)
        elif c == "“" and stack and stack[-1][0] == "„":
            out.append((stack[-1][1], i))
            drop_to(len(stack) - 1)
        elif c in _OPENERS:
            opens(c, i)
        else:
            at = where.get(_CLOSER[c])
            if at and not (c == "’" and line[i - 1 : i].isalnum() and line[i + 1 : i + 2].isalnum()):
                out.append((stack[at[-1]][1], i))
                drop_to(at[-1])
    return out


def nesting(pairs: list[tuple[int, int]], cands: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """For every candidate: where the innermost pair around it opens, and where the outermost pair that its mark closes does (-1: none)."""
    opener = {b: a for a, b in pairs}
    todo, around, out = sorted(pairs), [], []
    at_pair = 0
    for at, cut, _ in cands:
        while at_pair < len(todo) and todo[at_pair][0] < at:
            around.append(todo[at_pair])
            at_pair += 1
        while around and around[-1][1] < cut:
            around.pop()
        out.append((around[-1][0] if around else -1, min((opener[i] for i in range(at, cut) if i in opener), default=-1)))
    return out


def candidates(line: str, unmarked: bool, pairs: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(start of the mark, cut, kind of candidate) in order; the line's end is none.

    A quote that may open or close belongs to the mark before it only if it closes a pair.
    """
    end = len(line.rstrip())
    closing = {p[1] for p in pairs}
    out = []
    cuts = set()
    for m in _CLUSTER.finditer(line):
        cut = next((i for i in range(m.start(), m.end()) if line[i] in "\"'“’" and i not in closing), m.end())
        if cut < end:
            out.append((m.start(), cut, "m"))
            cuts.add(cut)
    if unmarked or _THAI.search(line):
        for m in _SPACES.finditer(line):
            a, b = line[m.start() - 1], line[m.end()]
            if unmarked or ((_THAI.match(a) or _THAI.match(b)) and not (a.isascii() and a.isalnum()) and not (b.isascii() and b.isalnum())):
                if m.start() not in cuts:
                    out.append((m.start(), m.start(), "s"))
        out.sort(key=lambda c: c[1])
    return out


def _last_word(s: str):
    """The word at the very end of ``s``: matched backwards from there."""
    return _LAST.match(s)


def features(line: str, cand: tuple[int, int, str], nested: tuple[int, int], last_cut: int, indent: int) -> list[str]:
    """Of a candidate with its place in the nesting; ``indent`` is how much white space the line begins with.

    Looked at are 40 characters before the mark and 60 after the cut, besides where the quote or bracket was opened.
    """
    at, cut, how = cand
    inside, shut = nested
    mark = line[at:cut] if how == "m" else " "
    gap = cut < len(line) and line[cut] == " "
    rest = line[cut : cut + 60].lstrip()
    left = line[max(0, at - 40) : at].rstrip()
    prev = _last_word(left)
    pw = prev[0] if prev else left[-1:]
    before = left[: prev.start()] if prev else left[:-1]
    glue = before[-1:]
    prev2 = _last_word(before.rstrip(" ."))
    p2 = prev2[0] if prev2 else ""
    nw = _WORD.match(rest)
    nw = nw[0] if nw else rest[:1]
    after = rest[len(nw) : len(nw) + 2].strip()
    nk, pk = kind(rest[:1]), kind(left[-1:])
    ns, ps = _shape(nw), _shape(pw)
    head = nw[:2] if nk in "HK" else nw[:6].lower()
    start = "^" if at <= indent or (at - len(pw) <= 6 and not line[: at - len(pw)].strip(" -*(")) else ""
    bare = mark.rstrip("\"'”’“」』)]】》» ")
    closes = mark[len(bare) :]
    ctx = ""
    if shut >= 0:
        k = shut - 1
        while k >= 0 and line[k].isspace():
            k -= 1
        ctx = "^" if k < 0 or shut <= last_cut + 1 or line[k] in ".!?。…؟।" else kind(line[k])
    token = _LETTERS.sub("a", _DIGITS.sub("0", left[left.rfind(" ") + 1 :]))[-8:]
    f = [
        "b", f"w{token}{bare[:1]}", f"wn{token}{bare[:1]}{gap}{nk}", f"m{bare[:3]}", f"mc{bare[:2]}{closes}", f"g{gap}{nk}", f"mg{bare[:1]}{gap}{nk}", f"n{head}", f"mn{bare[:1]}{gap}{head}",
        f"ns{ns}", f"ps{ps}", f"mps{bare[:1]}{ps}{gap}{nk}", f"pn{pk}{bare[:1]}{gap}{nk}", f"psns{ps}{bare[:1]}{gap}{ns}", f"a{nk}{after}",
    ]
    if how == "m" and bare[:1] == "." and len(bare) == 1:
        low = pw.lower()
        f += [f"p{low[-8:]}", f"pg{low[-6:]}{glue}", f"pnk{low[-6:]}{gap}{nk}", f"p2{p2.lower()[-5:]}{low[-5:]}", f"st{start}{ps}", f"gl{glue}{ps}{gap}{nk}"]
    if start:
        f.append(f"start{ps}{bare[:1]}{gap}")
    if inside >= 0:
        f += ["in", f"in{line[inside]}"]
    if closes:
        f += [f"c{closes}{nk}", f"cx{ctx}{nk}", f"cxh{ctx}{head}", f"cxm{ctx}{bare[:1]}{gap}{nk}", f"cxa{ctx}{ns}{after}", f"cs{shut >= 0}{nk}"]
    if how == "s":
        f += [f"s{pk}{nk}", f"s{left[-1:]}", f"sn{head}", f"sl{min(9, (cut - last_cut) // 3)}", f"sp{pk}{nk}{left[-1:]}"]
    return f


class Model:
    """Weights of the hashed features."""

    def __init__(self, weights: np.ndarray):
        self.w = weights
        self.at: dict[str, int] = {}
        self.weight: dict[str, float] = {}

    def slot(self, f: str) -> int:
        i = self.at.get(f)
        if i is None:
            if len(self.at) > 500_000:
                self.at.clear()
            i = self.at[f] = zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS
        return i

    def score(self, feats: list[str]) -> float:
        total, weight = 0.0, self.weight
        for f in feats:
            x = weight.get(f)
            if x is None:
                if len(weight) > 500_000:
                    weight.clear()
                x = weight[f] = float(self.w[zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS])
            total += x
        return total


def is_unmarked(folded: str) -> bool:
    """Whether a text is Chinese written without any marks."""
    return bool(_HAN.search(folded)) and not _MARKED.search(folded)


def line_cuts(line: str, unmarked: bool, model: Model) -> list[int]:
    pairs = pairs_of(line)
    cands = candidates(line, unmarked, pairs)
    indent = len(line) - len(line.lstrip())
    cuts, last = [], 0
    for c, nested in zip(cands, nesting(pairs, cands)):
        if model.score(features(line, c, nested, last, indent)) > 0:
            cuts.append(c[1])
            last = c[1]
    return cuts


def visible(text: str) -> tuple[str, np.ndarray | None]:
    """The folded text without invisible characters, and each kept character's place in ``text`` (None: all kept)."""
    folded = text.translate(_FOLD)
    if folded.isascii() or not _HIDDEN.search(folded):
        return folded, None
    keep = [i for i, c in enumerate(folded) if not _HIDDEN.match(c)]
    return "".join(folded[i] for i in keep), np.array(keep + [len(text)])


def units(text: str | None, model: Model) -> list[tuple[int, int]]:
    """(begin, end) of the sentence units of a text."""
    if not text or not text.strip():
        return []
    folded, places = visible(text)
    unmarked = is_unmarked(folded)
    ends = []
    for m in _LINE.finditer(folded):
        ends += [m.start() + c for c in line_cuts(m[0], unmarked, model)]
        ends.append(m.end())
    if places is not None:
        ends = [int(places[e]) for e in ends]
    out, at = [], 0
    for e in [*ends, len(text)]:
        piece = text[at:e]
        body = piece.strip()
        if body:
            b = at + len(piece) - len(piece.lstrip())
            out.append((b, b + len(body)))
        at = max(at, e)
    return out


# training


def _script(s: str) -> str:
    n: dict[str, int] = {}
    for c in s:
        k = kind(c)
        if k in "UlHKTDA":
            k = "l" if k == "U" else k
            n[k] = n.get(k, 0) + (3 if k == "K" else 1 if k != "l" else 0) + (k == "l") * 0.4
    return max(n, key=lambda k: (n[k], k)) if n else ""


def training_lines(sentences: list[str], seed: int = 7, per_line: int = 6, altered: float = 0.0) -> Iterator[tuple[str, set[int], bool]]:
    """(line, true cuts, unmarked) from sentences in order: joined, with and without list markers, and without marks.

    ``altered``: share of lines in lower case; a third as many are in upper case, and as many with case swapped;
    as many of those without spaces have a plain stop for the ideographic one.
    """
    rng = random.Random(seed)
    plain = [(_script(s), s) for s in (visible(t.strip())[0] for t in sentences if t and t.strip()) if "\n" not in s]
    for script, run in groupby(plain, key=lambda x: x[0]):
        run = [s for _, s in run]
        i = 0
        while i < len(run):
            n = rng.randint(1, per_line)
            part = run[i : i + n]
            i += n
            versions = [(part, False)]
            if script == "H":
                bare = [regex.sub(r"[。,;!?、…]+(?![a-z0-9])", "", s).strip() for s in part]
                bare = [s for s in bare if s and not _MARKED.search(s)]
                if bare:
                    versions.append((bare, True))
            for group, unmarked in versions:
                sep = " " if unmarked or script not in ("H", "K") else ""
                line = rng.choice(["", "", "", "- ", f"{rng.randint(1, 40)}. ", f"{rng.randint(1, 40)}) ", f"Q{rng.randint(1, 9999)}: "])
                cuts = set()
                for k, s in enumerate(group):
                    line += s
                    if k < len(group) - 1:
                        cuts.add(len(line))
                        line += sep if sep != " " or rng.random() < 0.9 else "  "
                way = rng.random() if altered else 1.0
                other = line.lower() if way < altered else line.upper() if way < altered * 4 / 3 else line.swapcase() if way < altered * 5 / 3 else line
                if altered and script in "HK" and rng.random() < altered:
                    other = other.replace("。", ".")
                # a few letters have no single one in the other case: positions must stay
                yield other if len(other) == len(line) else line, cuts, unmarked


def fit(sentences: list[str], titles: list[str] = (), rounds: int = 150, l2: float = 1e-6) -> Model:
    """A model from sentences in order and from titles that are units of their own."""
    model = Model(np.zeros(SLOTS, np.float32))
    idx, row, lab = [], [], []
    lines = [*training_lines(sentences, 7), *training_lines(sentences, 8, altered=0.3), *((visible(t.strip())[0], set(), is_unmarked(visible(t)[0])) for t in titles if t and t.strip())]
    for line, cuts, unmarked in lines:
        pairs, last = pairs_of(line), 0
        cands, indent = candidates(line, unmarked, pairs), len(line) - len(line.lstrip())
        for c, nested in zip(cands, nesting(pairs, cands)):
            y = c[1] in cuts
            slots = [model.slot(f) for f in features(line, c, nested, last, indent)]
            row += [len(lab)] * len(slots)
            idx += slots
            lab.append(y)
            if y:
                last = c[1]
    if not lab:
        return model
    i, r, y = np.array(idx), np.array(row), np.array(lab, float)
    w, g2 = np.zeros(SLOTS), np.full(SLOTS, 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(r, w[i], len(y)), -30, 30)))
        g = np.bincount(i, (p - y)[r], SLOTS) + l2 * len(y) * w
        g2 += g * g
        w -= 0.5 * g / np.sqrt(g2)
    return Model(w.astype(np.float32))


def train(sentences: DataFrame, group: str, order: str, text: str, titles: DataFrame | None = None, max_rows: int = 40_000, block: int = 64) -> Model:
    """Fit on whole blocks of consecutive rows, at most about ``max_rows`` (all rows of a smaller table)."""
    rows = sentences.select(F.col(group).alias("g"), F.col(order).alias("o"), F.col(text).alias("t")).filter("t is not null")
    n = rows.count()
    one_in = max(1, -(-n // max_rows))
    part = rows.filter(F.pmod(F.xxhash64("g", F.floor(F.col("o") / block)), F.lit(one_in)) == 0)
    got = part.distinct().orderBy("g", "o", "t").limit(max_rows).collect()
    heads: list[str] = []
    if titles is not None:
        t = titles.toDF("t").filter("t is not null").distinct()
        heads = [r["t"] for r in t.orderBy(F.xxhash64("t"), "t").limit(max_rows // 20).collect()]
    return fit([r["t"] for r in got], heads)


def _units(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(weights)
        for b in batches:
            keys, begin, end = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                for x, y in units(t, model):
                    keys.append(i), begin.append(x), end.append(y)
            yield pa.record_batch([b.column(0).take(pa.array(keys, pa.int64())), pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=[b.schema.names[0], "begin_pos", "end_pos"])

    return run


def sentence_units(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """key, begin_pos, end_pos: one row per unit."""
    src = df.select(key, F.col(text).alias("_text"))
    return src.mapInArrow(_units(model.w), f"`{key}` {df.schema[key].dataType.simpleString()}, begin_pos long, end_pos long")
