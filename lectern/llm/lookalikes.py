"""One form for texts that a reader cannot tell apart.

Three steps, each of its own:

1. *Plain form.* Every character is brought to its plain form: width variants,
   ideographs of the radicals block, presentation forms and ligatures, lettered
   styles of mathematics, composed accents, kinds of space (one for one),
   invisible characters, signs that look alike. Case, accents, digits, raised
   digits, words and punctuation stay as they are.
2. *Script-aware repair.* A token whose letters are of several scripts has a
   dominant script: that of most of its letters that have no look-alike, then of
   most letters. Its other letters are replaced by their look-alikes of that
   script, if all have one and the result exists in the corpus vocabulary (the
   tokens of all texts in plain form); else the token stays.
3. *Equality.* What the repair leaves, whole words in another script or words
   that the corpus doesn't hold, still looks the same. The *skeleton* of a text
   has every look-alike replaced by one letter; texts of one skeleton are a
   class, and all take the class's most frequent repaired text (of equals the
   one of fewest scripts, then the smallest).

Defined cases: null gives null; blank texts come out empty; outer white space
is dropped; other columns are not looked at; repeated or null keys are kept as
rows of their own.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import staged

# Letters and the letters that they look like.
CYRILLIC = "аеорсухѕіјһԛԝӏкгԁѵүҽАВЕЅІЈКМНОРСТУХԌԚԜҮӀѴЗГПФ"
CYRILLIC_AS = "aeopcyxsijhqwlkrdvyeABESIJKMHOPCTYXGQWYIV3ΓΠΦ"
GREEK = "νοαγικρυχβϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿϜ"
GREEK_AS = "voayikpuxßcjABEZHIKMNOPTYXCJF"
ARMENIAN = "օսհոցզյՕՍԼՏ"
ARMENIAN_AS = "ouhngqjOULS"
CHEROKEE = "ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏻᏼ"
CHEROKEE_AS = "DRTiyAJEWMHYGhZbRWSVSLCPKdGB"
LISU = "ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
LISU_AS = "BPdDTGKJCZFMNLSRVHWXYAEIOU"
COPTIC = "ⲞⲟⲤⲥⲢⲣⲂⲎⲒⲔⲘⲚⲦⲬ"
COPTIC_AS = "OoCcPpBHIKMNTX"
#: Further Latin letters, and kana that look like ideographs or like each other.
OTHER = "ıɑɡɩɪȷᴄᴏᴠᴡᴢꜱʋƅꞵエカタトニハロへべぺー"
OTHER_AS = "iagiijcovwzsubß工力夕卜二八口ヘベペ一"
# Signs that look alike.
SIGNS = "‐‑−˗⁃․ꓸ‧∙⋅ʼ՚ʻ׃∶꞉։∕⁄⧸╱∗⁎٭∖⧵∣ǀǃ‚٫∼"
SIGNS_AS = "-----..···’’‘::::////***\\\\||!,,~"

_PLAIN = str.maketrans(CYRILLIC + GREEK + ARMENIAN + CHEROKEE + LISU + COPTIC + OTHER, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + CHEROKEE_AS + LISU_AS + COPTIC_AS + OTHER_AS)
_INVISIBLE = regex.compile(r"[­͏؜ᅟᅠ឴឵᠋-᠏​‌‎‏‪-‮⁠-⁯ㅤ﻿ﾠ￹-￻\U0001D173-\U0001D17A\U000E0000-\U000E007F\U000E0100-\U000E01EF]+")
#: A joiner between pictures makes one picture of them, a selector after a sign changes its style; elsewhere both are invisible.
_JOINER = regex.compile(r"(?<![\p{So}\p{Sk}️])‍|‍(?!\p{So})|(?<!\p{So})[︀-️]")
_THAI_AM = regex.compile("([ํໍ])([่-๋່-໋]?)([าາ])")
#: Blocks in which every character's plain form is its compatibility form.
_COMPATIBLE = (
    (0x0132, 0x0134), (0x01C4, 0x01CD), (0x2160, 0x2180), (0x2E80, 0x2FE0), (0xFB00, 0xFB07), (0xFB13, 0xFB18), (0xFB1D, 0xFDF0),
    (0xFE50, 0xFE6C), (0xFE70, 0xFEFD), (0xFF01, 0xFFEF), (0x1D400, 0x1D800),
)


def _char_table() -> dict[int, str]:
    table: dict[int, str] = {ord(a): b for a, b in zip(SIGNS, SIGNS_AS)}
    styled = [c for c in range(0x2100, 0x2150) if unicodedata.decomposition(chr(c)).startswith("<font>")]
    for c in [*styled, 0xB5, *(c for lo, hi in _COMPATIBLE for c in range(lo, hi))]:
        plain = unicodedata.normalize("NFKC", chr(c))
        if plain != chr(c) and " " not in plain and len(plain) < 5:
            table[c] = plain
    for c in [*range(0x80, 0x3001), 0x2800]:
        if unicodedata.category(chr(c)) == "Zs" or c == 0x2800:
            table[c] = " "
    return table


_CHARS = _char_table()


def _class(chars) -> str:
    """A character class of code points, as ranges."""
    out, run = [], []
    for c in [*sorted(chars), None]:
        if run and (c is None or c != run[-1] + 1):
            out.append(f"\\U{run[0]:08x}-\\U{run[-1]:08x}")
            run = []
        if c is not None:
            run.append(c)
    return "[" + "".join(out) + "]"


_ODD = re.compile(_class({*_CHARS, 0x200D, *range(0xFE00, 0xFE10), *(c for c in range(0xE0200) if _INVISIBLE.match(chr(c)))}))
_LOOKS = re.compile(_class(_PLAIN))
#: First and last code point of a script's letters.
_SCRIPTS = {
    "LATIN": "A-Za-zªºÀ-ÖØ-öø-ʯḀ-ỿ", "GREEK": "Ͱ-Ͽἀ-῿", "CYRILLIC": "Ѐ-ԯ", "ARMENIAN": "Ա-և",
    "CHEROKEE": "Ꭰ-ᏽ", "LISU": "ꓐ-ꓷ", "COPTIC": "Ⲁ-⳱",
}
_OF_SCRIPT = {s: re.compile(f"[{r}]") for s, r in _SCRIPTS.items()}
_MARKS = "̀-ͯ"
_ANY = "".join(_SCRIPTS.values())
TOKEN = re.compile(f"[{_ANY}{_MARKS}]+")
#: Neighbouring letters of different scripts.
_MIXED = re.compile("|".join(f"[{r}][{_MARKS}]*(?=[{''.join(o for t, o in _SCRIPTS.items() if t != s)}])" for s, r in _SCRIPTS.items()))
#: For a script: the letters of others and their look-alikes in it.
_INTO: dict[str, dict[int, str]] = {}


def plain_form(text: str) -> str:
    """Text with every character in its plain form; look-alike letters are left as they are."""
    if "\r" in text:
        text = text.replace("\r\n", "\n")
    if not text.isascii():
        if _ODD.search(text):
            text = _JOINER.sub("", _INVISIBLE.sub("", text)).translate(_CHARS)
        text = unicodedata.normalize("NFC", text)
        if "ํ" in text or "ໍ" in text:
            text = _THAI_AM.sub(lambda m: m[2] + ("ำ" if m[1] == "ํ" else "ຳ"), text)
    return text.strip()


def skeleton(text: str) -> str:
    """A text in plain form with every look-alike letter as the one letter that stands for it."""
    if text.isascii():
        return text
    apart = unicodedata.normalize("NFD", text)
    return unicodedata.normalize("NFC", apart.translate(_PLAIN)) if _LOOKS.search(apart) else text


def script_of(letter: str) -> str:
    return next((s for s, p in _OF_SCRIPT.items() if p.match(letter)), "")


def scripts(text: str) -> set[str]:
    return {s for s, p in _OF_SCRIPT.items() if p.search(text)}


def _into(script: str) -> dict[int, str]:
    """Letters of other scripts to their look-alikes in ``script``."""
    if not _INTO:
        kin: dict[str, list[str]] = {}
        for c, to in _PLAIN.items():
            kin.setdefault(chr(to), [chr(to)]).append(chr(c))
        for s in _SCRIPTS:
            _INTO[s] = {ord(x): own[0] for group in kin.values() if (own := [y for y in group if script_of(y) == s]) for x in group if script_of(x) != s}
    return _INTO[script]


def in_dominant_script(token: str) -> str | None:
    """A mixed-script token with its other letters as their look-alikes in its dominant script; None if one has none."""
    apart = unicodedata.normalize("NFD", token)
    letters = [(c, script_of(c)) for c in apart if script_of(c)]
    every = Counter(s for _, s in letters)
    sure = Counter(s for c, s in letters if not any(ord(c) in _into(t) for t in every if t != s))
    main = min(every, key=lambda s: (-sure[s], -every[s], s != "LATIN", s))
    form = unicodedata.normalize("NFC", apart.translate(_into(main)))
    return form if scripts(form) == {main} else None


_EDITS = pa.list_(pa.struct([("pos", pa.int32()), ("len", pa.int32()), ("to", pa.string())]))


def _base_part(at: int, names: list[str]):
    """All columns, and of the text in column ``at``: plain form, hash of its skeleton, number of scripts, mixed tokens with their form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms: dict[str, str | None] = {}
        for b in batches:
            bases, looks, kinds, mixed = [], [], [], []
            for t in b.column(at).to_pylist():
                base = None if t is None else plain_form(t)
                found, n = [], 1
                if base and not base.isascii() and _LOOKS.search(base):
                    n = len(scripts(base))
                    if _MIXED.search(base):
                        for m in TOKEN.finditer(base):
                            tok = m[0]
                            if not tok.isascii() and _MIXED.search(tok):
                                if tok not in forms:
                                    if len(forms) > 100_000:
                                        forms.clear()
                                    forms[tok] = in_dominant_script(tok)
                                if forms[tok]:
                                    found.append({"pos": m.start(), "len": len(tok), "to": forms[tok]})
                bases.append(base)
                looks.append(None if base is None else hashlib.md5(skeleton(base).encode("utf-8", "surrogatepass")).digest())
                kinds.append(n)
                mixed.append(found)
            more = [pa.array(bases, pa.string()), pa.array(looks, pa.binary()), pa.array(kinds, pa.int32()), pa.array(mixed, _EDITS)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=names)

    return run


def repaired(base: str, edits: list[dict]) -> str:
    """``base`` with some tokens replaced. ``edits``: pos, len, to."""
    out, at = [], 0
    for e in sorted(edits, key=lambda e: e["pos"]):
        out += [base[at : e["pos"]], e["to"]]
        at = e["pos"] + e["len"]
    return "".join([*out, base[at:]])


def _repair_part(n: int, names: list[str]):
    """The first ``n`` columns, of which the last is the text, repaired by the edits that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, edits = b.column(n - 1).to_pylist(), b.column(n).to_pylist()
            out = [repaired(t, e) if e else t for t, e in zip(base, edits)]
            yield pa.RecordBatch.from_arrays([*b.columns[: n - 1], pa.array(out, pa.string())], names=names)

    return run


def known_forms(texts: DataFrame, wanted: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """to: those of ``wanted`` that are tokens of the texts in plain form (column ``base``)."""
    letters = "".join(f"\\p{{Is{s.title()}}}" for s in _SCRIPTS)
    tokens = texts.select(F.explode(F.array_distinct(F.regexp_extract_all("base", F.lit(f"[{letters}{_MARKS}]+"), F.lit(0)))).alias("to"))
    # few: the texts' tokens are looked up where they are
    hint = F.broadcast if wanted.count() <= broadcast_rows else (lambda d: d)
    return tokens.join(hint(wanted), "to", "left_semi").distinct()


def repaired_texts(df: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The columns of ``df`` under other names (given back too), and repaired, look (hash of the skeleton), n_scripts.

    The vocabulary is that of ``df``'s own texts.
    """
    own = [f"c{i}" for i in range(len(df.columns))]  # names that can't clash with ours
    rows = df.toDF(*own).withColumn("rid", F.monotonically_increasing_id())
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    names = [*rows.columns, "base", "look", "n_scripts", "mixed"]
    kinds = f"{fields}, base string, look binary, n_scripts int, mixed array<struct<pos:int,len:int,to:string>>"
    base = staged(rows.mapInArrow(_base_part(df.columns.index(text), names), kinds), "lookalike-base")
    odd = base.filter(F.size("mixed") > 0)
    each = odd.select("rid", F.explode("mixed").alias("e")).select("rid", "e.*")
    known = known_forms(base.select("base").filter("base is not null"), each.select("to").distinct())
    edits = each.join(known, "to").groupBy("rid").agg(F.collect_list(F.struct("pos", "len", "to")).alias("edits"))
    # only the rows with mixed tokens are gathered by row
    cols = [*own, "look", "n_scripts", "base"]
    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in own)
    fixed = odd.join(edits, "rid", "left").select(*cols, "edits").mapInArrow(_repair_part(len(cols), [*cols[:-1], "repaired"]), f"{kept}, look binary, n_scripts int, repaired string")
    plain = base.filter(F.size("mixed") == 0).select(*cols[:-1], F.col("base").alias("repaired"))
    return plain.unionByName(fixed), own


def one_form(df: DataFrame, form: str, salts: int = 8) -> DataFrame:
    """``df`` with ``form`` replaced by the most frequent one of its ``look``; of equals that of fewest scripts, then the smallest.

    Only looks of several forms are looked up, salted: a look may hold a third of all rows.
    """
    ways = df.filter(F.col("look").isNotNull()).groupBy("look", form).agg(F.count("*").alias("n"), F.min("n_scripts").alias("s"))
    best = ways.groupBy("look").agg(F.min(F.struct((-F.col("n")).alias("n"), "s", F.col(form).alias("best"))).alias("b"), F.count("*").alias("ways")).filter("ways > 1")
    salted = best.select("look", F.col("b.best").alias("_best"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    spread = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    return spread.join(salted, ["look", "_salt"], "left").withColumn(form, F.coalesce("_best", form)).drop("_best", "_salt")


def canonical_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``canonical``."""
    rows, own = repaired_texts(df, text)
    return one_form(rows, "repaired").select(*own, "repaired").toDF(*df.columns, "canonical")


def _hash(c: Column) -> Column:
    return F.md5(F.encode(c, "UTF-8"))


def canonical_keys(df: DataFrame, group: str, key: str, text: str = "text") -> DataFrame:
    """group, id, canonical, raw: hashes of the canonical text and of the text freed of outer white space; no blank or null texts, no null keys."""
    rows, own = repaired_texts(df, text)
    at = {c: own[i] for i, c in enumerate(df.columns)}
    # read twice, so written first: texts are hashed once
    narrow = rows.filter((F.length("repaired") > 0) & F.col(at[key]).isNotNull()).select(
        F.col(at[group]).alias(group), F.col(at[key]).alias("id"), _hash(F.col("repaired")).alias("canonical"),
        _hash(F.regexp_replace(at[text], r"(?U)^\s+|\s+$", "")).alias("raw"), "look", "n_scripts",
    )
    return staged(one_form(staged(narrow, "lookalike-narrow"), "canonical").select(group, "id", "canonical", "raw"), "lookalike-keys")


def _looks_of_variants(rows: DataFrame, group: str) -> DataFrame:
    """group, canonical, n: looks of more than one variant."""
    return rows.select(group, "canonical", "raw").distinct().groupBy(group, "canonical").agg(F.count("*").alias("n_variants")).filter("n_variants > 1")


def same_looking_pairs(rows: DataFrame, group: str) -> DataFrame:
    """group, id_a < id_b: pairs of rows of one group with equal canonical and different text.

    ``rows`` as ``canonical_keys`` gives them. Rows with the very same text are
    one variant: only pairs of different variants are joined, then their rows,
    so the work follows the output even where a third of all rows are one text.
    """
    some = rows.select(group, "canonical", "raw").distinct().join(_looks_of_variants(rows, group).drop("n_variants"), [group, "canonical"])
    pairs = some.join(some.withColumnRenamed("raw", "raw_b"), [group, "canonical"]).filter("raw < raw_b").withColumnRenamed("raw", "raw_a")
    a = rows.select(group, "canonical", F.col("raw").alias("raw_a"), F.col("id").alias("x"))
    b = rows.select(group, "canonical", F.col("raw").alias("raw_b"), F.col("id").alias("y"))
    both = pairs.join(a, [group, "canonical", "raw_a"]).join(b, [group, "canonical", "raw_b"]).filter("x <> y")
    return both.select(group, F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def same_looking_classes(rows: DataFrame, group: str) -> DataFrame:
    """group, id, class_id, n_variants: membership of rows in the classes of texts that look the same though they differ; the smallest id names a class."""
    many = _looks_of_variants(rows, group)
    names = rows.groupBy(group, "canonical").agg(F.min("id").alias("class_id")).join(many, [group, "canonical"])
    return rows.select(group, "canonical", "id").distinct().join(names, [group, "canonical"]).select(group, "id", "class_id", "n_variants")
