"""Splitting oversized texts at natural boundaries, with overlap.

One bounded-quantifier regular expression consumes the text: alternatives are
ordered by the strength of the boundary at which they end (end of text,
paragraph, sentence, clause or line, white space, edge of a word, any code
point) and each takes at most the limit less the overlap (the first piece: the
limit). ``regexp_extract_all`` gives the fresh stretches; their running lengths
give the positions, and every piece after the first is preceded by the last
``overlap`` code points of the stretches before it, so it repeats exactly the
last ``overlap`` code points of the piece before. Pieces are put together from
stretches, never cut out of the text again: work grows with a text's length.

A boundary in the second half of the room beats a stronger kind in the first
half; a piece is cut inside a word only if no other place is left. The first
piece has at least ``overlap`` code points, else it couldn't be repeated from.

Defined cases: null and empty texts and texts within the limit give no pieces
with ``oversized_only``, else one piece (none for null); white space is kept,
so the fresh stretches joined are the text; lengths are code points, whatever
a length column says; other columns than key and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = r"\p{L}\p{N}\p{M}"
#: Look-behinds that end a stretch, strongest first.
BOUNDARIES = (
    r"(?<=\n\n|\n\r\n)",
    r"(?<=[。！？!?…｡।؟]|[。！？!?।؟.…][\"”’»」』）)\]])(?![\"”’»」』）)\]。！？!?…])|(?<=[.!?]\s)|(?<=\n)",
    r"(?<=[，、；：,;:،؛]\s?)(?!\d)",
    r"(?<=\s)(?!\s)",
    rf"(?<![{_WORD}])|(?![{_WORD}])",
)

#: Stretches of a running sum's block, and stretches that surely hold the overlap.
BLOCK, LOOKBACK = 64, 12


def pattern(limit: int, overlap: int) -> str:
    """The expression that consumes a text stretch by stretch."""

    def stretch(room: int, least: int) -> str:
        tiers = [rf".{{1,{room}}}\z"]
        for n in (max(room // 2, least), least):
            tiers += [rf".{{{n},{room}}}(?:{b})" for b in BOUNDARIES[:4]]
        tiers += [rf".{{{least},{room}}}(?:{BOUNDARIES[4]})", rf".{{{least},{room}}}"]
        return "|".join(tiers)

    # the first piece must be long enough to be repeated from
    return rf"(?s)\A(?:{stretch(limit, max(1, overlap))})|(?:{stretch(limit - overlap, 1)})"


def is_hard(text: Column, limit: int) -> Column:
    """Whether an unbroken run of letters, digits and marks is itself longer than ``limit``."""
    return text.rlike(rf"[{_WORD}]{{{limit + 1}}}")


def split_texts(
    df: DataFrame, key: str, text: str, limit: int, overlap: int = 50, oversized_only: bool = True
) -> DataFrame:
    """key, piece_no (from 0), begin_pos, end_pos, piece, cut_kind (``hard``, ``soft``, null if whole).

    Needs 0 <= overlap < limit.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    t = F.col("_text")
    src = df.select(F.col(key), F.col(text).alias("_text")).filter(t.isNotNull())
    big = src.filter(F.length(t) > limit).withColumn("_fresh", F.regexp_extract_all(t, F.lit(pattern(limit, overlap)), F.lit(0)))
    big = big.select(key, F.when(is_hard(t, limit), "hard").otherwise("soft").alias("cut_kind"), "_fresh", F.transform("_fresh", lambda x: F.length(x)).alias("_len"))
    # lengths before each block of stretches, so that a running sum needs no more than one block
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, n: x + n)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_len") - 1) / BLOCK).cast("int")), lambda b: total(F.slice("_len", b * BLOCK + 1, BLOCK)))
    before = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    big = big.withColumn("_before", before)

    def piece(i: Column) -> Column:
        b = F.floor((i - 1) / BLOCK).cast("int")
        end = F.element_at("_before", b + 1) + total(F.slice("_len", b * BLOCK + 1, i - b * BLOCK))
        # boundaries of ever weaker kinds may make a few short stretches in a row, then a long one follows
        lookback = F.array_join(F.slice("_fresh", F.greatest(i - LOOKBACK, F.lit(1)), F.least(i - 1, F.lit(LOOKBACK))), "")
        tail = F.when(i > 1, F.right(lookback, F.lit(overlap))).otherwise("") if overlap else F.lit("")
        text_of = F.concat(tail, F.element_at("_fresh", i))
        return F.struct((i - 1).alias("piece_no"), end.cast("long").alias("end_pos"), text_of.alias("piece"))

    out = (
        big.select(key, "cut_kind", F.explode(F.transform(F.sequence(F.lit(1), F.size("_fresh")), piece)).alias("_p"))
        .select(key, "cut_kind", "_p.*")
        .select(key, "piece_no", (F.col("end_pos") - F.length("piece")).alias("begin_pos"), "end_pos", "piece", "cut_kind")
    )
    if not oversized_only:
        small = src.filter(F.length(t) <= limit).select(
            key,
            F.lit(0).alias("piece_no"),
            F.lit(0).cast("long").alias("begin_pos"),
            F.length(t).cast("long").alias("end_pos"),
            t.alias("piece"),
            F.lit(None).cast("string").alias("cut_kind"),
        )
        out = out.unionByName(small)
    return out
