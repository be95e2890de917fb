"""Text expressions: terms, boundary-aware search and replacement, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every position at which a term starts: zero-width, so that pairs of ideographs may overlap.
TERM = (
    "(?=([一-鿿]{2}"
    "|(?<![一-鿿])[一-鿿](?![一-鿿])"
    "|(?<![\\p{L}\\p{N}&&[^一-鿿]])[\\p{L}\\p{N}&&[^一-鿿]]+))"
)
#: Shape of a term candidate in running text (fixed value).
CANDIDATE = r"[A-Za-z][A-Za-z0-9+(\-/@_\.]{1,40}[A-Za-z0-9+\)]"
#: Characters that no hot-word may hold (fixed value).
JUNK = "(){}[]\"'`$;|\\=<>#&*!?~^"


def terms_of(text: Column) -> Column:
    """Terms of a text, in order, repeats included: letter and digit runs, and pairs of ideographs."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(1))


def candidates_of(text: Column) -> Column:
    """Term candidates as they stand in the text."""
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def is_term_shape(tok: Column) -> Column:
    """At least two letters, and not a short all-lower-case word."""
    letters = F.regexp_count(tok, F.lit(r"\p{L}"))
    lower = (tok == F.lower(tok)) & (tok != F.upper(tok))
    return (letters >= 2) & ~(lower & (F.length(tok) <= 4))


def is_hotword_shape(tok: Column) -> Column:
    """Free of junk characters, 2 to 25 long, and at least 5 long if it holds a digit."""
    junk = F.length(F.translate(tok, JUNK, "")) < F.length(tok)
    return ~junk & F.length(tok).between(2, 25) & ~(tok.rlike("[0-9]") & (F.length(tok) < 5))


def literal_count(text: Column, term: Column) -> Column:
    """How often ``term`` occurs, not overlapping; 0 for an empty term."""
    gone = F.length(text) - F.length(F.replace(text, term, F.lit("")))
    return F.when(F.length(term) > 0, (gone / F.length(term)).cast("long")).otherwise(F.lit(0).cast("long"))


def quoted(term: Column) -> Column:
    """``term`` as a literal within a regular expression."""
    return F.concat(F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def replace_guarded(text: Column, wrong: Column, right: Column) -> Column:
    """Replace a correction pair.

    A ``wrong`` of ASCII letters, digits, blank, dot, plus and hyphen is
    replaced only where no ASCII letter or digit touches it; any other by plain
    replacement; a single ideograph never. ``right`` is literal.
    """
    word = wrong.rlike(r"^[A-Za-z0-9 .+\-]+$")
    lit = F.replace(F.replace(right, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    at = F.concat(F.lit("(?<![A-Za-z0-9])"), quoted(wrong), F.lit("(?![A-Za-z0-9])"))
    return (
        F.when(wrong.isNull() | right.isNull() | (F.length(wrong) == 0) | wrong.rlike("^[一-鿿]$"), text)
        .when(word, F.regexp_replace(text, at, lit))
        .otherwise(F.replace(text, wrong, right))
    )


def ends_sentence(text: Column, marks: str = "。！？?.!") -> Column:
    """Whether the last character is one of ``marks``."""
    return F.coalesce(F.instr(F.lit(marks), F.right(text, F.lit(1))) > 0, F.lit(False)) & (F.length(text) > 0)


def safe_file_name(name: Column) -> Column:
    """Colon becomes the full-width one, other characters illegal in file names become ``_``."""
    return F.translate(name, '\\/:*?"<>|', "__：______")
