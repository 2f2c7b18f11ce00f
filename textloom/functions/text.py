"""Column functions over text: tokens, sentences, counts, hashes, similarity, typography.

White space is ``\\s`` with Unicode semantics throughout (``(?U)``), so that a no-break space
separates words. All functions but ``suffix_prefix_overlap`` are JVM-side expressions.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = r"(?U)\s+"


def words(text: Column, separators: str = BLANK) -> Column:
    """Non-empty tokens between ``separators``."""
    return F.filter(F.split(text, separators), lambda w: w != "")


def _restorer(mark: str, original: str):
    return lambda piece: F.replace(piece, F.lit(mark), F.lit(original))


#: Abbreviations whose full stops end no sentence, and what does (fixed values).
ABBREVIATIONS = ("v.v.",)
SENTENCE_END = r"[.!?]+[”’\"']?\s+"


def _protected(line: Column, abbreviations: tuple[str, ...]) -> Column:
    """Abbreviations replaced by marks, unless a capital follows: there they end a sentence."""
    for k, a in enumerate(abbreviations):
        line = F.regexp_replace(line, re.escape(a) + r"(?!\s+\p{Lu})", f"\u0002{k}\u0003")
    return line


def split_sentences(paragraph: Column, ends: str = SENTENCE_END, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> Column:
    """Sentences without the marks that end them; those of one character are no sentences."""
    pieces = F.split(_protected(paragraph, abbreviations), ends)
    for k, a in enumerate(abbreviations):
        pieces = F.transform(pieces, _restorer(f"\u0002{k}\u0003", a))
    return F.filter(pieces, lambda p: p.rlike(r"\S\s*\S"))


def sentences(line: Column, abbreviations: tuple[str, ...] = (), closing: str = "[\"”’»)]?") -> Column:
    """Sentences of one line with their marks: after ``.!?`` runs with an optional closing mark, before blanks.

    An abbreviation is protected unless a capital follows. The protection is undone inside the
    pieces, after splitting.
    """
    pieces = F.split(F.regexp_replace(_protected(line, abbreviations), rf"([.!?]+{closing})\s+", "$1\u0001"), "\u0001")
    for k, a in enumerate(abbreviations):
        pieces = F.transform(pieces, _restorer(f"\u0002{k}\u0003", a))
    return F.filter(pieces, lambda p: F.trim(p) != "")


def literal(text: str) -> str:
    """A regex that matches ``text`` itself."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def count_overlapping(text: Column, needle: str) -> Column:
    """Occurrences that may overlap; 0 for an empty needle."""
    return F.regexp_count(text, F.lit(f"(?={literal(needle)})")) if needle else F.lit(0)


def count_literal(text: Column, needle: str) -> Column:
    """Occurrences that don't overlap; 0 for an empty needle."""
    return F.size(F.split(text, literal(needle))) - 1 if needle else F.lit(0)


def count_characters(text: Column, characters: str) -> Column:
    """Occurrences of any of the characters, by the bytes that go with them."""
    gone = [(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))) / len(c.encode()) for c in dict.fromkeys(characters)]
    return reduce(operator.add, gone, F.lit(0)).cast("int")


def count_word(text: Column, word: str) -> Column:
    """Occurrences with no letter on either side."""
    return F.regexp_count(text, F.lit(rf"(?<!\p{{L}}){literal(word)}(?!\p{{L}})"))


def content_hash(text: Column, digits: int = 12) -> Column:
    return F.substring(F.sha1(text), 1, digits)


def index_quantile(values: Column, q: float, form: str = "floor_n") -> Column:
    """A quantile by index into the sorted array; null if empty.

    ``floor_n``: element ``floor(n * q)``; ``floor_n1``: element ``floor((n - 1) * q)``;
    ``clamped``: as ``floor_n``, the last one at most.
    """
    n = F.size(values)
    at = F.floor((n - 1) * q) if form == "floor_n1" else F.floor(n * q)
    return F.get(F.array_sort(values), (F.least(at, n - 1) if form == "clamped" else at).cast("int"))


def token_overlap(a: Column, b: Column, longer_than: int = 2) -> Column:
    """Shared words over the larger set's size; words up to ``longer_than`` letters are ignored."""
    x = F.array_distinct(F.filter(a, lambda w: F.length(w) > longer_than))
    y = F.array_distinct(F.filter(b, lambda w: F.length(w) > longer_than))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y), F.lit(1))


def suffix_prefix_overlap(a: Column, b: Column, low: int = 25, high: int = 300) -> Column:
    """Longest k in [low, high] with the end of a equal to the start of b; 0 if none (see ``seam_text``).

    Wherever the first ``low`` characters of b occur in the end of a, the rest is compared, longest first.
    """

    @F.pandas_udf(T.IntegerType())
    def overlap(ends: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([_overlap(x, y, low) for x, y in zip(ends, starts, strict=True)], dtype="int32")

    return overlap(F.right(a, F.lit(high)), F.left(b, F.lit(high)))


def _overlap(end: str | None, start: str | None, low: int) -> int:
    if end is None or start is None or len(start) < low:
        return 0
    at = end.find(start[:low])
    while at >= 0:
        if start.startswith(end[at:]):
            return len(end) - at
        at = end.find(start[:low], at + 1)
    return 0


def headword(text: Column) -> Column:
    """What stands before the first parenthesis."""
    return F.trim(F.regexp_extract(text, r"^([^(]*)", 1))


#: Words that make a note a constraint (fixed values).
CONSTRAINT = r"\b(NOT|never|Never|do not|Do not|Deliberately|deliberately|distinct|Distinct|reserved|must not|only)\b"


def first_sentence(text: Column, limit: int = 140, binding: Column | None = None, constraint: str = CONSTRAINT) -> Column:
    """A note: whole if it is ``binding`` or states a constraint (a pattern), else its first sentence, cut at ``limit``.

    A sentence ends at a full stop or semicolon before white space or the end of the text, on the first line.
    """
    first = F.regexp_extract(text, r"^(.*?[.;])(?:\s|$)", 1)
    short = F.left(F.trim(F.when(first == "", text).otherwise(first)), F.lit(limit))
    whole = text.rlike(constraint) if binding is None else text.rlike(constraint) | binding
    return F.when(whole, text).otherwise(short)


#: What a quote opens after, besides the start of the text (fixed values).
OPENS_AFTER = r"\s(\[{<«‘“–—:;,\-"


def curly_quotes(text: Column) -> Column:
    """Straight to curly quotes by the character before; doubles first, then singles, which also open after a double's end."""
    # The quote is found first and what precedes it is looked at then: a lookbehind in front is tried at every character.
    text = F.regexp_replace(text, rf"\"(?<![^{OPENS_AFTER}]\")", "“")
    text = F.replace(text, F.lit("\""), F.lit("”"))
    return curly_singles(period_inside_quote(text))


def curly_singles(text: Column) -> Column:
    text = F.regexp_replace(text, rf"'(?<![^{OPENS_AFTER}”]')", "‘")
    return F.replace(text, F.lit("'"), F.lit("’"))


def period_inside_quote(text: Column) -> Column:
    """A full stop after a closing double quote goes before it."""
    return F.replace(text, F.lit("”."), F.lit(".”"))


def respell(text: Column, pairs: dict[str, str], whole_words: bool = True) -> Column:
    """Respelling that keeps lower, capitalised and upper case; of whole words, or anywhere."""
    for old, new in sorted(pairs.items(), key=lambda p: (-len(p[0]), p[0])):
        for a, b in dict.fromkeys([(old.lower(), new.lower()), (old.capitalize(), new.capitalize()), (old.upper(), new.upper())]):
            pattern = rf"(?<!\p{{L}}){literal(a)}(?!\p{{L}})" if whole_words else literal(a)
            text = F.regexp_replace(text, pattern, b.replace("\\", "\\\\").replace("$", r"\$"))
    return text


def dehyphenate(text: Column, compounds: list[str]) -> Column:
    """Enumerated hyphenated forms, in any case, lose their hyphens, longest first, between non-letters."""
    for c in sorted(dict.fromkeys(compounds), key=lambda c: (-len(c), c)):
        parts = c.split("-")
        pattern = "-".join(f"({literal(p)})" for p in parts)
        text = F.regexp_replace(text, rf"(?iu)(?<!\p{{L}}){pattern}(?!\p{{L}})", " ".join(f"${k}" for k in range(1, len(parts) + 1)))
    return text


def tidy_title(title: Column) -> Column:
    """A title without the full stops and blanks of its leader."""
    return F.trim(F.regexp_replace(title, r"(?U)[\s.]+$", ""))


def title_key(title: Column) -> Column:
    """What titles are compared by: no closing marks, no white space."""
    return F.regexp_replace(F.regexp_replace(title, r"(?U)[\x{0F0D}\s\x{0F0B}]+$", ""), r"(?U)\s+", "")


def ends_phrase(line: Column) -> Column:
    """The line stops at a phrase boundary."""
    return F.rtrim(line).rlike(r"[,.;:!?…—–\"'»)\]]$")


def hanging(paragraph: Column) -> Column:
    """A prose paragraph that ends without a closing mark; headings, quotes and lists don't count."""
    t = F.regexp_replace(paragraph, r"^\s+|\s+$", "")
    prose = (t != "") & ~t.rlike(r"^(#{1,6}\s|>|[-*+\d])")
    return prose & ~t.rlike(r"[.!?:;\"'’”»)\]…*]$")


def progress_bar(done: Column, total: Column, width: int = 20) -> Column:
    """Filled and empty cells by share; empty if there is nothing to do."""
    filled = F.when(total > 0, F.round(done * width / total)).otherwise(F.lit(0)).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled))


def line_kind(line: Column) -> Column:
    """Kind of a Markdown line: quote, fence, blank, other (heading, list, table, rule, indented code) or text."""
    return (
        F.when(line.rlike(r"^\s*>"), "quote").when(line.rlike(r"^\s*(#|[-*+]\s|\d+[.)]\s|\|)"), "other").when(line.rlike(r"^\s*(```|~~~)"), "fence")
        .when(line.rlike(r"^\s*$"), "blank").when(line.rlike(r"^\s*(---|\*\*\*|___)\s*$"), "other").when(line.rlike(r"^\s{4,}\S"), "other").otherwise("text")
    )


def paragraph_kind(text: Column, size: Column, bold: Column, indent: Column, body: float, limit: int = 76) -> Column:
    """Kind of a paragraph by its type: h1, bullet, h2, verse, signature or body.

    ``size`` and ``body`` are type sizes, ``bold`` tells whether all of it is bold, ``indent`` is its left indent.
    """
    short = F.length(text) < limit
    return (
        F.when((size >= body + 4) & short, "h1").when(text.rlike(r"^\s*[•·–-]\s"), "bullet").when(bold & short & (size >= body), "h2")
        .when((indent > 0) & short & ~text.rlike(r"[.!?]\s*$"), "verse").when((indent > 0) & short, "signature").otherwise("body")
    )


CUT = "⟪⟫"


def locator_at(text: Column, locator: Column) -> Column:
    """Place (from 1) of a locator that occurs exactly once, or of its cut mark if it has one; null otherwise."""
    needle = F.replace(locator, F.lit(CUT), F.lit(""))
    hits = (F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.nullif(F.length(needle), F.lit(0))
    cut = F.greatest(F.instr(locator, CUT) - 1, F.lit(0))
    return F.when(hits == 1, F.instr(text, needle) + cut)


def seam_text(text: Column) -> Column:
    """Text as seams are compared: no quote marks at line starts, white space as single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?m)^[ \t]*>[ \t]?", ""), r"\s+", " "))


def first_difference(a: Column, b: Column) -> Column:
    """Place (from 1) of the first character that differs; null if the texts are equal. By halving."""
    n = F.least(F.length(a), F.length(b))
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"] + 1) / 2).cast("int")
        same = F.left(a, mid) == F.left(b, mid)
        return F.struct(F.when(same, mid).otherwise(s["lo"]).alias("lo"), F.when(same, s["hi"]).otherwise(mid - 1).alias("hi"))

    return F.when(a != b, F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, step, lambda s: s["lo"] + 1))


def strip_front_matter(text: Column) -> Column:
    """CRLF to LF, then the leading ``---`` block away."""
    return F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\A---\n(?s:.*?)\n---\n", "")


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def entity_decode(text: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
