"""Functions that need a program per text: protected rewriting, Markdown, markers, code maps, stacks.

All run as Arrow-batched UDFs; the plain Python functions are the tests' entry.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spans that a sweep must not touch (fixed values of the definition).
FENCE, CODE, QUOTED_ITALIC = r"```.*?```", r"`[^`\n]*`", r"\*[^*\n]*'[^*\n]*\*"
PROTECTED = re.compile(f"{FENCE}|{CODE}|{QUOTED_ITALIC}", re.S)
#: Code points that no text should hold: one that a text lacks marks where its kept segments were.
NONCHARACTERS = [*map(chr, range(0xFDD0, 0xFDF0)), "\uffff", "\ufffe"]


def exposed(span: str) -> bool:
    """An italic span with a letter that carries a mark (other than in transliterations) is a title: no protection."""
    return span.startswith("*") and any(unicodedata.normalize("NFD", c)[1:] or c in "đĐ" for c in span if c.isalpha())


def segments(text: str) -> tuple[list[str], list[str]]:
    """Free and kept segments by turns: one free segment more than kept ones."""
    free, kept, at = [], [], 0
    for m in PROTECTED.finditer(text):
        if not exposed(m[0]):
            free.append(text[at : m.start()])
            kept.append(m[0])
            at = m.end()
    return [*free, text[at:]], kept


def _rewritten(free: list[str], rewrite: Callable[[str], str]) -> list[str]:
    """All free segments rewritten as one text, so that a rewrite sees no segment's edge as a text's; one by one if that can't be told apart again."""
    for mark in NONCHARACTERS:
        if not any(mark in x for x in free):
            out = rewrite(mark.join(free)).split(mark)
            if len(out) == len(free):
                return out
    return [rewrite(x) for x in free]


def front_matter(text: str) -> tuple[str, str]:
    """The leading block between rules, and the rest."""
    m = re.match(r"---\n.*?\n---\n", text, re.S)
    return (m[0], text[m.end() :]) if m else ("", text)


def outside_protected(text: str, rewrite: Callable[[str], str]) -> str:
    """``rewrite`` applied to what lies outside front matter and the protected spans."""
    front, body = front_matter(text or "")
    free, kept = segments(body)
    return front + "".join(a + b for a, b in zip(_rewritten(free, rewrite), [*kept, ""], strict=True))


def protected_udf(rewrite: Callable[[str], str]):
    """A column function that rewrites text outside protected spans."""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else outside_protected(t, rewrite))

    return run


def inline_html(text: str) -> str:
    """Emphasis and code of one block; what stands between backticks is code and nothing else."""
    out = []
    for k, part in enumerate(re.split(r"`([^`]+)`", text)):
        part = html.escape(part, quote=False)
        if k % 2:
            out.append(f"<code>{part}</code>")
        else:
            out.append(re.sub(r"\*([^*]+)\*", r"<em>\1</em>", re.sub(r"\*\*([^*]+)\*\*", r"<strong>\1</strong>", part)))
    return "".join(out)


_LIST = re.compile(r"\s*([-*+]|\d+\.)\s+")


def _block_html(lines: list[str]) -> str:
    """One block of Markdown lines."""
    if all(x.lstrip().startswith(">") for x in lines):
        return "<blockquote>" + "<br>".join(inline_html(re.sub(r"^\s*>\s?", "", x)) for x in lines) + "</blockquote>"
    if len(lines) > 1 and all(x.startswith("|") for x in lines) and re.fullmatch(r"[|\s:-]+", lines[1]):
        cells = lambda x, tag: "".join(f"<{tag}>{inline_html(c.strip())}</{tag}>" for c in x.strip("|").split("|"))
        return "<table><tr>" + cells(lines[0], "th") + "</tr>" + "".join(f"<tr>{cells(x, 'td')}</tr>" for x in lines[2:]) + "</table>"
    if all(_LIST.match(x) for x in lines):
        tag = "ol" if re.match(r"\s*\d", lines[0]) else "ul"
        return f"<{tag}>" + "".join("<li>" + inline_html(_LIST.sub("", x, count=1)) + "</li>" for x in lines) + f"</{tag}>"
    return "<p>" + inline_html("\n".join(lines)) + "</p>"


def markdown_html(text: str) -> str:
    """Fences, headings, rules, quotes, tables, lists and paragraphs to HTML, line by line."""
    out: list[str] = []
    block: list[str] = []
    fence: list[str] | None = None

    def flush() -> None:
        if block:
            out.append(_block_html(block))
            block.clear()

    for line in (text or "").split("\n"):
        if fence is not None:
            if line.startswith("```"):
                out.append("<pre>" + html.escape("\n".join(fence), quote=False) + "</pre>")
                fence = None
            else:
                fence.append(line)
        elif line.startswith("```"):
            flush()
            fence = []
        elif not line.strip():
            flush()
        elif m := re.match(r"(#{1,6})\s+(.*)", line):
            flush()
            out.append(f"<h{len(m[1])}>{inline_html(m[2])}</h{len(m[1])}>")
        elif re.fullmatch(r"\s*(---|\*\*\*|___)\s*", line):
            flush()
            out.append("<hr>")
        else:
            kind = lambda x: ">" if x.lstrip().startswith(">") else "|" if x.startswith("|") else "-" if _LIST.match(x) else ""
            if block and kind(block[-1]) != kind(line):
                flush()
            block.append(line)
    flush()
    if fence is not None:
        out.append("<pre>" + html.escape("\n".join(fence), quote=False) + "</pre>")
    return "\n".join(out)


@F.pandas_udf(T.StringType())
def markdown_to_html(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else markdown_html(t))


def insert_marker(text: str, at: int, marker: str) -> str:
    """A marker at an offset. At a line's start: above a heading, with a blank line; behind a quote or list mark."""
    if at == text.rfind("\n", 0, at) + 1:
        line = text[at:].partition("\n")[0]
        if re.match(r"\s*#", line):
            return f"{text[:at]}{marker}\n\n{text[at:]}"
        if mark := re.match(r"\s*(?:>\s?|(?:[-*+]|\d+[.)])\s+)", line):
            at += mark.end()
    return text[:at] + marker + text[at:]


@F.pandas_udf(T.StringType())
def marker_inserted(texts: pd.Series, ats: pd.Series, markers: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or pd.isna(a) else insert_marker(t, int(a), m) for t, a, m in zip(texts, ats, markers, strict=True)])


def enumerations(text: str, intro: str, classifiers: dict[str, str], default: str, ahead: int = 60) -> str:
    """Rewrites ``intro <number>`` by the first classifier word found within the next characters."""

    def one(m: re.Match) -> str:
        after = text[m.end() : m.end() + ahead].lower()
        found = min(((after.find(k), v) for k, v in classifiers.items() if k in after), default=(0, default))
        return f"{m[1]} {found[1]}"

    return re.sub(rf"({intro}\s+\w+)(?!\w)", one, text or "")


def enumerated(intro: str, classifiers: dict[str, str], default: str, ahead: int = 60):
    """A column function of :func:`enumerations`."""

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else enumerations(t, intro, classifiers, default, ahead))

    return run


def code_map(text: str) -> list[tuple[int, str]]:
    """``(code, unicode)`` of a character map: single entries, ranges, and ranges with arrays."""
    out: list[tuple[int, str]] = []
    decode = lambda h: bytes.fromhex(h).decode("utf-16-be", "replace")
    for kind, body in re.findall(r"begin(bfchar|bfrange)(.*?)endbf", text or "", re.S):
        if kind == "bfchar":
            out += [(int(a, 16), decode(b)) for a, b in re.findall(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", body)]
            continue
        for a, b, target, listed in re.findall(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(?:<([0-9A-Fa-f]+)>|\[([^\]]*)\])", body):
            if target:
                last = decode(target)
                out += [(c, last[:-1] + chr(ord(last[-1]) + c - int(a, 16))) for c in range(int(a, 16), int(b, 16) + 1)]
            else:
                out += [(int(a, 16) + k, decode(h)) for k, h in enumerate(re.findall(r"<([0-9A-Fa-f]+)>", listed))]
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("code", T.IntegerType()), T.StructField("unicode", T.StringType())])))
def code_map_entries(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"code": c, "unicode": u} for c, u in code_map(t)])


# --- syllables and stacks -------------------------------------------------------------------

#: Code ranges (fixed values): base letters, subjoined letters, and the marks between syllables.
BASE_LETTERS = r"\x{0F40}-\x{0F6C}"
SUB_LETTERS = r"\x{0F90}-\x{0FBC}"
SYLLABLE_MARKS = r"[\x{0F0B}\x{0F0D}\x{0F0E}\x{0F11}\x{0F14}\s]+"
#: Letters that only transliterations have (fixed values), as code points.
FOREIGN = r"\x{0F4A}-\x{0F4C}\x{0F4E}\x{0F65}\x{0F91}\x{0F96}\x{0F9A}-\x{0F9C}\x{0F9E}\x{0FB5}\x{0FB7}"
#: Letters that may end a syllable (fixed values).
SUFFIXES = "གངདནབམའརལས"


def syllables(text):
    """Non-empty syllables of a column."""
    return F.filter(F.split(text, SYLLABLE_MARKS), lambda s: s != "")


def stacks(syllable):
    """Letter stacks: a base letter with what is joined below it; joined letters without a base are one too."""
    return F.regexp_extract_all(syllable, F.lit(f"([{BASE_LETTERS}][{SUB_LETTERS}]*|[{SUB_LETTERS}]+)"), F.lit(1))


def among(stack, legal):
    """Whether a stack is legal: a list is looked up by hash, an array column is gone through."""
    return stack.isin(legal) if isinstance(legal, list) else F.array_contains(legal, stack)


def foreign(stack, legal):
    """The stack follows no native rule: it has a foreign letter, or two joined letters that no legal stack has."""
    return stack.rlike(f"[{FOREIGN}]") | ((F.regexp_count(stack, F.lit(f"[{SUB_LETTERS}]")) >= 2) & ~among(stack, legal))


def illegal_stacks(syllable, legal):
    """Stacks outside a legal set (a list or an array column), foreign ones exempt; in order, with repeats.

    No stack holds a mark between syllables, so those of a whole text are those of its syllables.
    """
    return F.filter(stacks(syllable), lambda s: ~among(s, legal) & ~foreign(s, legal))


def final_letter(syllable, suffixes: str = SUFFIXES):
    """The last base letter if there are two and it may end a syllable; null otherwise."""
    found = F.regexp_extract_all(syllable, F.lit(f"([{BASE_LETTERS}])"), F.lit(1))
    last = F.element_at(found, -1)
    return F.when(F.size(found) >= 2, F.when(last.isin(list(suffixes)), last))


def particles(text, finals: str, particles: str, suffixes: str = SUFFIXES):
    """``got, prev``: syllables of a whole text that begin with a particle, and the ``final_letter`` of the one before, where that is among ``finals``.

    The text is read backwards: few letters are particles at a syllable's start, and only what is behind those is looked at.
    """
    mark, rest = f"[{SYLLABLE_MARKS[1:-2]}]", f"[^{SYLLABLE_MARKS[1:-2]}{BASE_LETTERS}]*+"
    asked = "".join(c for c in finals if c in suffixes)
    found = F.regexp_extract_all(F.reverse(text), F.lit(f"[{particles}]{mark}++{rest}[{asked}](?={rest}[{BASE_LETTERS}])"), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.left(x, F.lit(1)).alias("got"), F.right(x, F.lit(1)).alias("prev")))


def legal_stacks(bases: str, heads: dict[str, str], subs: dict[str, str], more: tuple[str, ...] = ()) -> list[str]:
    """Legal stacks by rule: bases; a head over the joined forms of its roots; roots with a letter below; and listed ones.

    ``heads`` maps a head to its roots, ``subs`` a joined letter to the roots that carry it. A base letter's
    joined form is ``SUBJOINED`` code points further on.
    """
    joined = lambda c: chr(ord(c) + SUBJOINED)
    return sorted({*bases, *(h + joined(r) for h, roots in heads.items() for r in roots), *(r + s for s, roots in subs.items() for r in roots), *more})


#: From a base letter to its joined form (fixed value).
SUBJOINED = 0x50
