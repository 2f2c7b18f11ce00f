"""Web pages to blocks of runs: a forgiving reader of HTML as a Python table function.

``page_blocks`` is called laterally, so a page is read where it lies and its rows go on as a table: one row for
each run of one style, in order. Everything after that (inline marks, Markdown, counts) is SQL over those rows.

The reader never fails: a ``<`` that opens no tag is text, unknown tags say nothing, an end tag without its start is
passed over, and what is left open ends with its container. A paragraph ends where another block begins, a list
item where another begins in the same list, cells and rows likewise; inline styles end with their block.
Scripts, styles, templates and comments are skipped; of the head only the title is kept. White space is one
blank, none at a block's edges, except in ``pre``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.entities import html5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Start and end tags with quoted values, comments, declarations.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>", re.S)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Tags by what they do (fixed values of the format).
SKIPPED = {"script", "style", "template", "noscript", "textarea", "select", "svg", "iframe"}
HEADINGS = {f"h{k}": k for k in range(1, 7)}
STYLES = {"b": "bold", "strong": "bold", "i": "italic", "em": "italic", "code": "code", "tt": "code", "kbd": "code", "a": "link"}
CONTAINERS = {"div", "section", "article", "nav", "header", "footer", "main", "aside", "body", "html", "form", "figure", "figcaption", "dl", "dt", "dd", "address", "center", "fieldset", "details", "summary", "caption", "thead", "tbody", "tfoot", "head"}
LISTS = {"ul", "ol"}
CELLS = {"table", "tr", "td", "th", "thead", "tbody", "tfoot"}

ROW = "block int, kind string, level int, item int, tab int, line int, cell int, run int, text string, bold boolean, italic boolean, code boolean, href string"


@dataclass
class _Open:
    """An open block: what its end tag is, and what its text is."""

    tag: str
    kind: str = "text"
    level: int = 0
    item: int = 0
    cell: tuple[int, int, int] | None = None
    count: int = 0


@dataclass
class Reader:
    """The state between two tags: open blocks, styles, and the runs of the block that is being read."""

    open: list[_Open] = field(default_factory=lambda: [_Open("")])
    styles: list[tuple[str, str]] = field(default_factory=list)
    runs: list[list] = field(default_factory=list)
    blocks: int = 0
    tables: int = 0
    plain: Callable[[str], str] = html.unescape

    def add(self, text: str) -> None:
        style = {name for name, _ in self.styles}
        href = next((value for name, value in reversed(self.styles) if name == "link"), None)
        now = ["bold" in style, "italic" in style, "code" in style, href]
        if self.runs and self.runs[-1][1:] == now:
            self.runs[-1][0] += text
        else:
            self.runs.append([text, *now])

    def flush(self) -> Iterator[tuple]:
        """The runs so far as the rows of a block, if they hold a letter; styles end."""
        here, runs = self.open[-1], self.runs
        self.runs, self.styles = [], []
        if here.kind != "pre":
            blank = True  # at the start, or behind a blank
            for run in runs:
                run[0] = re.sub(r" ?\0 ?", "\n", re.sub(r"[ \t\r\n\f]+", " ", run[0]))
                run[0] = run[0].lstrip(" ") if blank else run[0]
                blank = run[0][-1:] in (" ", "\n") if run[0] else blank
            for run in reversed(runs):
                run[0] = run[0].rstrip(" \n")
                if run[0]:
                    break
            for run in runs:
                run[0] = run[0].lstrip("\n")
                if run[0]:
                    break
        else:
            runs = [[run[0].replace("\0", "\n"), *run[1:]] for run in runs]
        runs = [run for run in runs if run[0]]
        if any(run[0].strip() for run in runs):
            tab, line, cell = here.cell or (None, None, None)
            for k, (text, bold, italic, code, href) in enumerate(runs):
                yield self.blocks, here.kind, here.level, here.item, tab, line, cell, k, text, bold, italic, code, href
            self.blocks += 1

    def start(self, tag: str, rest: str) -> Iterator[tuple]:
        if tag in STYLES:
            link = _HREF.search(rest) if tag == "a" else None
            self.styles.append((STYLES[tag], self.plain(next((g for g in link.groups() if g is not None), "")) if link else None))
        elif tag == "br":
            self.add("\0")
        elif tag == "hr":
            yield from self.leave()
            yield self.blocks, "rule", 0, 0, None, None, None, 0, "", False, False, False, None
            self.blocks += 1
        elif tag == "p" or tag in HEADINGS or tag in ("pre", "blockquote", "li", "table", "tr", "td", "th", "title") or tag in LISTS or tag in CONTAINERS:
            yield from self.leave()
            top = self.open[-1]
            depth = sum(o.tag in LISTS for o in self.open)
            if tag == "li":
                yield from self.close({"li"}, LISTS | {"td", "th"})
                top = self.open[-1]
                top.count += 1
                self.open.append(_Open(tag, "ordered" if top.tag == "ol" else "item", max(depth, 1), top.count, top.cell))
            elif tag == "table":
                self.open.append(_Open(tag, "text", cell=None, item=self.tables))
                self.tables += 1
            elif tag == "tr":
                yield from self.close({"tr"}, {"table"})
                table = next((o for o in reversed(self.open) if o.tag == "table"), self.open[0])
                table.count += 1
                self.open.append(_Open(tag, cell=(table.item, table.count - 1, -1)))
            elif tag in ("td", "th"):
                yield from self.close({"td", "th"}, {"table", "tr"})
                row = next(o for o in reversed(self.open) if o.tag in ("tr", "table", ""))
                if row.tag != "tr":
                    yield from self.start("tr", "")
                    row = self.open[-1]
                row.count += 1
                tab, line, _ = row.cell
                self.open.append(_Open(tag, "head" if tag == "th" else "cell", cell=(tab, line, row.count - 1)))
            elif tag == "blockquote":
                self.open.append(_Open(tag, "quote", sum(o.tag == tag for o in self.open) + 1))
            elif tag in HEADINGS:
                self.open.append(_Open(tag, "heading", HEADINGS[tag], cell=top.cell))
            elif tag in ("pre", "title"):
                self.open.append(_Open(tag, tag, cell=top.cell))
            elif tag == "p":
                inside = top.kind in ("item", "ordered", "quote", "cell", "head")
                self.open.append(_Open(tag, top.kind if inside else "para", top.level, top.item, top.cell))
            else:
                self.open.append(_Open(tag, top.kind if tag not in LISTS else "text", top.level, top.item, top.cell))

    def leave(self) -> Iterator[tuple]:
        """Another block begins: the text so far is one, and a paragraph or heading (always innermost) ends."""
        yield from self.flush()
        if self.open[-1].tag == "p" or self.open[-1].tag in HEADINGS:
            self.open.pop()

    def close(self, tags: set[str], until: set[str]) -> Iterator[tuple]:
        """Ends the innermost of ``tags`` that is open, with what is open in it; not beyond one of ``until``."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                yield from self.flush()
                del self.open[k:]
                return
            if self.open[k].tag in until:
                return

    def end(self, tag: str) -> Iterator[tuple]:
        if tag in STYLES:
            for k in range(len(self.styles) - 1, -1, -1):
                if self.styles[k][0] == STYLES[tag]:
                    del self.styles[k]
                    break
        elif tag in CELLS:
            yield from self.close({tag}, {"table"} - {tag})
        else:  # what stands in a cell doesn't end what the cell stands in
            yield from self.close({tag}, {"td", "th"})


def ended_references(text: str) -> str:
    """Text with its character references decoded, but for those without the semicolon (which pages cut off in the middle have)."""
    return re.sub(r"&(#?[0-9a-zA-Z]+;)", lambda m: html.unescape(m[0]) if m[1][0] == "#" else html5.get(m[1], m[0]), text)


def blocks(page: str | None, lenient: bool = True) -> Iterator[tuple]:
    """Rows of ``ROW`` of a page. ``lenient``: references without their semicolon are decoded as browsers do, else they stay."""
    reader, at, page = Reader(plain=html.unescape if lenient else ended_references), 0, (page or "").replace("\0", "")
    hidden = False  # in the head, but for the title
    while m := _TAG.search(page, at):
        if not hidden or reader.open[-1].tag == "title":
            reader.add(reader.plain(page[at : m.start()]))
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            yield from reader.end(tag)
            hidden = hidden and tag != "head"
        elif tag in SKIPPED:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        else:
            hidden = (hidden or tag == "head") and tag != "body"
            yield from reader.start(tag, m[3])
            if tag == "title":
                end = re.compile(r"</title\s*>|(?=<body)", re.I).search(page, at)
                reader.add(reader.plain(page[at : end.start() if end else len(page)]))
                at = end.end() if end else len(page)
                yield from reader.close({"title"}, set())
    if not hidden:
        reader.add(reader.plain(page[at:]))
    while len(reader.open) > 1:
        yield from reader.flush()
        reader.open.pop()
    yield from reader.flush()


@F.udtf(returnType=ROW)
class PageBlocks:
    """``blocks`` as a table function of a page and whether to be lenient."""

    def eval(self, page: str, lenient: bool) -> Iterator[tuple]:
        yield from blocks(page, lenient)


def page_blocks(pages: DataFrame, key: str, page: str = "html", lenient: bool = True) -> DataFrame:
    """``key`` and the columns of ``ROW``, for every run of every page; pages without a block have no row.

    ``lenient``: references without their semicolon are decoded too.
    """
    return pages.select(key, page).lateralJoin(PageBlocks(F.col(page).outer(), F.lit(lenient))).drop(page)


def page_markdown(rows: DataFrame, key: str) -> DataFrame:
    """``key, text``: the blocks as Markdown, from the rows of :func:`page_blocks`.

    Marks stand inside the blanks of their run; cells of a row are one line, with a rule below the first.
    """
    mark = F.concat(F.when(F.col("bold"), "**").otherwise(""), F.when(F.col("italic"), "*").otherwise(""), F.when(F.col("code"), "`").otherwise(""))
    core = F.regexp_replace(F.trim("text"), r"([*_`|\[\]])", r"\\$1")
    core = F.when(F.trim("text") == "", F.lit("")).otherwise(F.concat(mark, core, F.reverse(mark)))
    core = F.when(F.col("href").isNotNull() & (core != ""), F.concat(F.lit("["), core, F.lit("]("), "href", F.lit(")"))).otherwise(core)
    edge = lambda p: F.regexp_extract("text", p, 1)
    styled = F.concat(edge("^( *)"), core, F.when(F.trim("text") == "", F.lit("")).otherwise(edge("( *)$")))
    runs = rows.select("*", F.when(F.col("kind") == "pre", F.col("text")).otherwise(F.when(F.col("kind") == "rule", F.lit("---")).otherwise(styled)).alias("_run"))
    of = lambda pieces: F.array_join(F.transform(F.array_sort(pieces), lambda x: x["t"]), "")
    inline = runs.groupBy(key, "block", "kind", "level", "item", "tab", "line", "cell").agg(of(F.collect_list(F.struct("run", F.col("_run").alias("t")))).alias("t"))
    indent = F.repeat(F.lit("  "), F.greatest(F.col("level") - 1, F.lit(0)))
    flat = F.replace("t", F.lit("\n"), F.lit(" "))
    line = (
        F.when(F.col("kind") == "title", F.concat(F.lit("---\ntitle: "), flat, F.lit("\n---"))).when(F.col("kind") == "heading", F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), flat))
        .when(F.col("kind") == "item", F.concat(indent, F.lit("- "), flat)).when(F.col("kind") == "ordered", F.concat(indent, F.col("item").cast("string"), F.lit(". "), flat))
        .when(F.col("kind") == "quote", F.concat(F.lit("> "), F.replace("t", F.lit("\n"), F.lit("  \n> ")))).when(F.col("kind") == "pre", F.concat(F.lit("```\n"), "t", F.lit("\n```")))
        .when(F.col("kind") == "para", F.replace("t", F.lit("\n"), F.lit("  \n"))).otherwise(F.when(F.col("kind") == "rule", F.col("t")).otherwise(F.replace("t", F.lit("\n"), F.lit("  \n"))))
    )
    blocks_of = inline.where("tab IS NULL").select(key, "block", line.alias("t"))
    # Cells: those of one place are joined, then those of a row; a table stands where its first block does.
    cells = inline.where("tab IS NOT NULL").groupBy(key, "tab", "line", "cell").agg(F.min("block").alias("block"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", flat.alias("t")))), lambda x: x["t"]), " ").alias("t"))
    lines = cells.groupBy(key, "tab", "line").agg(F.min("block").alias("block"), F.array_sort(F.collect_list(F.struct("cell", "t"))).alias("cells"))
    row = F.concat(F.lit("| "), F.array_join(F.transform("cells", lambda x: x["t"]), " | "), F.lit(" |"))
    tables = lines.groupBy(key, "tab").agg(F.min("block").alias("block"), F.array_sort(F.collect_list(F.struct("line", row.alias("t"), F.size("cells").alias("n")))).alias("rows"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("-|"), F.col("rows")[0]["n"]))
    tables = tables.select(key, "block", F.array_join(F.concat(F.array(F.col("rows")[0]["t"], rule), F.transform(F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0))), lambda x: x["t"])), "\n").alias("t"))
    return blocks_of.unionByName(tables).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "t"))), lambda x: x["t"]), "\n\n").alias("text"))
