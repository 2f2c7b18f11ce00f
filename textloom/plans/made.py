"""Inputs with the features that the tables lack, made from them by one rule, in Spark and in SQL alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import table


class Plans:
    """Queries and oracles of one module, by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, oracle: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if oracle:
                self.oracles[f.__name__] = oracle
            return f

        return add


#: What is put in, so that quotes, marks and house words occur. Nothing of a text goes but ``*`` and backticks, which become ``+``.
SWAPS = [(" the ", " the ấy "), (" la ", " la ấy "), (", ", ', "'), (" of ", " of 'of' "), (" de ", " de 'de' "), (" in ", " in in”. "), (" and ", " and chúng ta "), (" to ", " to Vì vậy ; "), ("*", "+"), ("`", "+")]


def swapped(text: Column) -> Column:
    for a, b in SWAPS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def swapped_sql(text: str) -> str:
    for a, b in SWAPS:
        text = f"replace({text}, {_sql(a)}, {_sql(b)})"
    return text


def marked(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, lang, source, text``: documents as Markdown, with headings, quotes, lists, blank and short lines.

    Lines are wrapped, split and marked; all characters stay.
    """

    def line(x: Column, i: Column) -> Column:
        k = i % 11
        return (
            F.when(k == 3, F.concat(F.lit("## "), x)).when(k.isin(4, 5), F.concat(F.lit("> "), F.regexp_replace(x, r"([^\n]{60})", "$1\n> "))).when(k == 6, F.concat(F.lit("#### "), F.regexp_replace(x, r"^([^\n]{20})", "$1\n")))
            .when(k == 7, F.concat(F.lit("- "), x)).when(k == 8, F.concat(F.lit("\n"), x)).when(k == 9, F.regexp_replace(x, r"^([^\n]{50})", "$1\n")).otherwise(x)
        )

    t = table(spark, d, "documents")
    return t.select("doc_id", "lang", "source", swapped(F.array_join(F.transform(F.split("text", "\n"), line), "\n")).alias("text"))


_QUOTE = r"'> ' || regexp_replace(x, '([^\n]{60})', '\1' || chr(10) || '> ', 'g')"
_LINE = rf"CASE (i - 1) % 11 WHEN 3 THEN '## ' || x WHEN 4 THEN {_QUOTE} WHEN 5 THEN {_QUOTE} WHEN 6 THEN '#### ' || regexp_replace(x, '^([^\n]{{20}})', '\1' || chr(10)) WHEN 7 THEN '- ' || x WHEN 8 THEN chr(10) || x WHEN 9 THEN regexp_replace(x, '^([^\n]{{50}})', '\1' || chr(10)) ELSE x END"
MARKED = f"marked AS (SELECT doc_id, lang, source, {swapped_sql(f'array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {_LINE}), chr(10))')} AS text FROM documents)"
MARKED_LINES = f"{MARKED}, l AS (SELECT doc_id, source, unnest(range(len(ls))) AS k, unnest(ls) AS raw FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM marked))"
