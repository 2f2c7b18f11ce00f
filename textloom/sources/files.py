"""File sources and sinks: page texts, JSON arrays, journals, Markdown chunks, ledgers and views.

Every reader takes what Spark's readers take (globs, remote stores) and keeps the file name, since
page and chunk numbers live there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyarrow.fs import LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as X


def _number(pattern: str = r"(\d+)\.[^./]*$"):
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("int")


NAME = r"(\d+)\.[^./]*$"


#: Into how many tasks Spark deals the listing of folders.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _tasks(spark: SparkSession) -> int:
    """Tasks for many small files: by itself Spark would make one for a folder, or for a few files."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def _whole(spark: SparkSession, path: str, below: bool) -> DataFrame:
    """Whole-text files at ``path``, or with ``below`` all under that folder, whose folders Spark lists in tasks (a glob is resolved by the driver)."""
    if not below:
        return spark.read.text(path, wholetext=True)
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(_tasks(spark)))
    try:
        return spark.read.text(path, wholetext=True, recursiveFileLookup=True).coalesce(_tasks(spark))
    finally:
        spark.conf.set(LISTING, before)


def page_texts(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, number: str = NAME, below: bool = False) -> DataFrame:
    """``page, text`` of whole-text files; the page number is in the file's path (``number``); missing files are skipped."""
    pages = _whole(spark, path, below).select(_number(number).alias("page"), F.col("value").alias("text"))
    if first is not None:
        pages = pages.where(F.col("page") >= first)
    return pages if last is None else pages.where(F.col("page") <= last)


def paragraphs(pages: DataFrame) -> DataFrame:
    """``page, para (from 0), text`` between blank lines."""
    parts = F.filter(F.split("text", r"\n\s*\n"), lambda p: F.trim(p) != "")
    return pages.select("page", F.posexplode(parts).alias("para", "text"))


def json_arrays(spark: SparkSession, path: str, schema: str, number: str = NAME, below: bool = False) -> DataFrame:
    """Rows of files that hold one JSON array each, with ``page`` and ``ord``, the order in the file."""
    raw = _whole(spark, path, below).select(_number(number).alias("page"), F.col("value"))
    rows = raw.select("page", F.posexplode(F.from_json("value", f"array<struct<{schema}>>")).alias("ord", "r"))
    return rows.select("page", "ord", "r.*")


def journal(spark: SparkSession, path: str, schema: str, name: str = "*.jsonl", depth: int = 4) -> DataFrame:
    """Rows of JSONL journals below ``path`` (at most ``depth`` folders down) whose ``type`` is result; blank, malformed and
    other lines are skipped. Folders are listed level by level, so files further down aren't even listed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    levels = [f"{path.rstrip('/')}/{'*/' * k}{name}" for k in range(depth + 1)]
    store = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [level for level in levels if store.globStatus(hadoop(level))]
    lines = spark.read.text(found) if found else spark.createDataFrame([], "value string")
    parsed = lines.select(F.from_json("value", f"type string, result struct<{schema}>", {"mode": "PERMISSIVE"}).alias("j"))
    return parsed.where("j.type = 'result' AND j.result IS NOT NULL").select("j.result.*")


def markdown_chunks(spark: SparkSession, path: str, name: str = r"([^/]+)\.md$") -> DataFrame:
    """``chunk, front, body`` of Markdown files with a front matter block; CRLF becomes LF. ``name`` finds the chunk in the path."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), name, 1).alias("chunk"), F.replace("value", F.lit("\r\n"), F.lit("\n")).alias("t"))
    front = F.regexp_extract("t", r"\A---\n((?s:.*?))\n---\n", 1)
    pairs = F.map_from_entries(F.transform(F.filter(F.split(front, "\n"), lambda x: x.contains(":")), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), F.trim(F.regexp_replace(x, r"^[^:]*:", "")))))
    return raw.select("chunk", pairs.alias("front"), X.strip_front_matter(F.col("t")).alias("body"))


def lexicon_units(words: DataFrame, column: str, separators: str) -> DataFrame:
    """Distinct parts of lexicon words: ``unit``."""
    return words.select(F.explode(X.words(F.col(column), separators)).alias("unit")).distinct()


# --- sinks ----------------------------------------------------------------------------------


@dataclass
class Plan:
    """A write that has not happened: what would be written where."""

    df: DataFrame
    path: str
    kind: str = "parquet"
    partition_by: tuple[str, ...] = ()
    mode: str = "errorifexists"
    options: dict[str, str] = field(default_factory=dict)

    def write(self) -> None:
        w = self.df.write.mode(self.mode).options(**self.options).partitionBy(*self.partition_by)
        w.text(self.path) if self.kind == "text" else w.format(self.kind).save(self.path)


def ledger(df: DataFrame, path: str, recorded: DataFrame | None = None, key: str | None = None, force: bool = False) -> Plan:
    """A ledger rewrite that refuses to drop recorded keys unless forced."""
    if recorded is not None and key and not force and not recorded.select(key).join(df.select(key), key, "left_anti").isEmpty():
        raise ValueError("the new ledger lacks keys that are recorded")
    return Plan(df, path, "json", mode="overwrite" if force else "errorifexists")


def view_per_key(df: DataFrame, path: str, key: str, line) -> Plan:
    """One text view a key: ``line`` is a column; files are partitioned by the key.

    There are as many files as keys, so tasks move their own into place; the driver, which else does, would move one after the other.
    """
    options = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    return Views(df.select(key, line.alias("value")).repartition(_tasks(df.sparkSession), key), path, "text", (key,), options=options)


#: What Spark escapes in the names of partition folders.
_ESCAPED = {c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}


def _view_files(folder: str, key: str):
    """Writes a file for each run of equal keys, under another name until it is whole, so a task that runs twice leaves one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, n, escaped, part = LocalFileSystem(), 0, str.maketrans(_ESCAPED), TaskContext.get().partitionId()
        rows = ((k, v) for batch in batches for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for k, same in groupby(rows, key=lambda r: r[0]):
            place = f"{folder}/{key}={k.translate(escaped) if k else '__HIVE_DEFAULT_PARTITION__'}"
            store.create_dir(place)
            aside = f"{place}/.{uuid.uuid4().hex}"
            with store.open_output_stream(aside) as out:
                for _, value in same:
                    out.write(((value or "") + "\n").encode())
            store.move(aside, f"{place}/part-{part:05d}.txt")
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return run


class Views(Plan):
    """Text views, laid out as Spark's writer does (``key=value/part-...``). On a mounted folder tasks make the files themselves: Hadoop's local store,
    if its native library is missing, starts a process for each folder and file that it makes, to set permissions. Any other store is left to Spark's writer."""

    def write(self) -> None:
        spark, (key,) = self.df.sparkSession, self.partition_by
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.getScheme() != "file" or self.mode not in ("errorifexists", "overwrite"):
            return super().write()
        if store.exists(path):
            if self.mode == "errorifexists":
                raise FileExistsError(self.path)
            store.delete(path, True)
        store.mkdirs(path)
        folder = store.makeQualified(path).toUri().getPath()
        # An empty key is written as none is: in one task they are one run.
        rows = self.df.select(F.nullif(F.col(key).cast("string"), F.lit("")).alias(key), "value").sortWithinPartitions(key)
        rows.mapInArrow(_view_files(folder, key), "n long").write.format("noop").mode("overwrite").save()


def whole_book(pages: DataFrame, span: int = 1000) -> DataFrame:
    """Pages joined in order with page comments: one text per ``span`` pages, ``part, text``."""
    row = F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n"), F.col("text"))
    parts = F.array_sort(F.collect_list(F.struct("page", row.alias("t"))))
    return pages.groupBy(F.expr(f"page div {span}").alias("part")).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n\n").alias("text"))


def fixed_width(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """``line``: the columns padded to fixed widths (numbers to the right)."""
    kinds = dict(df.dtypes)
    cells = [F.rpad(F.col(c), w, " ") if kinds[c] == "string" else F.lpad(F.col(c).cast("string"), w, " ") for c, w in widths.items()]
    return df.select(F.concat_ws(" ", *cells).alias("line"))


def status_document(tables: dict[str, DataFrame], title: str, most: int = 200) -> str:
    """A Markdown status document: a heading and a table for each small aggregate (at most ``most`` rows each, checked)."""
    out = [f"# {title}"]
    for name, counts in tables.items():
        rows = counts.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError("a status document shows small aggregates only")
        out += ["", f"## {name}", "", "| " + " | ".join(counts.columns) + " |", "|" + "-|" * len(counts.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]
    return "\n".join(out) + "\n"


def swap(plan: Plan, spark: SparkSession) -> None:
    """Rewrites a folder by way of a new one beside it.

    The old one is set aside before the new one takes its name and goes last, so the rows are never without a complete
    folder: a driver lost in between leaves ``.new`` or ``.old`` beside it. For readers that must not notice, see ``versions``.
    """
    name = plan.path.rstrip("/")
    fresh, aside = f"{name}.new", f"{name}.old"
    Plan(plan.df, fresh, plan.kind, plan.partition_by, "overwrite").write()
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(name).getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(path(aside), True)
    if store.exists(path(name)):
        store.rename(path(name), path(aside))
    store.rename(path(fresh), path(name))
    store.delete(path(aside), True)
