"""Session helpers shared by every operator: tables, scratch space and materialisation."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any store Spark knows will do."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: A table in fewer files than there are cores is dealt out if it has more bytes than the first, and at most the second for each core.
SPREAD_BYTES, PIECE_BYTES = 1 << 20, 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df``, on all cores: a small file is often one row group, which only one task can read, so its rows are dealt to others before the work begins.

    Large tables, and those in at least as many files as there are cores, stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if SPREAD_BYTES < size <= cores * PIECE_BYTES and len(df.inputFiles()) < cores else df


def scratch(spark: SparkSession) -> str:
    """The shared folder for cut lineage, one for each application; it goes when the application ends.

    A cluster names it in ``spark.checkpoint.dir``. Only on one machine (tests) may that be unset:
    then a temporary folder is made, once per session, and remembered in the session.
    """
    known = spark.conf.get("textloom.scratch", None)
    if known:
        return known
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local($|\[)", context.master):
            raise RuntimeError("a cluster must name a shared folder in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="textloom-")
    path = f"{root}/textloom/{context.applicationId}"
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(hadoop)
    store.deleteOnExit(hadoop)
    spark.conf.set("textloom.scratch", path)
    return path


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch(spark)}/{tag}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder whose last reader has ended."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialize(df: DataFrame, tag: str = "table", partition_by: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (at ``path`` if given) and read it back.

    The written table survives lost executors, has exact size statistics for the planner and is
    computed once however often it is read. Unless ``remove`` deletes it, it stays until the application ends.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, tag)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scope:
    """Tables that are written for some steps and deleted when those have ended: ``with Scope(spark) as scope: t = scope.keep(df)``.

    What is read from them must be written before the end. Shuffle files of finished queries go with them, as soon
    as the driver has collected its garbage.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, tag: str = "table") -> DataFrame:
        self.paths.append(scratch_path(self.spark, tag))
        return materialize(df, path=self.paths[-1])

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


#: Ids that a broadcast may hold: about 32 MB when built.
BROADCAST_IDS = 500_000


def row_hash(text_col: str) -> Column:
    """With the id, what tells one row from others that repeat its id or have none."""
    return F.xxhash64(F.col(text_col).cast("string"))


def keep_ids(df: DataFrame, ids: DataFrame, col: str, anti: bool = False, ids_col: str | None = None, row: Column | None = None) -> DataFrame:
    """The rows of ``df`` whose ``col`` is in ``ids`` (null equals null), or is not with ``anti``.

    With ``row``, a key of the rows of ``df``, the column ``row`` of ``ids`` must be equal too.

    ``ids`` must be cheap to count (a written table). Up to ``BROADCAST_IDS`` of them are sent to
    the executors, so that the wide rows of ``df`` stay where they are; beyond that both sides are
    shuffled, with the narrow one hashed.
    """
    ids = ids.select(F.col(ids_col or col).alias("_keep_id"), *([] if row is None else [F.col("row").alias("_keep_row")]))
    small = ids.count() <= BROADCAST_IDS
    ids = F.broadcast(ids) if small else ids.hint("shuffle_hash")
    same = df[col].eqNullSafe(ids["_keep_id"])
    if row is not None:
        same &= row == ids["_keep_row"]
    return df.join(ids, same, "left_anti" if anti else "left_semi")


#: More keys than this can't each hold more than one part in as many of all rows.
HOT_KEYS = 1000


def join_groups(df: DataFrame, groups: DataFrame, key: str, weight: str, rows: int, how: str = "left") -> DataFrame:
    """Join (left or inner) of ``df`` with ``groups``, which has one row a ``key`` and how many rows of ``df`` it has.

    Keys that more than one in ``HOT_KEYS`` of all ``rows`` carry are at most ``HOT_KEYS``: they are
    broadcast, so their rows stay where they are. The others are shuffled, none of them hot. Both
    inputs are read several times and should be written tables.
    """
    least = max(100, rows // HOT_KEYS)
    hot = groups.where(F.col(weight) > least)
    if hot.isEmpty():
        return df.join(groups, key, how)
    near = df.join(F.broadcast(hot), key)
    rest = df.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.where(F.col(weight) <= least), key, how)
    return near.unionByName(rest)
