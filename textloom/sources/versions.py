"""A ledger in versions: snapshots named by their content, and manifests that are committed one by one.

A commit writes the new rows to a folder of its own, renames it to the digest of its rows, writes a manifest, and
renames that to the next number, which fails if another writer has taken it. Until that last step nothing that a reader
looks at has changed, so a writer may be lost at any point: readers see the version before. A writer that comes second
applies its change to the new head and tries again, so no rows are lost. Equal content is stored once.

The renames are those of the store; in HDFS each is one atomic step. In a store where a rename is not atomic (or doesn't
mind an existing target), commits need a lock around them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Other writers were first, again and again."""


class VersionedLedger:
    """Versions 1, 2, … below ``path``. Columns are those of the rows that are committed."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path, self._conf = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
        self._store = self._path(self.path).getFileSystem(self._conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._store.getUri(), self._conf)
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        self._exclusive = none
        for folder in ("data", "versions"):
            self._store.mkdirs(self._path(f"{self.path}/{folder}"))

    # --- reading ---

    def versions(self) -> list[int]:
        """The numbers of all committed versions, ascending."""
        names = [s.getPath().getName() for s in self._store.listStatus(self._path(f"{self.path}/versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "_")

    def manifest(self, version: int) -> dict:
        stream = self._store.open(self._path(f"{self.path}/versions/{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version (the last one by default); none if nothing has been committed."""
        known = self.versions()
        if not known:
            return None
        found = self.manifest(known[-1] if version is None else version)
        return self.spark.read.schema(StructType.fromJson(found["schema"])).parquet(f"{self.path}/data/{found['snapshot']}")

    # --- writing ---

    def commit(self, change: Callable[[DataFrame | None], DataFrame], tries: int = 20) -> int:
        """The number of the version that holds ``change`` of the head (none at first)."""
        for _ in range(tries):
            known = self.versions()
            head = known[-1] if known else 0
            rows = change(self.read(head) if head else None)
            snapshot, count = self._snapshot(rows)
            found = {"version": head + 1, "parent": head, "snapshot": snapshot, "rows": count, "schema": rows.schema.jsonValue()}
            if self._publish(head + 1, found):
                return head + 1
        raise Conflict(f"{tries} tries, and another writer came first each time")

    def _snapshot(self, rows: DataFrame) -> tuple[str, int]:
        """Writes rows and names the folder by their digest (of any order of rows)."""
        fresh = f"{self.path}/data/_{uuid.uuid4().hex}"
        rows.write.parquet(fresh)
        stored = self.spark.read.schema(rows.schema).parquet(fresh)
        h = F.xxhash64(*[F.to_json(F.struct(c)) if dict(rows.dtypes)[c].startswith("map") else F.col(c) for c in rows.columns])
        count, *sums = stored.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(h, F.lit(1))), F.bit_xor(F.xxhash64(F.lit(2), h))).first()
        digest = hashlib.sha256(repr((rows.dtypes, count, [str(x) for x in sums])).encode()).hexdigest()[:32]
        target = self._path(f"{self.path}/data/{digest}")
        if self._store.exists(target) or not self._rename(self._path(fresh), target):
            self._store.delete(self._path(fresh), True)  # the same rows are there already
        return digest, count

    def _publish(self, version: int, found: dict) -> bool:
        fresh = self._path(f"{self.path}/versions/_{uuid.uuid4().hex}")
        stream = self._store.create(fresh, False)
        stream.write(bytearray(json.dumps(found).encode()))
        stream.close()
        if self._rename(fresh, self._path(f"{self.path}/versions/{version:012d}.json")):
            return True
        self._store.delete(fresh, False)
        return False

    def _rename(self, source, target) -> bool:
        """Whether the rename was made; not if the target exists."""
        try:
            self._context.rename(source, target, self._exclusive)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True


def merged(key: str, rows: DataFrame) -> Callable[[DataFrame | None], DataFrame]:
    """A change that puts ``rows`` in place of those with their keys and keeps the others."""
    return lambda head: rows if head is None else head.join(rows.select(key), key, "left_anti").select(*rows.columns).unionByName(rows)


def compared(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """``key, status``: same, changed, new or gone, between two versions."""
    a, b = before.select(key, F.col(value).alias("_a"), F.lit(True).alias("_in_a")), after.select(key, F.col(value).alias("_b"), F.lit(True).alias("_in_b"))
    both = a.join(b, key, "full")
    return both.select(key, F.when(F.col("_in_a").isNull(), "new").when(F.col("_in_b").isNull(), "gone").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed").alias("status"))
