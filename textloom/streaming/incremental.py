"""Structured Streaming forms of the ledgers (an extension; the batch forms are primary)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as X


def text_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New Parquet files of texts as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def first_seen(stream: DataFrame, key: str, text: str, at: str, delay: str = "1 hour") -> DataFrame:
    """Each content hash once within the watermark: ``key, at, hash``."""
    hashed = stream.select(key, at, X.content_hash(F.col(text)).alias("hash"))
    return hashed.withWatermark(at, delay).dropDuplicatesWithinWatermark(["hash"])


def windowed_counts(stream: DataFrame, at: str, kind: str, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts by tumbling or sliding window and kind, late rows up to ``delay``."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    n = stream.withWatermark(at, delay).groupBy(w.alias("w"), kind).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.col("w.start").alias("start"), kind, "n")


def sessions(stream: DataFrame, at: str, user: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Session windows by user."""
    n = stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n"))
    return n.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
