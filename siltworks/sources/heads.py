"""What files look like before they are read: one distributed pass over their lines, however many files there are."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines_of(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """value, file and at: every line with its file and its place, which orders the lines of a file."""
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n"))
    return spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), at.alias("at"))


def heads(spark: SparkSession, paths: Iterable[str], **facts: Column) -> list[dict]:
    """For each file with a line that isn't blank: path, its first such line as bytes (``head``), and aggregates over its lines. Firsts and
    aggregates are found in each task before the shuffle, which gets a row for each file and task.
    """
    filled = F.col("value").rlike(r"[^\s\ufeff]")
    first = F.min_by(F.when(filled, F.col("value").cast("binary")), F.when(filled, F.col("at")))
    found = lines_of(spark, paths).groupBy("file").agg(first.alias("head"), *(c.alias(n) for n, c in facts.items())).where("head is not null").orderBy("file")
    return [r.asDict() | {"path": unquote(r["file"]), "head": bytes(r["head"])} for r in found.collect()]
