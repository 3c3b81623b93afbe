"""Which groups of sources have changed, and the latest run of each table: joins instead of loops over state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_hashes(files: DataFrame, group: str = "group_key", path: str = "path", content: str = "content") -> DataFrame:
    """group, hash: over path, MD5 of the content and length of each file, as hashes_of_digests() joins them."""
    return hashes_of_digests(files.select(F.col(group).alias("group_key"), F.col(path).cast("string").alias("path"), F.md5(content).alias("digest"), F.octet_length(content).cast("string").alias("bytes"))).withColumnRenamed("group_key", group)


def hashes_of_digests(files: DataFrame) -> DataFrame:
    """The same from rows of group_key, path, digest and bytes, as a tree: files fall into 4,096 parts of their group by the MD5 of their path, each part's
    lines are hashed in the order of the paths, and then the parts' hashes in the order of the parts. So no task brings a group's files together.
    """
    line = F.concat("path", F.lit(":"), "digest", F.lit(":"), "bytes", F.lit(";"))
    in_order = lambda key, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v")))), lambda x: x["v"]), "")
    rows = files.select("group_key", F.substring(F.md5("path"), 1, 3).alias("part"), F.col("path").alias("_key"), line.alias("_line"))
    parts = rows.groupBy("group_key", "part").agg(F.md5(in_order("_key", "_line")).alias("_hash"))
    return parts.groupBy("group_key").agg(F.md5(in_order("part", "_hash")).alias("hash"))


def changes(current: DataFrame, previous: DataFrame, key: str = "group_key", value: str = "hash") -> DataFrame:
    """key, status: NEW, MODIFIED, UNCHANGED or REMOVED."""
    old = previous.select(F.col(key), F.col(value).alias("_old"))
    joined = current.select(F.col(key), F.col(value).alias("_new")).join(old, key, "full_outer")
    status = F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "REMOVED").when(F.col("_new") != F.col("_old"), "MODIFIED").otherwise("UNCHANGED")
    return joined.select(key, status.alias("status"))


def to_process(latest: DataFrame, done: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """Tables whose latest path isn't the one done: keys, path, status (NEW or UPDATED)."""
    old = done.select(*keys, F.col(path).alias("_old"))
    joined = latest.join(old, keys, "left")
    return joined.where(F.col("_old").isNull() | (F.col("_old") != F.col(path))).select(*keys, path, F.when(F.col("_old").isNull(), "NEW").otherwise("UPDATED").alias("status"))


def latest_runs(runs: DataFrame, keys: list[str], at: str = "run_at", path: str = "path") -> DataFrame:
    return runs.groupBy(*keys).agg(F.max_by(path, at).alias(path), F.max(at).alias(at))
