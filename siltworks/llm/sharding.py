"""Two-pass external shuffle.

Pass one scatters records uniformly into buckets sized for memory, by a seeded hash of the whole record. Pass two Fisher-Yates
shuffles each bucket in one task and writes it; then the buckets are counted. A record's place in the whole permutation is its bucket's offset
plus its place in the bucket; places are dealt to shards in turn, so shard sizes differ by one record at most
(law ``rows``) and slots have no gaps. Seed and records alone decide the permutation, however the table is split among tasks.

Defined cases: a null text counts as no bytes; equal records fall into one bucket, unless they would fill half of one: then they are
counted, and their copies are dealt one by one by their number; a null key is hashed like any value; very long texts are in one bucket with
others, which is larger by them; an empty table gives no rows; columns named shard or slot are replaced, others may have any name and type.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.llm.common import as_json, packed, stored

#: Bound of the table of bucket offsets, which is broadcast: 16 bytes each.
MAX_BUCKETS = 1 << 20
#: Copies of one record that a task writes out.
COPIES = 4096


def fisher_yates(n: int, seed: tuple[int, ...]) -> np.ndarray:
    """A uniform permutation of range(n)."""
    order = list(range(n))
    at = np.random.default_rng(seed)
    for i, j in zip(range(n - 1, 0, -1), at.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else (), strict=True):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def with_ids(rows: DataFrame, carried: list[str], key: str, text: str) -> DataFrame:
    """The rows with two hashes (a, b) of all that is carried, and their bytes. Which value is null is hashed too."""
    given = [F.col(f"_row.`{c}`") for c in (key, text)]
    others = [F.col(f"_row.`{c}`") for c in carried if c not in (key, text)]
    said = [*given, *(g.isNull() for g in given), *([as_json(others)] if others else [])]
    return rows.select("_row", F.xxhash64(*said).alias("a"), F.xxhash64(F.lit(1), *said).alias("b"), (F.coalesce(F.octet_length(given[1]), F.lit(0)) + F.lit(1)).alias("bytes"))


def external_shuffle(docs: DataFrame, n_shards: int = 8, seed: int = 20, key: str = "doc_id", text: str = "text", bucket_bytes: int = 8 << 20) -> DataFrame:
    """Every record of docs with shard (int) and slot (long)."""
    rows, carried = packed(docs, ("shard", "slot"))
    rows = with_ids(rows, carried, key, text)
    same = stored(rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")))
    size = same.agg(F.sum("bytes")).first()[0] or 1
    n_buckets = min(MAX_BUCKETS, math.ceil(size / bucket_bytes))
    # two for each bucket at most, whatever the input
    hot = same.where((F.col("n") > 1) & (F.col("bytes") >= size / n_buckets / 2)).select("a", "b", "n")
    scattered = rows.drop("bytes").withColumn("copy", F.lit(0).cast("bigint"))
    if n_buckets > 1 and not hot.isEmpty():
        one = rows.join(F.broadcast(hot), ["a", "b"]).groupBy("a", "b").agg(F.any_value("_row").alias("_row"), F.any_value("n").alias("n"))
        blocks = one.withColumn("first", F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)"))).repartition("a", "first")
        copies = blocks.withColumn("copy", F.explode(F.expr(f"sequence(first, least(n, first + {COPIES}) - 1)")))
        scattered = scattered.join(F.broadcast(hot), ["a", "b"], "left_anti").unionByName(copies.drop("n", "first"))
    scattered = scattered.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "a", "b", "copy"), F.lit(n_buckets)).cast("int"))

    def shuffled(key_values: tuple, group: pa.Table) -> pa.Table:
        group = group.take(pa.compute.sort_indices(group.select(["a", "b"]), sort_keys=[("a", "ascending"), ("b", "ascending")]))
        group = group.take(pa.array(fisher_yates(group.num_rows, (seed, key_values[0].as_py()))))
        return group.append_column("place", pa.array(np.arange(group.num_rows), pa.int64()))

    schema = StructType([*scattered.schema.fields]).add("place", "long")
    mixed = stored(scattered.groupBy("bucket").applyInArrow(shuffled, schema).drop("a", "b", "copy"))
    counts = mixed.groupBy("bucket").agg(F.count("*").alias("n"))
    # one row per bucket: MAX_BUCKETS at most, whatever the input
    offsets = counts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("offset"))
    whole = F.col("offset") + F.col("place")
    return mixed.join(F.broadcast(offsets), "bucket").select(*(F.col(f"_row.`{c}`") for c in carried), (whole % n_shards).cast("int").alias("shard"), F.floor(whole / n_shards).alias("slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Writes the shuffled records as Parquet, a folder for each shard, in the order of their slots."""
    mixed = external_shuffle(docs, **options)
    mixed.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
