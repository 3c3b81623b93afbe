"""The same operators on streams: files as they come, metrics per batch, duplicates within a watermark."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltworks.operators import rules


def stream_validated(stream: DataFrame, table: str, active: set[str], as_of: date | None = None) -> DataFrame:
    """Row rules on a stream. Repeated references (BNK-012) need a state: references.stream_validated_all() keeps one."""
    return rules.validated(stream, table, active - {"BNK-012"}, as_of)


def unique_within(stream: DataFrame, keys: list[str], at: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; state older than the watermark is dropped."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed_violations(checked: DataFrame, at: str, width: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Violations by window and rule, late rows up to the watermark included."""
    return checked.withWatermark(at, delay).select(at, F.explode("_violations").alias("v")).groupBy(F.window(at, width), "v.rule_id").agg(F.count("*").alias("n"))


def follow(spark: SparkSession, schema: str, path: str, checkpoint: str, each: Callable[[DataFrame, int], None], fmt: str = "parquet", every: str | None = None, **options) -> StreamingQuery:
    """Runs ``each`` on the files that have come: once for all there are, or again and again."""
    stream = spark.readStream.schema(schema).options(**options).format(fmt).load(path)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()
