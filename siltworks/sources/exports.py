"""Metrics as text: Prometheus lines, log lines and JSON reports, written and read as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.columns import labels, metric_name

EVENT = "event string, timestamp string, group_key string, table_name string, source_type string, rows_input bigint, rows_output bigint, rows_quarantined bigint, duration_seconds double, success boolean, error string"
LINE = r"^([a-zA-Z_][a-zA-Z0-9_]*)\{([^}]*)\}\s+([-+0-9.eE]+|NaN)\s*$"


def prometheus_lines(metrics: DataFrame, name: str, value: str, label_columns: list[str]) -> DataFrame:
    """One line of text for each row: ``name{a="b"} value``."""
    pairs = F.concat_ws(",", *(F.concat(F.lit(f'{c}="'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) for c in label_columns))
    return metrics.select(F.concat(metric_name(F.col(name)), F.lit("{"), pairs, F.lit("} "), F.col(value).cast("string")).alias("line"))


def parsed_prometheus(lines: DataFrame, column: str = "value") -> DataFrame:
    """name, labels (map), value; comments and other lines are left out."""
    c = F.col(column)
    return lines.where(c.rlike(LINE)).select(F.regexp_extract(c, LINE, 1).alias("name"), labels(F.regexp_extract(c, LINE, 2)).alias("labels"), F.regexp_extract(c, LINE, 3).cast("double").alias("metric"))


def metric_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """The JSON events that log lines carry after ``METRICS:``; broken ones are left out."""
    found = F.from_json(F.regexp_extract(column, r"METRICS:\s*(\{.*\})", 1), EVENT)
    return lines.where(F.col(column).contains("METRICS:")).select(found.alias("e")).where("e.event is not null").select("e.*")


def log_summary(lines: DataFrame, column: str = "value") -> DataFrame:
    """total_seconds, ok and failed of a run, as its log ends say; NULL where missing."""
    number = lambda pattern, group: F.max(F.nullif(F.regexp_extract(column, pattern, group), F.lit("")).try_cast("double"))
    results = r"(?i)r.sultats\s*:\s*(\d+)\s*ok\s*/\s*(\d+)"
    return lines.agg(number(r"Temps total[^:]*:\s*([0-9.]+)\s*s", 1).alias("total_seconds"), number(results, 1).cast("bigint").alias("ok"), number(results, 2).cast("bigint").alias("failed"))


def run_totals(events: DataFrame) -> DataFrame:
    """Sums over the tables' events, with the quarantine rate."""
    sums = events.agg(F.count("*").alias("tables"), F.sum("rows_input").alias("rows_in"), F.sum("rows_output").alias("rows_out"), F.sum("rows_quarantined").alias("rows_quarantined"), F.count_if("success").alias("ok"))
    return sums.withColumn("quarantine_rate", F.round(100 * F.col("rows_quarantined") / F.greatest("rows_in", F.lit(1)), 2))


def newest_files(df: DataFrame, key: str) -> DataFrame:
    """Of rows read with file metadata, those of each key's newest file."""
    newest = df.groupBy(key).agg(F.max_by("_metadata.file_path", "_metadata.file_modification_time").alias("_newest"))
    return df.withColumn("_path", F.col("_metadata.file_path")).join(F.broadcast(newest), key).where("_path = _newest").drop("_path", "_newest")


def gauges(spark: SparkSession, clean_out: str, validated_out: str) -> DataFrame:
    """line: gauges of the last clean run (from its event lines) and of the newest table reports, as Prometheus text."""
    events = metric_events(spark.read.text(f"{clean_out}/logs"))
    last = events.join(events.agg(F.max("timestamp").alias("timestamp")), "timestamp")
    totals = run_totals(last).unpivot([], ["tables", "rows_in", "rows_out", "rows_quarantined", "ok", "quarantine_rate"], "name", "value")
    said = totals.select(F.concat(F.lit("clean_last_"), "name").alias("name"), F.lit("all").alias("table"), F.col("value").cast("double"))
    reports = spark.read.schema("table string, key string, total double, valid double, quarantined double, validity_rate double, completeness double, precision double, recall double, f1 double").json(f"{validated_out}/reports/tables/*")
    measures = ["total", "valid", "quarantined", "validity_rate", "completeness", "precision", "recall", "f1"]
    newest = newest_files(reports.select("*", "_metadata"), "key").unpivot(["table"], measures, "name", "value").where("value is not null")
    return prometheus_lines(said.unionByName(newest.select(F.concat(F.lit("validated_last_"), "name").alias("name"), "table", "value")), "name", "value", ["table"])
