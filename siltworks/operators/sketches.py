"""Mergeable profiles: one row for each column of a run, with sketches, from one pass. Runs are merged without reading their rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import columns as fn
from siltworks.operators.schema import data_columns, quoted

#: Base-two logarithm of a distinct sketch's registers (error some 1.04 / sqrt(2 ** LOG_K)), size of a quantile sketch (rank error some 1.7 / K), tracked values of a top-k sketch.
LOG_K, K, TRACKED = 12, 200, 1000


def column_sketches(df: DataFrame, run: str) -> DataFrame:
    """run, column_name, data_type, rows, filled, numbers, dates, min, max, total, max_length (exact), and sketches of distinct values, numbers and frequent values.

    Numbers and dates are those that the values' text holds. Aggregates are partial in each task; the shuffle gets one row for each task.
    """
    columns, facts = data_columns(df), []
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    for i, c in enumerate(columns):
        t = quoted(c).cast("string")
        n = fn.clean_number(t)
        facts += [F.count(t).alias(f"{i}_filled"), F.count(n).alias(f"{i}_numbers"), F.count(fn.parsed_date(t)).alias(f"{i}_dates"), F.min(n).alias(f"{i}_min"), F.max(n).alias(f"{i}_max"), F.sum(n).alias(f"{i}_total"), F.max(F.length(t)).cast("bigint").alias(f"{i}_length")]
        facts += [F.hll_sketch_agg(t, LOG_K).alias(f"{i}_distinct"), F.kll_sketch_agg_double(n, K).alias(f"{i}_quantiles"), F.call_function("approx_top_k_accumulate", t, F.lit(TRACKED)).alias(f"{i}_top")]
    whole = df.agg(F.count("*").alias("rows"), *facts)
    names = {"filled": "filled", "numbers": "numbers", "dates": "dates", "min": "min", "max": "max", "total": "total", "length": "max_length", "distinct": "distinct_sketch", "quantiles": "quantile_sketch", "top": "top_sketch"}
    rows = [F.struct(F.lit(run).alias("run"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col("rows"), *(F.col(f"{i}_{a}").alias(b) for a, b in names.items())) for i, c in enumerate(columns)]
    return whole.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def merged(profiles: DataFrame) -> DataFrame:
    """One row for each column from those of any number of runs: counts and sums are added, sketches united. The types of all runs are listed."""
    return profiles.groupBy("column_name").agg(
        F.array_sort(F.collect_set("run")).alias("runs"), F.array_sort(F.collect_set("data_type")).alias("data_types"),
        *(F.sum(c).alias(c) for c in ("rows", "filled", "numbers", "dates")), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("total").alias("total"), F.max("max_length").alias("max_length"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.call_function("approx_top_k_combine", "top_sketch", F.lit(TRACKED)).alias("top_sketch"),
    )


def report(profiles: DataFrame, n: int = 5, at: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What merged profiles say: column_name, data_types, rows, null_rate, numeric_rate, date_rate, min, max, mean, max_length (exact), distinct, quantiles, frequent (estimates)."""
    filled, some = F.greatest("filled", F.lit(1)), F.col("numbers") > 0
    quantile = F.array(*(F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))) for q in at))
    frequent = F.filter(F.call_function("approx_top_k_estimate", "top_sketch", F.lit(n)), lambda x: x["item"].isNotNull())
    return profiles.select(
        "column_name", "data_types", "rows", ((F.col("rows") - F.col("filled")) / F.greatest("rows", F.lit(1))).alias("null_rate"), (F.col("numbers") / filled).alias("numeric_rate"), (F.col("dates") / filled).alias("date_rate"),
        "min", "max", F.when(some, F.col("total") / F.col("numbers")).alias("mean"), "max_length", F.hll_sketch_estimate("distinct_sketch").alias("distinct"), F.when(some, quantile).alias("quantiles"), frequent.alias("frequent"),
    )
