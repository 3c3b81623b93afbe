"""Column profiles: one aggregation over the table, then one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import columns as fn
from siltworks.functions import names
from siltworks.operators.schema import data_columns, quoted

#: Bound of the values that are kept per column.
SAMPLES, CATEGORIES = 5, 20


def column_profiles(df: DataFrame, distinct_exact: bool = False) -> DataFrame:
    """column_name, null_percent, numeric, min, max, mean, likely_epoch, is_date, unique_rate, max_length, categorical, categories.

    distinct_exact: by default HyperLogLog; exact counts shuffle every value of every column.
    """
    columns, facts = data_columns(df), []
    for i, c in enumerate(columns):
        t = quoted(c).cast("string")
        n = fn.clean_number(t)
        distinct = F.count_distinct(t) if distinct_exact else F.approx_count_distinct(t)
        facts += [F.count(t).alias(f"{i}_filled"), F.count(n).alias(f"{i}_numbers"), F.min(n).alias(f"{i}_min"), F.max(n).alias(f"{i}_max"), F.avg(n).alias(f"{i}_mean"), F.count(fn.parsed_date(t)).alias(f"{i}_dates"), distinct.alias(f"{i}_distinct"), F.max(F.length(t)).alias(f"{i}_length")]
    row = df.agg(F.count("*").alias("rows"), *facts)
    rows = []
    for i, c in enumerate(columns):
        f = lambda x, i=i: F.col(f"{i}_{x}")
        filled = F.greatest(f("filled"), F.lit(1))
        numeric = f("numbers") / filled > 0.8
        unique = F.round(f("distinct") / filled, 3)
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.round(100 * (F.col("rows") - f("filled")) / F.greatest("rows", F.lit(1)), 2).alias("null_percent"), numeric.alias("numeric"),
            F.when(numeric, f("min")).alias("min"), F.when(numeric, f("max")).alias("max"), F.when(numeric, F.round(f("mean"), 4)).alias("mean"),
            (numeric & (f("min") > 1e9) & F.lit(not names.is_financial(c))).alias("likely_epoch"), (~numeric & ((f("dates") / filled > 0.6) | F.lit(names.is_date(c)))).alias("is_date"),
            unique.alias("unique_rate"), f("length").cast("bigint").alias("max_length"), (~numeric & (unique < 0.1) & (f("distinct") <= CATEGORIES)).alias("categorical"),
        ))
    return row.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def values(df: DataFrame, n: int = SAMPLES) -> DataFrame:
    """column_name, value, n: the most frequent values of each column, as text. One pass, pre-aggregated before the shuffle."""
    columns = data_columns(df)
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("value")) for c in columns))).alias("v")).select("v.*").where("value is not null")
    counted = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    # a bounded number of values for each column is kept by each task before columns are brought together
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "value"))), 1, n)
    parts = counted.groupBy("column_name", F.pmod(F.xxhash64("value"), F.lit(1024)).alias("part")).agg(best.alias("best")).select("column_name", F.explode("best").alias("b"))
    top = parts.groupBy("column_name").agg(F.slice(F.sort_array(F.collect_list("b")), 1, n).alias("best"))
    return top.select("column_name", F.explode("best").alias("b")).select("column_name", "b.value", (-F.col("b.m")).alias("n"))


def categories(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values of a column."""
    return df.where(quoted(column).isNotNull()).groupBy(quoted(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def sample(df: DataFrame, key: str, n: int = 100, seed: int = 42) -> DataFrame:
    """n rows in the order of a seeded hash of the key: the same in every run."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), quoted(key).cast("string"))), key).limit(n)
