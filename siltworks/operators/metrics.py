"""Metrics of validated tables, each by one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators.rules import CRITICAL, MAJOR, WARNING
from siltworks.operators.schema import data_columns, quoted


def percent(part: Column, whole: Column) -> Column:
    return F.round(100 * part / F.greatest(whole, F.lit(1)), 2)


def row_counts(checked: DataFrame) -> DataFrame:
    total, bad = F.count("*"), F.count_if("_is_quarantined")
    return checked.agg(total.alias("total"), (total - bad).alias("valid"), bad.alias("quarantined"), percent(total - bad, total).alias("validity_rate"), percent(bad, total).alias("quarantine_rate"))


def completeness(df: DataFrame) -> DataFrame:
    """column_name, complete: the share of values that aren't NULL, in percent. One pass over the table."""
    columns = data_columns(df)
    counts = df.agg(F.count("*").alias("_n"), *(F.count(quoted(c)).alias(c) for c in columns))
    return counts.unpivot("_n", columns, "column_name", "_filled").select("column_name", percent(F.col("_filled"), F.col("_n")).alias("complete"))


def average_completeness(df: DataFrame) -> DataFrame:
    return completeness(df).agg(F.round(F.avg("complete"), 2).alias("average"))


def violations(checked: DataFrame) -> DataFrame:
    return checked.select("_is_quarantined", F.explode("_violations").alias("v")).select("_is_quarantined", "v.*")


def by_rule(checked: DataFrame, quarantined_only: bool = False) -> DataFrame:
    found = violations(checked.where("_is_quarantined") if quarantined_only else checked)
    return found.groupBy("rule_id").agg(F.count("*").alias("n"))


def by_domain(checked: DataFrame) -> DataFrame:
    return violations(checked).groupBy("domain").agg(F.count("*").alias("n"))


def by_severity(checked: DataFrame) -> DataFrame:
    """One row; a severity that does not occur is 0."""
    count = lambda s: F.coalesce(F.sum(F.size(F.filter("_violations", lambda v: v["severity"] == s))), F.lit(0)).cast("bigint")
    return checked.agg(count(CRITICAL).alias("critical"), count(MAJOR).alias("major"), count(WARNING).alias("warning"))


def top_rules(checked: DataFrame, n: int = 10) -> DataFrame:
    return by_rule(checked).orderBy(F.desc("n"), "rule_id").limit(n)


def confusion(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """tp, fp, fn, tn; truth: a text that starts with VALID, or else tells what is wrong; NULL is invalid."""
    bad = ~F.coalesce(truth.startswith("VALID"), F.lit(False))
    return df.agg(F.count_if(bad & predicted).alias("tp"), F.count_if(~bad & predicted).alias("fp"), F.count_if(bad & ~predicted).alias("fn"), F.count_if(~bad & ~predicted).alias("tn"))


def precision_recall(counts: DataFrame) -> DataFrame:
    """Percentages of confusion(), with a grade."""
    p, r = percent(F.col("tp"), F.col("tp") + F.col("fp")), percent(F.col("tp"), F.col("tp") + F.col("fn"))
    rated = counts.withColumns({"precision": p, "recall": r, "accuracy": percent(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))})
    rated = rated.withColumn("f1", F.round(2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1.0)), 2))
    return rated.withColumn("grade", grade(F.col("precision"), F.col("recall"), F.col("f1")))


def grade(p: Column, r: Column, f: Column) -> Column:
    return F.when((r >= 95) & (p >= 85) & (f >= 90), "A").when((r >= 85) & (p >= 75) & (f >= 80), "B").when((r >= 75) & (p >= 65) & (f >= 70), "C").when((r >= 60) & (f >= 55), "D").otherwise("F")


def error_types(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """error_type, detected, missed."""
    bad = df.where(~F.coalesce(truth.startswith("VALID"), F.lit(False)))
    kind = F.coalesce(F.replace(truth, F.lit("INVALID: "), F.lit("")), F.lit("None"))
    return bad.groupBy(kind.alias("error_type")).agg(F.count_if(predicted).alias("detected"), F.count_if(~predicted).alias("missed"))


def alerts(rates: DataFrame) -> DataFrame:
    """rates: columns quarantine_rate, completeness and recall (NULL where unknown)."""
    q, c, r = F.col("quarantine_rate"), F.col("completeness"), F.col("recall")
    found = F.array(F.when(q > 30, "CRITICAL quarantine").when(q > 10, "WARNING quarantine"), F.when(c < 70, "WARNING completeness"), F.when(r < 80, "CRITICAL recall"))
    return rates.withColumn("alerts", F.array_compact(found))


def global_report(tables: DataFrame) -> DataFrame:
    """tables: one row of row_counts per table, with precision, recall and f1 where known."""
    return tables.agg(
        F.count("*").alias("tables"), F.sum("total").alias("total_rows"), F.sum("valid").alias("valid_rows"), F.sum("quarantined").alias("quarantined_rows"), percent(F.sum("valid"), F.sum("total")).alias("validity_rate"),
        F.round(F.avg("precision"), 2).alias("avg_precision"), F.round(F.avg("recall"), 2).alias("avg_recall"), F.round(F.avg("f1"), 2).alias("avg_f1"),
    )
