"""Conditions of rule documents, resolved against a table before anything runs: each bad one is told alone, the others apply."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

PREFIX = "_condition_"
#: How a resolved plan names subqueries.
SUBQUERY = re.compile(r"\b(list|exists|[a-z]+-subquery)#\d")


@dataclass(frozen=True)
class Condition:
    """A rule whose violation a SQL condition tells."""

    rule_id: str
    sql: str
    severity: str = "MAJOR"
    column: str = ""


@contextmanager
def lenient(spark: SparkSession) -> Iterator[None]:
    """Expressions that are resolved inside give NULL where a value doesn't fit, also when they run later: one dirty value ends no job."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def resolved(df: DataFrame, conditions: list[Condition]) -> tuple[DataFrame, list[tuple[Condition, Column]], list[dict]]:
    """df with a boolean column for each condition that resolves, the conditions with their columns, and what is wrong with the others (rule_id, error).

    A condition is one boolean expression on the table's columns: no aggregate, window, generator or subquery, which don't belong to a row.
    """
    good, bad = [], []
    with lenient(df.sparkSession):
        own = df
        for i, c in enumerate(conditions):
            try:
                if not str(c.sql).strip():
                    raise ValueError("the condition is empty")
                if c.severity not in ("WARNING", "MAJOR", "CRITICAL"):
                    raise ValueError(f"unknown severity {c.severity}")
                said = F.expr(c.sql)
                if not isinstance(kind := df.select(said.alias("c")).schema["c"].dataType, BooleanType):
                    raise ValueError(f"the condition is {kind.simpleString()}, not boolean")
                if SUBQUERY.search(df.where(said)._jdf.queryExecution().analyzed().toString()):
                    raise ValueError("the condition holds a subquery")
                own = own.withColumn(f"{PREFIX}{i}", said)
                good.append((c, F.col(f"{PREFIX}{i}")))
            except (PySparkException, ValueError) as e:
                bad.append({"rule_id": c.rule_id, "error": str(e).strip().split("\n")[0][:300]})
    return own, good, bad
