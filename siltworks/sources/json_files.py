"""JSON files by VARIANT: lines, arrays, objects, rows under a key, objects of rows. Their columns are known from one aggregation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.operators.schema import union_by_name
from siltworks.sources.heads import heads

BROKEN = "_corrupt_record"
#: Parts of a VARIANT's schema that become other types, outside quoted names and names.
TYPES = re.compile(r"`(?:[^`]|``)*`|(?<=[ <])(?:OBJECT(?=<)|(?:VARIANT|VOID|DECIMAL\(\d+, ?\d+\))(?![\w:]))|^OBJECT(?=<)")


def forms(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Paths by form, which the first line tells: ``lines`` if it is a whole value, else ``array`` or ``object`` that runs over lines."""
    found: dict[str, list[str]] = {}
    files = heads(spark, paths)
    whole = F.try_parse_json(F.regexp_replace("head", "^\ufeff", "")).isNotNull()
    rows = spark.createDataFrame([(f["path"], f["head"].decode("utf-8", "replace")) for f in files], "path string, head string")
    for r in rows.select("path", F.when(whole, "lines").when(F.col("head").rlike("^[\\s\ufeff]*\\["), "array").otherwise("object").alias("form")).collect():
        found.setdefault(r["form"], []).append(r["path"])
    return found


def as_array(v: Column) -> Column:
    """The elements of an array, or the value alone."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def values(spark: SparkSession, paths: list[str]) -> DataFrame:
    """v and _corrupt_record: every element of a file's array, or its value or values; a line that is no JSON has its text beside.

    Lines are split among tasks. An array over lines is streamed by one task for each file, and so is an object, which VARIANT bounds to 128 MB.
    """
    frames = []
    for form, some in sorted(forms(spark, paths).items()):
        if form == "lines":
            text = spark.read.text(some).select(F.regexp_replace("value", "^\ufeff", "").alias("text")).where(F.col("text").rlike(r"\S"))
            v = F.try_parse_json("text")
            frames.append(text.select(v.alias("v"), F.when(v.isNull(), F.col("text")).alias(BROKEN)))
        elif form == "array":
            rows = spark.read.option("multiLine", True).json(some)
            broken = F.col(BROKEN) if BROKEN in rows.columns else F.lit(None).cast("string")
            held = [F.col(f"`{c.replace('`', '``')}`") for c in rows.columns if c != BROKEN]
            frames.append(rows.select(F.to_variant_object(F.struct(*held)).alias("v") if held else F.parse_json(F.lit("null")).alias("v"), broken.alias(BROKEN)))
        else:
            rows = spark.read.options(multiLine=True, singleVariantColumn="v").json(some)
            frames.append(rows.select("v", F.when(F.col("v").isNull(), F.lit("a document that is no JSON, or too large")).alias(BROKEN)))
    if not frames:
        return spark.createDataFrame([], f"v variant, {BROKEN} string")
    return union_by_name(frames).select(F.explode(F.coalesce(as_array(F.col("v")), F.array("v"))).alias("v"), BROKEN)


def spark_types(schema: str) -> str:
    """A VARIANT's schema as types of columns: values of several kinds, or none, become text, exact fractions doubles."""
    kinds = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
    return TYPES.sub(lambda m: m[0] if m[0][0] == "`" else kinds.get(m[0], "DOUBLE"), schema)


def typed(rows: DataFrame) -> DataFrame:
    """The objects among the values as columns; what was broken stays as text in _corrupt_record, a column only if there is any. Other values are no rows."""
    facts = rows.agg(F.schema_of_variant_agg(F.when(is_object(F.col("v")), F.col("v"))).alias("schema"), F.count(BROKEN).alias("broken")).first()
    frames = []
    if (facts["schema"] or "").startswith("OBJECT<") and facts["schema"] != "OBJECT<>":
        frames.append(rows.where(is_object(F.col("v"))).select(F.try_variant_get("v", "$", spark_types(facts["schema"])).alias("r")).select("r.*"))
    if facts["broken"]:
        frames.append(rows.where(F.col(BROKEN).isNotNull()).select(BROKEN))
    return union_by_name(frames) if frames else rows.sparkSession.createDataFrame([], StructType([]))


def read_json(spark: SparkSession, paths: list[str]) -> DataFrame:
    """An object, an array of objects, or a line for each object, in each file."""
    return typed(values(spark, paths))


def read_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As read_json, or objects that hold their rows under ``rows``."""
    inside = F.coalesce(F.try_variant_get("v", "$.rows", "array<variant>"), F.array("v"))
    return typed(values(spark, paths).select(F.explode(inside).alias("v"), BROKEN))


def read_wrapped(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Objects whose values are rows or arrays of rows; other values are left out. A list is its own rows."""
    whole = spark.createDataFrame([], f"v variant, {BROKEN} string")
    for form, some in forms(spark, paths).items():
        if form == "array":
            whole = whole.unionByName(values(spark, some))
        else:
            flat = F.flatten(F.transform(F.map_values(F.try_variant_get("v", "$", "map<string,variant>")), as_array))
            whole = whole.unionByName(values(spark, some).select(F.explode(F.coalesce(flat, F.array("v"))).alias("v"), BROKEN))
    return typed(whole)
