"""XML files: every child of the root is a row, whatever its tag."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from siltworks.operators.schema import quoted, union_by_name

#: The root's name, behind what may stand before it.
ROOT = r"(?s)^(?:[\s\uFEFF]|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^\[>]*(?:\[.*?\])?\s*>)*+<([A-Za-z_][^\s/>]*)"


def rows_of(kind: DataType) -> StructType | None:
    """The columns of a child that has columns."""
    kind = kind.elementType if isinstance(kind, ArrayType) else kind
    return kind if isinstance(kind, StructType) else None


def inner_names(kind: DataType) -> set[str]:
    """All names of elements below."""
    own = rows_of(kind)
    return {f.name for f in own} | set().union(*(inner_names(f.dataType) for f in own)) if own else set()


def read_xml(spark: SparkSession, paths: list[str], row_tag: str | None = None) -> DataFrame:
    """The root's children as rows of text. Roots and then their children's tags are found in one pass each over all files; every tag is read as
    its own scan and the scans are united by name. A tag that also stands deeper is taken from the root's element instead, so that only
    children of the root are rows. Children without elements of their own have no columns and give no rows; attributes are left out.
    """
    if row_tag is not None:
        df = spark.read.options(rowTag=row_tag, inferSchema=False).xml(paths)
        return df.select(*(quoted(c) for c in df.columns if not c.startswith("_")))
    root = F.regexp_extract("value", ROOT, 1)
    files = spark.read.text(paths, wholetext=True).select(root.alias("root"), F.col("_metadata.file_path").alias("file"))
    roots = {r["root"]: r["files"] for r in files.groupBy("root").agg(F.collect_set("file").alias("files")).collect()}
    if not roots or "" in roots:
        raise ValueError(f"no root element in {', '.join((roots.get('') or paths)[:5])}")
    frames = []
    for name, some in sorted(roots.items()):
        own = [unquote(f) for f in sorted(some)]
        whole = spark.read.options(rowTag=name, inferSchema=False).xml(own)
        deeper = {name} | set().union(*(inner_names(f.dataType) for f in whole.schema))
        for field in whole.schema:
            if field.name.startswith("_") or (columns := rows_of(field.dataType)) is None:
                continue
            kept = [c.name for c in columns if not c.name.startswith("_")]
            if field.name in deeper:
                inside = whole.where(quoted(field.name).isNotNull())
                rows = inside.select((F.explode(quoted(field.name)) if isinstance(field.dataType, ArrayType) else quoted(field.name)).alias("r"))
                frames.append(rows.select(*(F.col("r").getField(c).alias(c) for c in kept)))
            else:
                frames.append(spark.read.schema(columns).options(rowTag=field.name, inferSchema=False).xml(own).select(*map(quoted, kept)))
    return union_by_name(frames) if frames else spark.createDataFrame([], StructType([]))
