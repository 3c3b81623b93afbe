"""Operators on names and shapes of columns; each is one projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from siltworks.functions import fixed, names


def quoted(c: str):
    return F.col("`" + c.replace("`", "``") + "`")


def snake_names(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Snake case, but for the names to keep; a name that would come twice gets a number."""
    seen: dict[str, int] = {}
    new = []
    for n in (c if c in keep else names.snake(c) for c in df.columns):
        seen[n] = seen.get(n, 0) + 1
        new.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*new)


def renamed(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Renames what exists, unless the target does."""
    have = {*df.columns}
    out = {}
    for old, new in renames.items():
        if old in have and new not in have:
            out[old] = new
            have.add(new)
    return df.withColumnsRenamed(out)


def canonical_names(df: DataFrame) -> DataFrame:
    return renamed(df, {c: fixed.CANONICAL_NAMES[c.lower()] for c in df.columns if c.lower() in fixed.CANONICAL_NAMES})


def flattened(df: DataFrame, depth: int = 3, keep_empty: bool = True) -> DataFrame:
    """Structs to columns ``parent_child``, arrays to rows, maps to JSON text; ``depth`` passes. keep_empty: a row with an empty array stays."""
    for _ in range(depth):
        if not any(isinstance(f.dataType, StructType | ArrayType) for f in df.schema):
            break
        columns, arrays = [], []
        for f in df.schema:
            if isinstance(f.dataType, StructType):
                columns += [quoted(f.name).getField(x.name).alias(f"{f.name}_{x.name}") for x in f.dataType]
            elif isinstance(f.dataType, MapType):
                columns.append(F.to_json(quoted(f.name)).alias(f.name))
            else:
                columns.append(quoted(f.name))
                arrays += [f.name] * isinstance(f.dataType, ArrayType)
        df = df.select(*columns)
        for a in arrays:
            df = df.withColumn(a, (F.explode_outer if keep_empty else F.explode)(quoted(a)))
    maps = {f.name: F.to_json(quoted(f.name)) for f in df.schema if isinstance(f.dataType, MapType)}
    return df.withColumns(maps) if maps else df


def with_source(df: DataFrame, source_type: str, source_name: str, table: str, db: str | None = None, at=None) -> DataFrame:
    """The metadata columns."""
    new = {"_source_type": F.lit(source_type), "_source_name": F.lit(source_name), "_table_name": F.lit(table), "_processed_at": F.lit(at) if at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")}
    return df.withColumns(new | ({"_db_name": F.lit(db)} if db else {}))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in fixed.META_COLUMNS and not c.startswith("_")]
