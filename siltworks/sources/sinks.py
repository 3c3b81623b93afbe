"""Where results go: Parquet tables, quarantine and reports as JSON, metrics as text, state."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.sources.state import StateFile


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_quarantine(df: DataFrame, path: str, reason: str = "_reason") -> str:
    df.write.mode("overwrite").partitionBy(reason).json(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """A report of a bounded number of rows, as one file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_lines(df: DataFrame, path: str, column: str = "line") -> str:
    df.select(column).coalesce(1).write.mode("overwrite").text(path)
    return path


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def load_state(spark: SparkSession, path: str) -> dict:
    """The last whole version of a state; an empty one if there is none or it is broken. The older key ``file_hashes`` is taken over."""
    state = StateFile(spark, path).read()
    if "file_hashes" in state:
        state.setdefault("hashes", state.pop("file_hashes"))
    return state


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    """The state as the version after the latest."""
    StateFile(spark, path).update(lambda _: state)


def append_line(spark: SparkSession, folder: str, name: str, line: str) -> None:
    """One line of a log as a file of its own in a folder, which Spark reads as one table of lines."""
    target, fs = _path(spark, f"{folder}/{name}.log")
    out = fs.create(target, True)
    out.write(bytearray((line + "\n").encode()))
    out.close()


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    """A report as one file of one line of JSON, which is not there before it is whole."""
    target, fs = _path(spark, path)
    beside, _ = _path(spark, path + ".new")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(document, sort_keys=True, ensure_ascii=False, default=str).encode()))
    out.close()
    fs.delete(target, True)
    fs.rename(beside, target)


def sample_rows(df: DataFrame, n: int, *order: str) -> list[dict]:
    """The first n rows in an order, or any n."""
    return [json.loads(r[0]) for r in (df.orderBy(*order) if order else df).limit(n).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
