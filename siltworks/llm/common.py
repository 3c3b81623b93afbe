"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

INNERMOST: ContextVar[str | None] = ContextVar("INNERMOST", default=None)
#: Keys of so large a share of all rows are heavy: at most so many, and only these are broadcast.
MAX_HEAVY = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it. Only a local master, whose executors are this machine, may name none: then a folder of its own is set."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="siltworks-"))
    return sc._jsc.sc().getCheckpointDir().get()


def folder(spark: SparkSession) -> str:
    """A new name in the folder of the innermost scratch(), else in the shared folder."""
    return f"{INNERMOST.get() or shared_dir(spark)}/siltworks-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What stored() writes inside goes into one folder, which is deleted at the end, also after a failure. Gives a function that stores a result outside."""
    outer, own = folder(spark), folder(spark)
    before = INNERMOST.set(own)
    try:
        yield lambda df: stored(df, outer)
    finally:
        INNERMOST.reset(before)
        delete(spark, own)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cuts the lineage: writes the frame as a table in the shared folder and reads it back, so that lost executors cost nothing that is done."""
    spark = df.sparkSession
    path = path or folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a stored() frame that nothing reads any more."""
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, f)


def collect_garbage(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now; else they stay until the driver happens to need memory."""
    gc.collect()
    spark._jvm.System.gc()


def heavy_join(rows: DataFrame, small: DataFrame, on: list[str], n: str, total: int | None = None, most: int = MAX_HEAVY) -> DataFrame:
    """Inner join of rows with a frame of one row for each key, whose column ``n`` is the number of rows of the key.

    Keys of at least 1 / most of all rows, so many of them at most, are broadcast, so their rows stay where they are; the
    rest is shuffled, and no key of it is larger than that. small is computed more than once, so it should be stored. total: the sum of n.
    """
    if total is None:
        total = small.agg(F.sum(n)).first()[0] or 0
    least = math.ceil(total / most)
    heavy, light = F.broadcast(small.where(F.col(n) >= least)), small.where(F.col(n) < least)
    found = rows.join(heavy, on)
    if least <= 1:
        return found
    return found.unionByName(rows.join(heavy.select(*on), on, "left_anti").join(light, on))


_MADE: dict = {}


def once_per_worker(key, make: Callable):
    """What ``make`` gives, made once in each Python worker for a key (of content, not of identity). The last few are remembered."""
    if key not in _MADE:
        while len(_MADE) >= 4:
            _MADE.pop(next(iter(_MADE)))
        _MADE[key] = make()
    return _MADE[key]


def quoted(names: list[str]) -> list[Column]:
    """Columns by their names, whatever these hold."""
    return [F.col(f"`{n}`") for n in names]


def as_json(columns: list[Column]) -> Column:
    """These columns as one text that tells different rows apart, whatever their types and names."""
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(columns)), F.lit(0).alias("none")), exact)


def map_rows(docs: DataFrame, carry: list[str], column: str, make: Callable[[], Callable], outputs: pa.Schema, ddl: str) -> DataFrame:
    """The carried columns as they are, and for each row what make()'s function gives for a column. outputs and ddl: the new columns, for Arrow and for Spark."""
    # a carried column is sent once, and taken from the row
    at = carry.index(column) if column in carry else None
    rows = docs.select(F.struct(*quoted(carry), F.lit(0).alias("_none")).alias("_row"), *(F.col(f"`{c}`").alias("_value") for c in [column] if at is None))

    def run(batches):
        if at is not None:
            batches = (pa.RecordBatch.from_arrays([b.column("_row"), b.column("_row").field(at)], names=["_row", "_value"]) for b in batches)
        return per_row(make(), ["_value"], outputs, ["_row"])(batches)

    found = rows.mapInArrow(run, StructType([rows.schema["_row"], *StructType.fromDDL(ddl).fields]))
    return found.select(*(F.col(f"_row.`{c}`") for c in carry), *quoted(outputs.names))


def packed(df: DataFrame, but: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """The rows in one column ``_row``, so that names of other columns can't clash with an operator's own; and the columns that are not replaced (``but``)."""
    stay = [c for c in df.columns if c not in but]
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")), stay


def per_row(fn: Callable[[dict], dict], inputs: list[str], outputs: pa.Schema, carry: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function: the carried columns as they are, then fn's outputs for each row, in small batches so that memory stays bounded however long the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = [fn(*args) for args in zip(*(batch.column(c).to_pylist() for c in inputs), strict=True)]
                columns = [batch.column(c) for c in carry] + [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(outputs)]
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, *outputs.names])

    return run
