"""Raw files: which groups there are, and how each kind is read. Reading is Spark's; the driver only handles paths."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.changes import hashes_of_digests
from siltworks.sources.csv_files import read_csv
from siltworks.sources.fingerprints import fingerprints
from siltworks.sources.json_files import read_json, read_rows, read_wrapped
from siltworks.sources.xml_files import read_xml

#: Names that stand in a URI as they are, and the digest of a file without lines.
PLAIN, NO_LINES = re.compile(r"[A-Za-z0-9._/=-]+"), "0" * 32


@dataclass(frozen=True)
class Source:
    """A group of files that make one table."""

    type: str
    name: str
    table: str
    format: str
    db: str | None = None

    @property
    def key(self) -> str:
        return "/".join(x for x in (self.type, self.db, self.table) if x)


def classify(path: str) -> Source | None:
    """What a path below the root is: CSV tables, other files, JSON dumps of databases or API answers."""
    parts = path.split("/")
    if len(parts) < 2 or "." not in parts[-1]:
        return None
    stem, _, ext = parts[-1].rpartition(".")
    ext = ext.lower()
    top = parts[0]
    if top == "source_file" and len(parts) > 2 and parts[1] == "other" and ext in ("json", "csv", "xml"):
        return Source("source_file", "other", stem, ext)
    if top == "source_file":
        return Source("source_file", "source_file", stem, ext) if ext == "csv" else None
    if ext != "json":
        return None
    if top == "transactions-bancaires" and len(parts) > 2:
        return Source("db_rows", top, parts[1], ext, top)
    if len(parts) > 3 and parts[1] == "public":
        return Source("db_wrapped", top, parts[2], ext, top)
    return Source("api", top, top, ext)


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Paths below root, relative to it, by Hadoop's file system, so that any store will do."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    top = qualified(spark, root)
    found, files = [], fs.listFiles(base, True)
    while files.hasNext():
        found.append(files.next().getPath().toString()[len(top) :])
    return sorted(found)


def discover(paths: list[str]) -> dict[Source, list[str]]:
    groups: dict[Source, list[str]] = {}
    for p in sorted(paths):
        if source := classify(p):
            groups.setdefault(source, []).append(p)
    return groups


def qualified(spark: SparkSession, root: str) -> str:
    """The root as the file system names it, with a slash at the end."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    return base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/") + "/"


def uri(spark: SparkSession, top: str, path: str) -> str:
    """A file below the qualified root as Spark's metadata name it."""
    return top + path if PLAIN.fullmatch(path) else spark._jvm.org.apache.hadoop.fs.Path(top + path).toUri().toString()


def manifest(spark: SparkSession, root: str, groups: dict[Source, list[str]]) -> DataFrame:
    """group_key, hash of each group's content. Executors hash ranges of files of any size; an empty file counts as empty content."""
    top = qualified(spark, root)
    rows = [(s.key, p, uri(spark, top, p), size) for s, ps in groups.items() for p, size in zip(ps, sizes(spark, root, ps), strict=True)]
    if not rows:
        return spark.createDataFrame([], "group_key string, hash string")
    names = spark.createDataFrame(rows, "group_key string, path string, uri string, bytes bigint").withColumn("file", F.xxhash64("uri"))
    found = names.join(fingerprints(spark, [top + p for _, p, _, _ in rows]), "file", "left")
    return hashes_of_digests(found.select("group_key", "path", F.coalesce("digest", F.lit(NO_LINES)).alias("digest"), F.col("bytes").cast("string").alias("bytes")))


def sizes(spark: SparkSession, root: str, paths: list[str]) -> list[int]:
    """Lengths in bytes, from the file system's listing."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return [fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{p}")).getLen() for p in paths]


def read(spark: SparkSession, source: Source, paths: list[str]) -> DataFrame:
    if source.type == "db_rows":
        return read_rows(spark, paths)
    if source.type == "db_wrapped":
        return read_wrapped(spark, paths)
    return {"csv": read_csv, "xml": read_xml}.get(source.format, read_json)(spark, paths)


def with_row_id(df: DataFrame) -> DataFrame:
    """_row_id: the order of rows in the files, as far as their split is the same."""
    return df.withColumn("_row_id", F.monotonically_increasing_id())
