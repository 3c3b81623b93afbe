"""CSV files of one table, whose headers, encodings and quoting may differ from file to file."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltworks.operators.schema import union_by_name
from siltworks.sources.heads import heads


def column_names(header: str) -> list[str]:
    """The names of a header line; one without a name, or that comes again in any case, gets its place, so that no column is lost."""
    names = next(csv.reader([header.lstrip("\ufeff")]), [])
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def kinds_of_files(spark: SparkSession, paths: list[str], encoding: str | None = None, multi_line: bool | None = None) -> dict[tuple[tuple[str, ...], str, bool], list[str]]:
    """(column names, encoding, whether values run over lines) of the files that have a header, each with its paths.

    UTF-8 if all lines of a file are, else Latin-1. A file with an odd number of quotes in a line has values over several lines, its header among them.
    """
    kinds: dict[tuple[tuple[str, ...], str, bool], list[str]] = {}
    odd = F.regexp_count("value", F.lit('"')) % 2 == 1
    for f in heads(spark, paths, other=F.count_if(~F.is_valid_utf8("value")), odd=F.count_if(odd)):
        said, whole = encoding or ("ISO-8859-1" if f["other"] else "UTF-8"), bool(f["odd"]) if multi_line is None else multi_line
        head = f["head"].decode(said, "replace")
        if whole and head.count('"') % 2:  # a name runs over lines
            names = [c.lstrip("\ufeff") for c in spark.read.options(header=True, multiLine=True, escape='"', encoding=said).csv(f["path"]).columns]
        else:
            names = column_names(head)
        kinds.setdefault((tuple(names), said, whole), []).append(f["path"])
    return kinds


def read_csv(spark: SparkSession, paths: list[str], encoding: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """Every column as text, so that dirt does not decide types. Each file is read by its own header: files of one header are one scan with an
    explicit schema, and the scans are united by name. A byte order mark is dropped; a file without a line gives no rows.

    encoding, multi_line: of all files; by default each file's own. Only files with values over several lines are read by one task each.
    """
    frames = []
    for (names, said, whole), some in kinds_of_files(spark, paths, encoding, multi_line).items():
        schema = StructType([StructField(n, StringType()) for n in names])
        frames.append(spark.read.schema(schema).options(header=True, enforceSchema=True, multiLine=whole, escape='"', encoding=said).csv(some))
    if not frames:
        raise ValueError(f"no header in {', '.join(paths[:5])}")
    return union_by_name(frames)
