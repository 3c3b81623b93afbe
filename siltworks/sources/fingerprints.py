"""Fingerprints of files of any size: byte ranges are hashed by tasks, and the ranges' digests combined in order.

A file is split as any scan splits it. A range's digest is a polynomial over its lines' hashes, in two lanes of 64 bits; the digest of
two ranges one after the other follows from theirs and the second one's number of lines. So a file has one digest, whatever ranges it
was cut into. Its length in bytes stands beside it and tells line ends of one kind from those of another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The polynomials' places (odd, so that no power of them is 0), a lane each.
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD = (1 << 64) - 1
RANGE = "file bigint, at bigint, n bigint, a bigint, b bigint"


def signed(x: int) -> int:
    x &= WORD
    return x - (1 << 64) if x >> 63 else x


def joined(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """(lines, digest, digest) of two ranges, one after the other."""
    n, *lanes = right
    return left[0] + n, *((x * pow(p, n, 1 << 64) + y) & WORD for x, y, p in zip(left[1:], lanes, PLACES, strict=True))


def digest(hashes: np.ndarray, place: int) -> int:
    """sum of hashes[i] * place ** (n - 1 - i) in 64 bits."""
    powers = np.full(len(hashes), np.uint64(place), np.uint64)
    powers[-1:] = 1
    powers = np.multiply.accumulate(powers[::-1])[::-1]
    return int((hashes.view(np.uint64) * powers).sum(dtype=np.uint64))


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range that a task reads, from its lines in order."""
    done: dict[tuple[int, int], tuple[int, int, int]] = {}
    for batch in batches:
        file, at, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "at", "a", "b"))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(at) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(file)], strict=True):
            if end > start:
                key = int(file[start]), int(at[start])
                own = int(end - start), digest(a[start:end], PLACES[0]), digest(b[start:end], PLACES[1])
                done[key] = joined(done[key], own) if key in done else own
    rows = [(*k, n, signed(x), signed(y)) for k, (n, x, y) in done.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=["file", "at", "n", "a", "b"])


def whole(group: pa.Table) -> pa.Table:
    """A file's ranges in order: some tens of bytes for each, as many as the file has splits."""
    rows = sorted(zip(*(group.column(c).to_pylist() for c in ("at", "n", "a", "b")), strict=True))
    out = (0, 0, 0)
    for _, n, a, b in rows:
        out = joined(out, (n, a & WORD, b & WORD))
    return pa.table({"file": group.column("file")[:1], "digest": [f"{out[1]:016x}{out[2]:016x}"], "lines": [out[0]]})


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file (xxhash64 of its URI), digest (32 hexadecimal digits) and lines of each file that has any line."""
    hashed = spark.read.text(paths).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.xxhash64("value").alias("a"), F.xxhash64(F.lit(1), "value").alias("b"))
    return hashed.mapInArrow(ranges, RANGE).groupBy("file").applyInArrow(whole, "file bigint, digest string, lines bigint")
