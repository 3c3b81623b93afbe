"""Whitening of embeddings by a tiled covariance.

The integer vectors, centred, are cut into blocks of rows, and these into blocks of columns, which are stored. Each unordered pair of column
blocks is a tile key. The column blocks of a block of rows meet by a join on the number of that block; every task multiplies the pairs it
gets and adds the products up by tile before they are shuffled, summed per tile and entry, and assembled to the covariance
(one number for each pair of dimensions, however many rows there are), whose eigenvectors the driver takes.

Sums and products are exact integers (of vectors centred at the rounded mean; what rounding left is taken off exactly), so
neither the partitions nor the order of tasks change a result. The covariance of the whitened rows is measured on these rows.

Defined cases: vectors that are null, empty, or hold a component that is null or not finite, are left out; the dimension is that of most
vectors left (the larger one if two are as frequent), and vectors of another one are left out as well; rows with one key are rows
of their own and all count; a null key is carried; components without variance beyond rounding (as with few rows) get no rows; equal
eigenvalues keep the order of the decomposition; the entry of largest size of an eigenvector is positive; an empty table gives no rows;
columns named like an output column are replaced, others may have any name and value. Texts aren't looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.llm.common import quoted, scratch, stored
from siltworks.llm.kd_clusters import usable, vectors

#: Rows of a block, and tiles whose sums a task holds.
BLOCK, HELD = 1024, 1024
#: Up to this size products of a block are exact in doubles.
EXACT = 1 << 21
EXACT_38 = "decimal(38,0)"


def integers(column: pa.Array, dims: int, scale: int, shift: int) -> np.ndarray:
    scaled = np.floor(scale * vectors(column, dims))
    if len(scaled) and np.abs(scaled).max() >= 1 << 52:
        raise ValueError(f"a component times {scale} is beyond 2^52: its integer is not known exactly")
    return scaled.astype(np.int64) + shift


def column_sums(batches: Iterator[pa.RecordBatch], dims: int, scale: int, shift: int) -> Iterator[pa.RecordBatch]:
    """A task's number of rows and sums; sums of halves of the numbers, which can't overflow."""
    n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for batch in batches:
        x = integers(batch.column("_value"), dims, scale, shift)
        n += len(x)
        high += (x >> 26).sum(0)
        low += (x & (1 << 26) - 1).sum(0)
    exact = [Decimal((int(a) << 26) + int(b)) for a, b in zip(high, low, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([exact], pa.list_(pa.decimal128(38, 0)))], names=["n", "sums"])


def column_blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: int, shift: int, centre: list[int], tile: int) -> Iterator[pa.RecordBatch]:
    """For each block of rows its column blocks: centred integers, column after column."""
    from pyspark import TaskContext

    middle, n_blocks = np.array(centre, np.int64), -(-dims // tile)
    place = TaskContext.get().partitionId() << 33
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            u = integers(whole.column("_value").slice(at, BLOCK), dims, scale, shift) - middle
            parts = [np.ascontiguousarray(u[:, i * tile : (i + 1) * tile].T).tobytes() for i in range(n_blocks)]
            yield pa.RecordBatch.from_arrays([pa.array([place] * n_blocks, pa.int64()), pa.array(range(n_blocks), pa.int32()), pa.array([len(u)] * n_blocks, pa.int32()), pa.array(parts, pa.binary())], names=["block", "i", "rows", "data"])
            place += 1


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer product, as Python's numbers only where 64 bits could fail."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= EXACT:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64).astype(object)
    return a.astype(object) @ b.T.astype(object)


def tile_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the pairs of column blocks, added up by tile over what a task reads."""
    sums: dict[tuple[int, int], np.ndarray] = {}

    def out():
        values = [[Decimal(v) for v in m.ravel().tolist()] for m in sums.values()]
        keys = list(sums)
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array(values, pa.list_(pa.decimal128(38, 0)))], names=["i", "j", "entries"])

    for batch in batches:
        for r in range(batch.num_rows):
            i, j, rows = (batch.column(c)[r].as_py() for c in ("i", "j", "rows"))
            a, b = (np.frombuffer(batch.column(c)[r].as_buffer(), np.int64).reshape(-1, rows) for c in ("a", "b"))
            sums[i, j] = sums[i, j] + product(a, b) if (i, j) in sums else product(a, b)
            if len(sums) >= HELD:
                yield out()
    if sums:
        yield out()


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """For each row the exact sum of (n * x - S) ** 2, by three limbs of 20 bits where 64 bits could fail."""
    if max(n * (int(np.abs(x).max(initial=0)) + 1), *map(abs, sums)) >= 1 << 60:
        return [Decimal(sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True))) for row in x.tolist()]
    y = np.abs(n * x - np.array(sums, np.int64))
    a, b, c = y >> 40, y >> 20 & (1 << 20) - 1, y & (1 << 20) - 1
    parts = [(p * q).sum(1).tolist() for p, q in ((a, a), (a, b), (a, c), (b, b), (b, c), (c, c))]
    return [Decimal((aa << 80) + (ab << 61) + (ac << 41) + (bb << 40) + (bc << 21) + cc) for aa, ab, ac, bb, bc, cc in zip(*parts, strict=True)]


def projected(batches: Iterator[pa.RecordBatch], dims: int, scale: int, shift: int, n: int, sums: list[int], axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Every row with its squared deviation and its whitened components."""
    centre = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            x = integers(batch.column("_value"), dims, scale, shift)
            y, z = (x - centre) - rest, np.zeros((len(x), axes.shape[1]))
            for column, weights in zip(y.T, axes, strict=True):  # one order of additions, whatever rows a block has
                z += column[:, None] * weights
            columns = [batch.column("_row"), pa.array(squared_deviations(x, n, sums), pa.decimal128(38, 0)), pa.array(list(z), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "deviation", "z"])


def covariance(blocks: DataFrame, dims: int, tile: int, n: int, left: list[int]) -> np.ndarray:
    """The covariance (divisor n) of stored column blocks. left: sums of the centred columns, which are taken off exactly."""
    a = blocks.select("block", "i", "rows", F.col("data").alias("a"))
    b = blocks.select("block", F.col("i").alias("j"), F.col("data").alias("b"))
    pairs = a.join(b, "block").where("i <= j").select("i", "j", "rows", "a", "b")
    entries = pairs.mapInArrow(tile_sums, f"i int, j int, entries array<{EXACT_38}>").select("i", "j", F.posexplode("entries").alias("at", "entry"))
    v = np.zeros((dims, dims))
    for r in entries.groupBy("i", "j", "at").agg(F.sum("entry").alias("entry")).collect():
        width = min(tile, dims - r["j"] * tile)
        p, q = r["i"] * tile + r["at"] // width, r["j"] * tile + r["at"] % width
        v[p, q] = v[q, p] = float(Fraction(n * int(r["entry"]) - left[p] * left[q], n * n))
    return v


def whiten(rows: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, tile: int = 16, vector: str = "embedding", carry: list[str] | None = None) -> DataFrame:
    """For each row and component (1 is the one of largest variance) the carried columns (all by default) with component (int), n (long), deviation
    (exact, decimal), whitened, explained and identity_error (double). Entries c of a vector become floor(scale * c) + shift.
    """
    made = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    carry = [c for c in (rows.columns if carry is None else carry) if c not in made]
    value = F.col(f"`{vector}`")
    used = rows.where(usable(value) & (F.size(value) > 0)).select(F.struct(*quoted(carry), F.lit(0).alias("_none")).alias("_row"), value.alias("_value"))
    most = used.groupBy(F.size("_value").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = most["dims"] if most else 1
    used = used.where(F.size("_value") == dims)
    with scratch(rows.sparkSession) as kept:
        sums_of = used.select("_value").mapInArrow(lambda b: column_sums(b, dims, scale, shift), f"n bigint, sums array<{EXACT_38}>")
        total = sums_of.agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(dims))).alias("sums")).first()
        n, sums = total["n"] or 0, [int(s or 0) for s in total["sums"]]
        if n:
            centre = [(2 * s + n) // (2 * n) for s in sums]
            blocks = stored(used.select("_value").mapInArrow(lambda b: column_blocks(b, dims, scale, shift, centre, tile), "block bigint, i int, rows int, data binary"))
            v = covariance(blocks, dims, tile, n, [s - n * c for s, c in zip(sums, centre, strict=True)])
            values, axes = np.linalg.eigh(v)
            values, axes = values[::-1], axes[:, ::-1]
            found = [k for k in range(min(components, dims)) if values[k] > max(values[0], 0) * dims * 2.0**-52]
        else:
            v, found, values, axes = np.zeros((1, 1)), [], np.zeros(1), np.eye(dims)
        axes = axes[:, found] * np.sign(np.take_along_axis(axes[:, found], np.abs(axes[:, found]).argmax(0)[None], 0)) / np.sqrt(values[found])
        schema = StructType([used.schema["_row"], *StructType.fromDDL(f"deviation {EXACT_38}, z array<double>")])
        if not found:
            done = used.where(F.lit(False)).select("_row", F.lit(None).cast(EXACT_38).alias("deviation"), F.lit(None).cast("array<double>").alias("z"))
        else:
            done = stored(used.mapInArrow(lambda b: projected(b, dims, scale, shift, n, sums, axes), schema))
        pairs = [(i, j) for i in range(len(found)) for j in range(i, len(found))]
        of_whitened = done.agg(*(F.covar_pop(F.col("z")[i], F.col("z")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first() if pairs else {}
        error = max((abs(of_whitened[f"c{i}_{j}"] - (i == j)) for i, j in pairs), default=math.nan)
        shares = F.array(*(F.lit(float(values[k] / np.trace(v))) for k in found)) if found else F.lit(None).cast("array<double>")
        long = done.select("*", F.posexplode("z").alias("_k", "whitened"))
        return kept(
            long.select(*(F.col(f"_row.`{c}`") for c in carry), (F.col("_k") + F.lit(1)).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", shares[F.col("_k")].alias("explained"), F.lit(float(error)).alias("identity_error"))
        )
