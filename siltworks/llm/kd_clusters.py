"""Clustering of integer vectors around centroids, by kd-tree filtering.

Every partition cuts its vectors into kd-trees of bounded size, whose nodes hold counts, integer sums and boxes. The trees are stored
once. In each round, all trees are walked from their roots with the centroids that may still win: at a node, the
centroid nearest to the box's middle stays, and each centroid that is strictly farther than it from every point of the box goes. A
node with one centroid left is assigned whole, by its count and its sums; a leaf with several is resolved vector by vector.
All arithmetic is on integers, so the results don't depend on how the rows are partitioned. Only k counts and sums of a task reach
the shuffle, and only k centroids the driver.

Defined cases: vectors that are null, have another number of components, or a component that is null or not finite, are left out, and so
are components too large for exact distances in 64 bits (an error is raised for them); equal distances go to the smaller number; rows
with one key are vectors of their own; a null key is never among the first centroids while there are others; with fewer vectors
than centroids there are as many centroids as vectors; an empty cluster keeps its centroid; equal vectors make one leaf,
whatever their number, which is assigned at once; an empty table gives no rows; columns named like an output column are replaced,
others may have any name and value. Texts aren't looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from siltworks.llm.common import quoted, scratch, stored

#: Vectors of a tree, and of a leaf.
TREE, LEAF = 4096, 32


def usable(vector: Column, dims: int | None = None) -> Column:
    """Whether all components are there and finite (and there are so many of them)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & (F.lit(True) if dims is None else F.size(vector) == dims), F.lit(False))


def vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Components as doubles, a row for each vector."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


class Tree:
    """Nodes in the order of creation, parents first: a node's points are points[start:end]; left is the first child (the second follows it), 0 at leaves."""

    FIELDS = (("points", np.int32), ("nodes", np.int32), ("boxes", np.int32), ("sums", np.int64))

    def __init__(self, dims: int, points: np.ndarray, nodes: np.ndarray, boxes: np.ndarray, sums: np.ndarray):
        self.points, self.sums = points.reshape(-1, dims), sums.reshape(-1, dims)
        self.start, self.end, self.left = nodes.reshape(-1, 3).T
        self.low, self.high = boxes.reshape(-1, 2, dims).swapaxes(0, 1)

    @staticmethod
    def grow(points: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The order of the points in the tree, and the fields as bytes."""
        order = np.arange(len(points))
        nodes, boxes, sums, at = [[0, len(points), 0]], [], [], 0
        while at < len(nodes):
            start, end, _ = nodes[at]
            own = points[order[start:end]]
            low, high = own.min(0), own.max(0)
            boxes.append((low, high))
            sums.append(own.sum(0, dtype=np.int64))
            if end - start > LEAF and (low < high).any():
                middle = (end - start) // 2
                halves = np.argpartition(own[:, (high - low).argmax()], middle)
                order[start:end] = order[start:end][halves]
                nodes[at][2] = len(nodes)
                nodes += [[start, start + middle, 0], [start + middle, end, 0]]
            at += 1
        made = {"points": points[order], "nodes": nodes, "boxes": boxes, "sums": sums}
        return order, [np.asarray(made[name], kind).tobytes() for name, kind in Tree.FIELDS]

    def filtered(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes assigned whole, the number of the centroid of each, and rows of leaves that are resolved one by one, with theirs."""
        whole, whole_to, rows, rows_to = [], [], [], []
        nodes, may = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
        while len(nodes):
            low, high = self.low[nodes].astype(np.int64), self.high[nodes].astype(np.int64)
            from_middle = ((low + high)[:, None] - 2 * centroids) ** 2
            best = np.where(may, from_middle.sum(-1), np.iinfo(np.int64).max).argmin(1)
            nearest = centroids[best][:, None]
            # the box's point where the other centroid stands best against the nearest one
            corner = np.where(centroids > nearest, high[:, None], low[:, None])
            may &= ((corner - centroids) ** 2 - (corner - nearest) ** 2).sum(-1) <= 0
            # in a box of one point the nearest centroid is exact, ties included
            done = (may.sum(1) == 1) | (low == high).all(1)
            whole.append(nodes[done])
            whole_to.append(best[done])
            leaves = ~done & (self.left[nodes] == 0)
            if leaves.any():
                sizes = (self.end - self.start)[nodes[leaves]]
                own = np.concatenate([np.arange(self.start[n], self.end[n]) for n in nodes[leaves]])
                rows.append(own)
                rows_to.append(nearest_of(self.points[own], centroids, np.repeat(may[leaves], sizes, 0)))
            inner = ~done & ~leaves
            first = self.left[nodes[inner]].astype(np.int64)
            nodes, may = np.concatenate([first, first + 1]), np.concatenate([may[inner], may[inner]])
        one = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        return one(whole), one(whole_to), one(rows), one(rows_to)


def nearest_of(points: np.ndarray, centroids: np.ndarray, may: np.ndarray) -> np.ndarray:
    """For each point the number of the nearest centroid that may win; the smaller number if two are as near."""
    kind = np.float64 if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < 1 << 20 and points.shape[1] < 1 << 10 else np.int64
    # doubles hold these sums exactly
    p, c = points.astype(kind), centroids.astype(kind)
    return np.where(may, (c * c).sum(1) - 2 * (p @ c.T), np.iinfo(np.int64).max).argmin(1)


def trees_of(batches: Iterator[pa.RecordBatch], dims: int, scale: int, most: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, TREE):
            batch = whole.slice(at, TREE)
            scaled = np.floor(scale * vectors(batch.column("_value"), dims))
            if np.abs(scaled).max() > most:
                raise ValueError(f"a component times {scale} is beyond {most}: distances would not fit into 64 bits")
            order, fields = Tree.grow(scaled.astype(np.int32))
            carried = batch.column("_row").take(pa.array(order))
            columns = [pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), carried), *(pa.array([f], pa.binary()) for f in fields)]
            yield pa.RecordBatch.from_arrays(columns, names=["_rows", *(name for name, _ in Tree.FIELDS)])


def read_trees(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[Tree, pa.RecordBatch]]:
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            yield Tree(dims, *(np.frombuffer(one.column(name)[0].as_buffer(), kind) for name, kind in Tree.FIELDS)), one


def sums_by_cluster(batches: Iterator[pa.RecordBatch], dims: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each cluster of a task: its number of vectors and their sums."""
    n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for tree, _ in read_trees(batches, dims):
        whole, whole_to, rows, rows_to = tree.filtered(centroids)
        np.add.at(n, whole_to, (tree.end - tree.start)[whole])
        np.add.at(n, rows_to, 1)
        np.add.at(sums, whole_to, tree.sums[whole])
        np.add.at(sums, rows_to, tree.points[rows])
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])


def nearest_rows(batches: Iterator[pa.RecordBatch], dims: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Every vector's row with its cluster and squared distance."""
    for tree, one in read_trees(batches, dims):
        whole, whole_to, rows, rows_to = tree.filtered(centroids)
        cluster = np.empty(len(tree.points), np.int64)
        cluster[rows] = rows_to
        for node, to in zip(whole, whole_to, strict=True):
            cluster[tree.start[node] : tree.end[node]] = to
        distance = ((tree.points - centroids[cluster]) ** 2).sum(1)
        yield pa.RecordBatch.from_arrays([one.column("_rows").flatten(), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["_row", "cluster", "distance"])


def kd_clusters(rows: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1, key: str = "vec_id", vector: str = "embedding", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with cluster (int), distance (squared), cluster_inertia, inertia (long) and centroid_sha256.

    Components x become floor(scale * x). The first centroids are the k vectors with the smallest sha256 of ``seed:key``; each
    round assigns all vectors and replaces the centroids by the floors of their vectors' means; then all are assigned once more.
    """
    made = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    carry = [c for c in (rows.columns if carry is None else carry) if c not in made]
    most = math.isqrt((1 << 62) // dims) // 4
    used = rows.where(usable(F.col(f"`{vector}`"), dims)).select(F.struct(*quoted(carry), F.lit(0).alias("_none")).alias("_row"), F.col(f"`{vector}`").alias("_value"), F.col(f"`{key}`").alias("_key"))
    with scratch(rows.sparkSession) as kept:
        binaries = StructType.fromDDL(", ".join(f"{name} binary" for name, _ in Tree.FIELDS))
        schema = StructType([StructField("_rows", ArrayType(used.schema["_row"].dataType)), *binaries])
        trees = stored(used.select("_row", "_value").mapInArrow(lambda b: trees_of(b, dims, scale, most), schema))
        started = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_key").cast("string")), 256)
        first = used.select(started.alias("_hash"), "_value").orderBy(F.col("_hash").asc_nulls_last(), "_value").limit(k).collect()
        centroids = np.array([np.floor(scale * np.array(r["_value"], float)) for r in first], np.int64).reshape(-1, dims)
        for _ in range(rounds if first else 0):
            parts = trees.mapInArrow(lambda b, c=centroids: sums_by_cluster(b, dims, c), "cluster int, n bigint, sums array<bigint>")
            total = lambda c: F.sum(c.cast("decimal(38,0)"))
            for r in parts.groupBy("cluster").agg(total(F.col("n")).alias("n"), F.array(*(total(F.col("sums")[i]) for i in range(dims))).alias("sums")).collect():
                centroids[r["cluster"]] = [int(s) // int(r["n"]) for s in r["sums"]]
        near = stored(trees.mapInArrow(lambda b: nearest_rows(b, dims, centroids), StructType([used.schema["_row"], *StructType.fromDDL("cluster int, distance bigint")])))
        by_cluster = {r["cluster"]: int(r["s"]) for r in near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
        digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
        of_cluster = rows.sparkSession.createDataFrame([(c, s, sum(by_cluster.values()), digest[c]) for c, s in by_cluster.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
        return kept(near.join(F.broadcast(of_cluster), "cluster").select(*(F.col(f"_row.`{c}`") for c in carry), *made))
