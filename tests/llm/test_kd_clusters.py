import hashlib
import random

import duckdb
import numpy as np
import pytest

from siltworks.llm.kd_clusters import LEAF, Tree, kd_clusters
from siltworks.llm.queries import ORACLE_SQL, op11_kd_clusters

NAMES = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k=16, rounds=3, scale=64, dims=64):
    """rows: (key, vector); a dict of results by row number of what is kept."""
    kept = [(key, [int(np.floor(scale * float(c))) for c in v]) for key, v in rows if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(x) for _, x in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for c in range(len(centroids)):
            if members := [x for (_, x), o in zip(kept, own, strict=True) if o == c]:
                centroids[c] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    out = [(key, *reversed(nearest(x))) for key, x in kept]
    by = {c: sum(d for _, o, d in out if o == c) for c in {o for _, o, _ in out}}
    return sorted(((key, c, d, by[c], sum(by.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for key, c, d in out), key=str)


def got(df, key="vec_id"):
    return sorted(((r[key], *(r[n] for n in NAMES)) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(op11_kd_clusters(spark, sf)) == brute(rows)


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    found = con.execute(f"SELECT vec_id, {', '.join(NAMES)} FROM ({ORACLE_SQL['op11_kd_clusters']})").fetchall()
    assert got(op11_kd_clusters(spark, sf)) == sorted(found, key=str)


def test_ties_nulls_repeats_and_clashes(spark):
    draw = random.Random(3)
    rows = [(i % 300 if i % 7 else None, [draw.choice([-1.5, -0.5, 0.0, 0.25, 2.0]) for _ in range(3)]) for i in range(600)]
    rows += [(7, [1.0, 1.0, 1.0])] * 400 + [(1, None), (2, [1.0, None, 2.0]), (3, [float("nan"), 1.0, 1.0]), (4, [1.0, float("inf"), 0.0]), (5, []), (6, [1.0, 2.0]), (8, [1.0] * 4)]
    frame = spark.createDataFrame([(k, v, "old", {"a": 1}) for k, v in rows], "vec_id long, embedding array<float>, cluster string, `a.b` map<string,int>").repartition(3)
    done = kd_clusters(frame, k=5, scale=2, dims=3)
    assert done.columns == ["vec_id", "embedding", "a.b", *NAMES]
    assert got(done) == brute(rows, k=5, scale=2, dims=3)
    assert {(r["vec_id"], tuple(r["embedding"])) for r in done.collect()} <= {(k, tuple(v)) for k, v in rows if v and None not in v}


def test_few_and_none(spark):
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    schema = "vec_id long, embedding array<double>"
    assert got(kd_clusters(spark.createDataFrame(few, schema), dims=2)) == brute(few, dims=2)
    assert kd_clusters(spark.createDataFrame([], schema), dims=2).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        kd_clusters(spark.createDataFrame([(1, [1e30, 0.0])], schema), dims=2).count()


def test_filtering_prunes_and_assigns_whole_nodes():
    draw = np.random.default_rng(1)
    places = np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]])
    points = (places[draw.integers(0, 4, 4000)] + draw.integers(-20, 20, (4000, 2))).astype(np.int32)
    order, fields = Tree.grow(points)
    tree = Tree(2, *(np.frombuffer(f, kind) for f, (_, kind) in zip(fields, Tree.FIELDS, strict=True)))
    whole, to, rows, rows_to = tree.filtered(places)
    assert sorted(order) == list(range(4000)) and (points[order] == tree.points).all()
    # far clusters: hardly a vector is looked at by itself
    assert len(rows) <= 8 * LEAF and (tree.end - tree.start)[whole].sum() + len(rows) == 4000
    for node, c in zip(whole, to, strict=True):
        own = tree.points[tree.start[node] : tree.end[node]]
        assert (((own[:, None] - places) ** 2).sum(-1).argmin(1) == c).all()
        assert (own.sum(0) == tree.sums[node]).all()
    same = Tree(2, *(np.frombuffer(f, kind) for f, (_, kind) in zip(Tree.grow(np.full((5000, 2), 7, np.int32))[1], Tree.FIELDS, strict=True)))
    assert len(same.start) == 1 and same.filtered(places)[0].tolist() == [0]
