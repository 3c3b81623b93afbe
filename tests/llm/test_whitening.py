from fractions import Fraction

import numpy as np
import pytest

from siltworks.llm.queries import op12_whitening
from siltworks.llm.whitening import squared_deviations, whiten


def expected(vectors, scale=1024, shift=100_000, k=8):
    x = np.array([[int(np.floor(scale * float(c))) + shift for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(0)
    y = n * x - s
    v = np.array([[float(Fraction(int(a), n**3)) for a in row] for row in y.T @ y])
    values, axes = np.linalg.eigh(v)
    return n, (y * y).sum(1), (y / n).astype(float), values[::-1][:k], axes[:, ::-1][:, :k], np.trace(v)


def compare(rows, vectors, keys, k):
    n, deviation, y, values, axes, trace = expected(vectors, k=k)
    place = {key: i for i, key in enumerate(keys)}
    z = np.zeros((len(keys), k))
    for r in rows:
        i, c = place[r["vec_id"]], r["component"] - 1
        assert (r["n"], int(r["deviation"])) == (n, deviation[i])
        assert r["explained"] == pytest.approx(values[c] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-9
        z[i, c] = r["whitened"]
    assert len(rows) == len(keys) * k
    own = y @ axes / np.sqrt(values)
    assert np.abs(np.abs(z) - np.abs(own)).max() < 1e-6
    assert np.abs(z.T @ z / n - np.eye(k)).max() < 1e-9


def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = op12_whitening(spark, sf).collect()
    compare(rows, [r["embedding"] for r in table], [r["vec_id"] for r in table], 8)


def test_tiles_nulls_other_lengths_and_clashes(spark):
    draw = np.random.default_rng(2)
    vectors = [draw.normal(0, [1, 2, 3, 4, 5]).tolist() for _ in range(50)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(90, None), (91, [None] * 5), (92, [1.0, float("nan"), 1.0, 1.0, 1.0]), (93, []), (94, [1.0, 2.0]), (95, [float("-inf")] * 5)]
    frame = spark.createDataFrame([(k, v, "old", {"a": 1}) for k, v in rows], "vec_id long, embedding array<double>, n string, `a.b` map<string,int>").repartition(4)
    for tile in (1, 2, 5, 16):
        done = whiten(frame, components=3, tile=tile)
        assert done.columns == ["vec_id", "embedding", "a.b", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        compare(done.collect(), vectors, range(50), 3)


def test_partitions_do_not_matter(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    one, many = (sorted((r["vec_id"], r["component"], r["whitened"], r["deviation"]) for r in whiten(t).collect()) for t in (table.coalesce(1), table.repartition(7)))
    assert one == many


def test_repeats_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    repeated = spark.createDataFrame([(None, [1.0, 2.0])] * 3 + [(1, [3.0, 5.0])], schema)
    rows = whiten(repeated).collect()
    assert len(rows) == 4 and {r["component"] for r in rows} == {1} and rows[0]["n"] == 4
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).count() == 0
    assert whiten(spark.createDataFrame([], schema)).count() == 0


def test_deviations_beyond_64_bits():
    x = np.array([[100_001, 2, -5], [7, 1 << 50, 0]], np.int64)
    for n in (3, 10**5, 10**9, 10**14):
        s = [n * 100_000, n * 3 + 1, -n]
        assert [int(d) for d in squared_deviations(x, n, s)] == [sum((n * int(a) - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
