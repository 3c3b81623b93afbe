from pyspark.sql import functions as F

from siltworks.operators.sketches import K, LOG_K, column_sketches, merged, report


def test_halves_merge_to_the_whole(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate", F.when(F.col("l_quantity") > 20, F.col("l_returnflag")).alias("flag"))
    column_sketches(df.where("l_orderkey % 2 = 0"), "r1").write.parquet(str(tmp_path / "p/r1"))
    column_sketches(df.where("l_orderkey % 2 = 1"), "r2").write.parquet(str(tmp_path / "p/r2"))
    stored = spark.read.parquet(str(tmp_path / "p/*"))
    assert stored.count() == 10
    both = {r["column_name"]: r for r in report(merged(stored)).collect()}
    whole = {r["column_name"]: r for r in report(merged(column_sketches(df, "all"))).collect()}
    assert {r["column_name"]: r["runs"] for r in merged(stored).collect()}["flag"] == ["r1", "r2"]
    n = df.count()
    for c in df.columns:
        exact = ("data_types", "rows", "null_rate", "numeric_rate", "date_rate", "min", "max", "max_length")
        assert [both[c][x] for x in exact] == [whole[c][x] for x in exact]
        distinct = df.select(c).distinct().where(F.col(c).isNotNull()).count()
        assert abs(both[c]["distinct"] - distinct) <= max(1, 4 * 1.04 / 2 ** (LOG_K / 2) * distinct)
    values = sorted(r[0] for r in df.select(F.col("l_quantity").cast("double")).collect())
    for q, v in zip((0.25, 0.5, 0.75), both["l_quantity"]["quantiles"], strict=True):
        at_most, below = sum(x <= v for x in values) / n, sum(x < v for x in values) / n
        assert below - 4 * 1.7 / K <= q <= at_most + 4 * 1.7 / K
    truth = df.groupBy("l_returnflag").count().orderBy(F.desc("count"), "l_returnflag").collect()
    assert {(x["item"], x["count"]) for x in both["l_returnflag"]["frequent"]} <= {(r[0], r[1]) for r in truth} and both["l_returnflag"]["quantiles"] is None
    assert abs(both["l_quantity"]["mean"] - sum(values) / n) < 1e-9


def test_empty_columns_and_tables(spark):
    empty = spark.createDataFrame([], "a string, b int")
    got = {r["column_name"]: r for r in report(merged(column_sketches(empty, "r"))).collect()}
    assert got["a"]["rows"] == 0 and got["a"]["null_rate"] == 0 and got["b"]["distinct"] == 0 and got["b"]["frequent"] == []
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "a string, b int")
    got = {r["column_name"]: r for r in report(merged(column_sketches(nulls, "r").unionByName(column_sketches(empty, "s")))).collect()}
    assert got["a"]["null_rate"] == 1 and got["b"]["data_types"] == ["int"] and got["b"]["max"] == 2
