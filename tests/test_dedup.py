import random
import time

from pyspark.sql import functions as F

from siltworks.operators import dedup, rules


def expected(rows, key, order):
    """Places of the rows that have an earlier one with the same key."""
    seen, later = set(), set()
    for i in sorted(range(len(rows)), key=lambda i: order(rows[i])):
        if key(rows[i]) in seen:
            later.add(i)
        seen.add(key(rows[i]))
    return later


def test_marks_are_those_of_a_window_without_one(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(i, draw.choice(["hot"] * 5 + [None, "", "a", "b", *map(str, range(40))]), draw.choice([None, 1, 2])) for i in range(1500)]
    later = expected(rows, lambda r: (r[1], r[2]), lambda r: -r[0])
    df = spark.createDataFrame(rows, "n long, k string, v int").repartition(5)
    for heavy, most in ((10_000, 1 << 14), (20, 1 << 14), (20, 1), (1, 3)):
        monkeypatch.setattr(dedup, "HEAVY", heavy)
        monkeypatch.setattr(dedup, "MAX_HEAVY", most)
        told = dedup.with_copies(df, ["k", "v"], [-F.col("n")])
        assert {r["n"] for r in told.where("_is_copy").collect()} == later and told.count() == 1500
        plan = told._jdf.queryExecution().toString()
        assert "Window" not in plan and "CartesianProduct" not in plan


def test_equal_rows_keep_exactly_one(spark, tmp_path):
    spark.createDataFrame([("x", 1)] * 700 + [("y", None)] * 3 + [(None, None)] * 2, "k string, v int").repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    told = dedup.with_copies(df)
    assert sorted(told.where("not _is_copy").groupBy("k").count().collect(), key=str) == sorted([("x", 1), ("y", 1), (None, 1)], key=str)
    assert dedup.copies(df).count() == 702 and dedup.without_copies(df).count() == 3


def test_repeated_references(spark):
    rows = [(1, "R1"), (2, " R1 "), (3, None), (4, None), (5, "R2"), (6, "R1"), (7, "")]
    df = spark.createDataFrame(rows, "id long, reference string")
    checked = rules.validated(df, "t", {"BNK-012"}, order=["id"])
    assert [r["id"] for r in checked.where("_is_quarantined").orderBy("id").collect()] == [2, 6]
    assert checked.columns[:2] == ["id", "reference"] and rules.REPEATED not in checked.columns
    # a row that stands twice is a repeat of itself
    assert rules.validated(spark.createDataFrame([(1, "R")] * 4, "id long, reference string"), "t", {"BNK-012"}).where("_is_quarantined").count() == 3


def shuffled(spark):
    """Bytes that all tasks have written for shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    time.sleep(0.5)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_rows_of_no_repeated_key_are_not_shuffled(spark, tmp_path):
    draw = random.Random(8)
    rows = [(i, "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=400))) for i in range(3000)]
    spark.createDataFrame(rows + [(-1 - i, t) for i, t in rows[:30]], "n long, text string").write.parquet(str(tmp_path / "t"))
    df, before, threshold = spark.read.parquet(str(tmp_path / "t")), shuffled(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        told = dedup.with_copies(df, ["text"], ["n"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(told) == 3030 and sorted(r["n"] for r in told if r["_is_copy"]) == list(range(30))
    # the texts have 1.2 MB, and letters at random don't get smaller than 0.6 of that
    assert shuffled(spark) - before < 300_000


def test_bits_that_keys_share_change_nothing(spark, monkeypatch):
    draw = random.Random(9)
    rows = [(i, draw.choice([None, *map(str, range(900))])) for i in range(1200)]
    df = spark.createDataFrame(rows, "n long, k string").repartition(3)
    for words in (1, 2, 1 << 19):
        monkeypatch.setattr(dedup, "WORDS", words)
        told = dedup.marked(df, [F.col("k")], ["n"], "later", F.col("n") % 3 != 0).collect()
        rest = [r for r in rows if r[0] % 3]
        assert len(told) == 1200 and {r["n"] for r in told if r["later"]} == {rest[i][0] for i in expected(rest, lambda r: r[1], lambda r: r[0])}
