import time

import pytest
from pyspark.sql import functions as F

from siltworks.operators import rules
from siltworks.streaming import live
from siltworks.streaming.references import STATE_STORE, stream_validated_all

DDL = "id long, reference string, amount string"


@pytest.fixture
def states(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STATE_STORE)
    yield
    spark.conf.set(name, before)


def put(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, keep=None):
    """Validates what has come since the last run, as a process of its own would: all it shares with it is the checkpoint."""
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    checked = stream_validated_all(stream, "transactions", {"BNK-012", "BNK-003"}, "id", keep=keep)
    checked.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    return {r["id"]: [v["rule_id"] for v in r["_violations"]] for r in out.collect()}


def test_repeats_over_batches_and_restarts(spark, tmp_path, states):
    put(spark, str(tmp_path / "in"), [(2, "R1", "5"), (1, " R1", "5"), (3, None, "5"), (4, "R2", "-1")])
    assert run(spark, tmp_path) == {1: [], 2: ["BNK-012"], 3: [], 4: ["BNK-003"]}
    put(spark, str(tmp_path / "in"), [(5, "R2 ", "5"), (6, None, "5"), (7, "R3", "5")])
    put(spark, str(tmp_path / "in"), [(8, "R3", "0")])
    found = run(spark, tmp_path)
    assert {i: v for i, v in found.items() if i > 4} == {5: ["BNK-012"], 6: [], 7: [], 8: ["BNK-003", "BNK-012"]}


def test_forgotten_references(spark, tmp_path, states):
    put(spark, str(tmp_path / "in"), [(1, "R1", "5")])
    stream = spark.readStream.schema(DDL).parquet(str(tmp_path / "in"))
    checked = stream_validated_all(stream, "transactions", {"BNK-012"}, "id", keep=1)
    # processing time goes on, so such a stream ends only when it is stopped
    query = checked.writeStream.format("memory").queryName("forgotten").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start()

    def wait(n):
        for _ in range(120):
            if query.exception() or spark.table("forgotten").count() == n:
                break
            time.sleep(0.25)

    try:
        wait(1)
        time.sleep(2)
        put(spark, str(tmp_path / "in"), [(2, "R1", "5")])
        wait(2)
        put(spark, str(tmp_path / "in"), [(3, "R4", "5"), (4, "R4", "5")])
        wait(4)
        assert query.exception() is None
        assert {r["id"]: r["_is_quarantined"] for r in spark.table("forgotten").collect()} == {1: False, 2: False, 3: False, 4: True}
    finally:
        query.stop()


def test_live_totals_equal_the_reports(spark, tmp_path):
    src = str(tmp_path / "in")
    put(spark, src, [(1, "a", "5"), (2, "b", "-5")])
    put(spark, src, [(3, "c", "-1"), (4, "d", "7"), (5, "e", "8")])
    said = []
    listener = live.following(spark, names={"tx"}, each=said.append)
    try:
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(src)
        checked = live.observed_stream(rules.validated(stream, "transactions", {"BNK-003"}), "tx")
        checked.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if listener.totals.get("tx", {}).get("total") == 5:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals["tx"] == {"total": 5, "quarantined": 2, "warning": 0, "major": 0, "critical": 2}
    assert 'live_rows{stream="tx",kind="quarantined"} 2.0' in listener.lines() and said
    # progress that is told again counts once
    listener.add("q", 0, "tx", {"total": 1})
    listener.add("q", 0, "tx", {"total": 1})
    assert listener.totals["tx"]["total"] == 6


def test_observed_batches(spark, tmp_path):
    df = rules.validated(spark.createDataFrame([(1, "a", "5"), (2, "b", "-5")], DDL), "transactions", {"BNK-003"})
    counted, seen = live.observed(df)
    counted.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"total": 2, "quarantined": 1, "warning": 0, "major": 0, "critical": 1} and spark.read.parquet(str(tmp_path / "t")).where(F.col("_is_quarantined")).count() == 1
