import json
import random
import time

from pyspark.sql import functions as F

from siltworks.operators import schema
from siltworks.plans.cli import main
from siltworks.plans.pipeline import clean, run_clean, run_validate
from siltworks.plans.providers import DocumentRules, HeuristicRules, repaired_json
from siltworks.sources import exports, files, sinks
from siltworks.streaming import incremental

CSV = "CustomerID,CustGender,phone,email,balance\nC1,Homme,+216 20 123 456,a@b.tn,10\nC1,Homme,20123456,a@b.tn,10\nC2,n/a,ABC,é@b.tn,\"-1\"\n,,,,\n"


def tree(root):
    for path, text in {
        "source_file/clients.csv": "﻿" + CSV,
        "source_file/other/prices.xml": "<?xml version='1.0'?><all><row><a>1</a><b>x</b></row><row><a>2</a></row></all>",
        "source_file/other/list.json": json.dumps([{"a": 1, "s": {"x": 1}}, {"a": 2, "s": {"x": None}}]),
        "transactions-bancaires/tx/1.json": json.dumps({"rows": [{"id": 1}, {"id": 2, "v": "z"}]}),
        "transactions-bancaires/tx/2.json": json.dumps([{"id": 3}]),
        "core/public/wrapped/1.json": json.dumps({"k": [{"id": 1}, {"id": 2}], "one": {"id": 3}, "n": 5}),
        "weather/1.json": json.dumps([{"t": 1}, {"t": 1}]),
        "source_file/readme.txt": "no",
    }.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text, encoding="utf-8")


def test_discovery_and_readers(spark, tmp_path):
    tree(tmp_path)
    groups = files.discover(files.list_files(spark, str(tmp_path)))
    assert sorted(s.key for s in groups) == ["api/weather", "db_rows/transactions-bancaires/tx", "db_wrapped/core/wrapped", "source_file/clients", "source_file/list", "source_file/prices"]
    read = {s.key: files.read(spark, s, [f"{tmp_path}/{p}" for p in ps]) for s, ps in groups.items()}
    assert {k: df.count() for k, df in read.items()} == {"api/weather": 2, "db_rows/transactions-bancaires/tx": 3, "db_wrapped/core/wrapped": 3, "source_file/clients": 4, "source_file/list": 2, "source_file/prices": 2}
    assert read["source_file/clients"].columns[0] == "CustomerID" and read["source_file/prices"].columns == ["a", "b"]
    assert files.manifest(spark, str(tmp_path), groups).count() == 6


def test_clean_and_validate_runs_are_incremental(spark, tmp_path):
    root, out, gold = tmp_path / "raw", str(tmp_path / "clean"), str(tmp_path / "gold")
    tree(root)
    done = {d["group_key"]: d for d in run_clean(spark, str(root), out, HeuristicRules())}
    assert done["source_file/clients"]["rows_input"] == 4 and done["source_file/clients"]["rows_output"] == 3
    assert done["source_file/clients"]["reasons"] == {"invalid_phone": 1, "duplicate": 1} and done["api/weather"]["rows_output"] == 2
    kept = spark.read.parquet(done["source_file/clients"]["path"])
    assert {r["phone"] for r in kept.collect()} == {"20123456", None} and "customer_id" in kept.columns and "gender" in kept.columns
    assert run_clean(spark, str(root), out) == []
    results = {r["table"]: r for r in run_validate(spark, out, gold, HeuristicRules())}
    assert results["clients"]["total"] == 3 and results["clients"]["quarantined"] == 1 and results["clients"]["rules"]["BNK-002"] == 1
    assert run_validate(spark, out, gold, HeuristicRules()) == []
    (root / "source_file/clients.csv").write_text(CSV + "C9,F,,,1\n", encoding="utf-8")
    assert [d["group_key"] for d in run_clean(spark, str(root), out)] == ["source_file/clients"]
    assert len(main(["list", str(root), out])) == 6 and "hashes" in main(["status", str(root), out])[0]


def test_rules_from_documents(spark):
    said = """Here it is: ```{"t": {"cleaning": {"columns": [{"name": "sex", "expected_type": "integer"}, {"name": "amount", "expected_type": "integer"}], "column_renames": {"amt": "amount"}, "unix_timestamp_columns": ["at", "price"]}}}```"""
    assert repaired_json(said).startswith('{"t"')
    df = spark.createDataFrame([(1, "M", "1,5", "1700000000")], "_row_id int, sex string, amt string, at string")
    kept, _ = clean(df, "api", "t", DocumentRules(said))
    assert kept.drop("_row_id").first().asDict() == {"sex": "m", "amount": 15.0, "at": "2023-11-14 22:13:20"}


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 1, 'y', array(named_struct('z', 2), named_struct('z', 3))) AS s, map('k', 1) AS m, cast(array() AS array<int>) AS e")
    rows = schema.flattened(df).collect()
    assert [(r["s_x"], r["s_y_z"], r["m"], r["e"]) for r in rows] == [(1, 2, '{"k":1}', None), (1, 3, '{"k":1}', None)]
    assert schema.flattened(df, keep_empty=False).count() == 0


def test_state(spark, tmp_path):
    path = str(tmp_path / "s.json")
    assert sinks.load_state(spark, path) == {}
    sinks.save_state(spark, path, {"file_hashes": {"a": "é"}})
    assert sinks.load_state(spark, path) == {"hashes": {"a": "é"}}
    (tmp_path / "s2.json").write_text("{broken")
    assert sinks.load_state(spark, str(tmp_path / "s2.json")) == {}


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("SELECT id, concat('R', id % 3) AS reference, CASE WHEN id = 1 THEN '-1' ELSE '1' END AS balance, timestamp'2026-01-01 00:00:00' AS at FROM range(9)").write.parquet(src)
    seen = []

    def each(batch, _):
        done = incremental.stream_validated(batch, "t", {"BNK-002", "BNK-012"})
        seen.extend(r["id"] for r in done.where(F.col("_is_quarantined")).collect())

    ddl = "id long, reference string, balance string, at timestamp"
    incremental.follow(spark, ddl, src, str(tmp_path / "cp"), each).awaitTermination()
    incremental.follow(spark, ddl, src, str(tmp_path / "cp"), each).awaitTermination()
    assert seen == [1]
    stream = spark.readStream.schema(ddl).parquet(src)
    q = incremental.unique_within(stream, ["reference"], "at").writeStream.format("memory").queryName("uniq").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("uniq").count() == 3
    checked = incremental.stream_validated(stream, "t", {"BNK-002"})
    q = incremental.windowed_violations(checked, "at").writeStream.format("memory").outputMode("complete").queryName("wins").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["n"] for r in spark.table("wins").collect()] == [1]


def test_runs_go_on_past_broken_files(spark, tmp_path):
    root, out, gold = tmp_path / "raw", str(tmp_path / "clean"), str(tmp_path / "gold")
    tree(root)
    (root / "source_file/zempty.csv").write_text("")
    (root / "source_file/latin.csv").write_bytes("id,name,gender\n1,René,xx\n2,Ana,f\n".encode("latin-1"))
    (root / "source_file/lines.csv").write_text('id,note\n1,"two\nlines"\n2,x\n')
    (root / "source_file/other/broken.xml").write_text("<")
    # one relative path is the end of another
    (root / "db/public/t").mkdir(parents=True)
    (root / "public/public/t").mkdir(parents=True)
    (root / "db/public/t/1.json").write_text(json.dumps({"r": [{"id": 1}]}))
    (root / "public/public/t/1.json").write_text(json.dumps({"r": [{"id": 2}]}))
    groups = files.discover(files.list_files(spark, str(root)))
    hashed = files.manifest(spark, str(root), groups)
    assert {r["group_key"] for r in hashed.collect()} == {s.key for s in groups}
    assert "NestedLoop" not in hashed._jdf.queryExecution().toString()
    done = {d["group_key"]: d for d in run_clean(spark, str(root), out)}
    assert {k for k, d in done.items() if not d["success"]} == {"source_file/zempty", "source_file/broken"}
    assert {r["name"] for r in spark.read.parquet(done["source_file/latin"]["path"]).collect()} == {"rené", "ana"} or {r["name"] for r in spark.read.parquet(done["source_file/latin"]["path"]).collect()} == {"René", "Ana"}
    assert done["source_file/lines"]["rows_output"] == 2 and done["db_wrapped/db/t"]["rows_output"] == done["db_wrapped/public/t"]["rows_output"] == 1
    assert {d["group_key"] for d in run_clean(spark, str(root), out)} == {"source_file/zempty", "source_file/broken"}
    results = {r["table"]: r for r in run_validate(spark, out, gold, HeuristicRules())}
    # an unknown gender is repaired to NULL, and still warned of
    assert results["latin"]["rules"].get("GEN-006") == 1 and results["latin"]["alerts"] == []
    lines = [r["line"] for r in exports.gauges(spark, out, gold).collect()]
    assert 'validated_last_total{table="latin"} 2.0' in lines and any(x.startswith('clean_last_tables{table="all"} 2') for x in lines)
    assert main(["export", out, gold]) == lines


def shuffled(spark):
    """Bytes that all tasks have written for shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    time.sleep(0.5)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_a_group_is_searched_for_copies_once(spark, tmp_path):
    """What a run shuffles stays below the rows' own size, also if few rows are copies, and nothing stays stored."""
    draw = random.Random(3)
    rows = [(i, "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=400))) for i in range(3000)]
    (tmp_path / "raw/source_file").mkdir(parents=True)
    (tmp_path / "raw/source_file/t.csv").write_text("id,note\n" + "".join(f"{i},{t}\n" for i, t in rows + rows[5:1500:50]))
    before, stored, threshold = shuffled(spark), spark._jsc.getPersistentRDDs().size(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        (done,) = run_clean(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert (done["rows_input"], done["rows_output"], done["reasons"]) == (3030, 3000, {"duplicate": 30})
    assert shuffled(spark) - before < 600_000 and spark._jsc.getPersistentRDDs().size() == stored
    assert [r["_row_id"] for r in spark.read.parquet(done["path"]).orderBy("_row_id").limit(3000).collect()] == list(range(3000))
    assert spark.read.json(f"{tmp_path}/clean/quarantine/*/*/*").groupBy("note").count().count() == 30
