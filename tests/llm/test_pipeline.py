import os

import corpus_pipeline
import tiktoken
from siltworks.llm.byte_bpe import read_ranks
from siltworks.llm.common import shared_dir
from siltworks.llm.queries import op7_decontamination, op10_quality_rules, vocabulary


def test_stages_take_effect(spark, sf, tmp_path):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    docs, kept = source, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == source.dtypes
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert kept["quality rules"] == {r["doc_id"] for r in op10_quality_rules(spark, sf).where("kept").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(kept[b] <= kept[a] for a, b in zip(names, names[1:], strict=False))
    dirty = {r["doc_id"] for r in op7_decontamination(spark, sf).where("contaminated").collect()}
    assert dirty & kept["line dedup"] and kept["byte-level BPE"] == kept["decontamination"]
    path, pattern = vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    for r in docs.collect():
        assert r["decoded"] and r["ids"] == library.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_a_passage_on_a_single_line_stays_once(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"first\n{passage}\nend"), (2, f"second\n{passage}\nother end"), (3, passage), (4, "first\nshort line"), (5, "short line\nlast")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, "").collect()}
    assert out == {1: (rows[0][1], len(rows[0][1])), 2: ("second\nother end", 16), 4: (rows[3][1], 16), 5: (rows[4][1], 15)}


def test_one_row_of_each_group_of_copies_stays(spark):
    text, near = " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(1, 101))
    other, third = " ".join(f"o{i}" for i in range(50)), " ".join(f"t{i}" for i in range(50))
    rows = [*[(5, text, "en")] * 30, (5, text, "de"), (9, text, "en"), (7, near, "en"), (5, other, "en"), *[(None, third, "en")] * 3, (3, "of its own", "en"), (8, None, "en"), (6, "", "en")]
    docs = spark.createDataFrame([(i, t, c, "web", len(t or "")) for i, t, c in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    out = dict(corpus_pipeline.STAGES)["n-gram join"](spark, docs, "")
    assert out.dtypes == docs.dtypes
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in out.collect()), key=str) == sorted([(5, text, "de"), (5, other, "en"), (None, third, "en"), (3, "of its own", "en"), (8, None, "en"), (6, "", "en")], key=str)
    assert dict(corpus_pipeline.STAGES)["n-gram join"](spark, docs.limit(0), "").count() == 0


def test_run_over_nulls_repeats_extra_columns_and_an_empty_table(spark, sf, tmp_path):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    extra = source.selectExpr("*", "1 AS kept", "2 AS n_removed", "3 AS _row", "4 AS first", "5 AS _own", "6 AS contaminated", "7 AS n_words", "8 AS _key")
    nulls = extra.limit(3).selectExpr("CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS text", *(f"`{c}`" for c in extra.columns[2:]))
    for name, docs in (("odd", extra.unionByName(nulls).unionByName(extra.limit(5))), ("empty", extra.limit(0))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "odd" / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes and {tuple(r) for r in out.select("kept", "n_removed", "_row", "first", "_own", "contaminated", "n_words", "_key").distinct().collect()} <= {(1, 2, 3, 4, 5, 6, 7, 8)}
    plain = {(r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, sf).collect()}
    folder = shared_dir(spark)
    before = set(os.listdir(folder.removeprefix("file:")))
    odd = corpus_pipeline.run(spark, str(tmp_path / "odd"))
    # only the result itself stays
    assert len(set(os.listdir(folder.removeprefix("file:"))) - before) == 1
    assert {(r["doc_id"], r["n_tokens"]) for r in odd.collect()} == plain
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


def test_a_stage_over_texts_holds_one_python_worker_a_task_and_sends_the_text_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name in ("decontamination", "byte-level BPE"):
        plan = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)._jdf.queryExecution()
        assert plan.executedPlan().toString().count("MapInArrow") == 1
        sent = plan.optimizedPlan().toString().split("MapInArrow", 1)[1]
        assert ("AS _value" in sent) == (name == "byte-level BPE")
