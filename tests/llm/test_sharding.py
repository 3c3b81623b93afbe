import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from siltworks.llm.queries import op8_sharding
from siltworks.llm.sharding import external_shuffle, fisher_yates, write_shards


def check(rows, n_shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(n_shards)) <= 1
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op8_sharding(spark, sf).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(texts.keys())
    check(rows, 8)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_many_buckets_nulls_repeats_and_clashes(spark):
    docs = spark.createDataFrame([(i % 700 if i % 9 else None, None if i % 5 == 0 else "é" * (i % 50), "old") for i in range(1500)], "doc_id long, text string, shard string")
    mixed = external_shuffle(docs, n_shards=3, bucket_bytes=500)
    rows = mixed.collect()
    assert len(rows) == 1500
    check(rows, 3)
    assert sorted(map(tuple, mixed.collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert external_shuffle(docs.limit(0)).count() == 0


def test_seed_and_records_decide_alone(spark):
    """A third of all rows are one record, another third differs in a map only; splits of the table change nothing, and no bucket is over twice its size."""
    rows = [(1, "hot" * 20, {"a": 0})] * 500 + [(2, "near" * 15, {"a": i}) for i in range(500)] + [(i, f"text {i}" * 7, None) for i in range(3, 503)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    seen = []
    for split in (docs, docs.repartition(3), docs.orderBy(F.desc("doc_id")).repartition(5)):
        mixed = external_shuffle(split, n_shards=3, bucket_bytes=6000).collect()
        check(mixed, 3)
        seen.append(sorted((r["shard"], r["slot"], r["doc_id"], r["text"], str(r["m"])) for r in mixed))
    assert seen[0] == seen[1] == seen[2]
    assert Counter((r[2], r[3], r[4]) for r in seen[0]) == Counter((a, b, str(c)) for a, b, c in rows)
    other = external_shuffle(docs, n_shards=3, seed=21, bucket_bytes=6000).collect()
    assert sorted((r["shard"], r["slot"], r["doc_id"], r["text"], str(r["m"])) for r in other) != seen[0]
    # copies of the hot record are dealt over the whole permutation
    places = [r[1] * 3 + r[0] for r in seen[0] if r[2] == 1]
    assert max(Counter(p // 100 for p in places).values()) < 75


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(fisher_yates(3, (1, k)).tolist()) for k in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert fisher_yates(0, (1,)).tolist() == [] and fisher_yates(1, (1,)).tolist() == [0]


def test_written_shards(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    write_shards(docs, str(tmp_path / "out"), bucket_bytes=50_000)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()
