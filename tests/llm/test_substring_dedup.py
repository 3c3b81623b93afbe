import hashlib
import random

import numpy as np
import pytest
from siltworks.llm import substring_dedup as module
from siltworks.llm.queries import op6_substring_dedup
from siltworks.llm.substring_dedup import substring_dedup


def brute(data, size=50):
    texts, first, out = [(-1 if d is None else d, (t or "").encode()) for d, t in data], {}, []
    for d, b in texts:
        for i in range(len(b) - size + 1):
            first[b[i : i + size]] = min(first.get(b[i : i + size], d), d)
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


NULS = ["n" * 60 + "q", "\0" * 40 + "n" * 60 + "q" + "\0" * 40, "\0" * 60, "\0" * 49, "\0" * 70, *("\0" * k + "some words that stand in several texts, with NULs on their sides, once more" + "\0" * (40 - k) for k in range(0, 41, 8))]
ODD = [None, "", "a" * 49, "a" * 50, "a" * 50, "a" * 500, "ab" * 300, "b" * 51 + "a" * 70, "é" * 40, "ü" + "é" * 40, "x" + "é" * 30]


def edited(n, size, most, seed):
    at = random.Random(seed)
    base = "".join(at.choice("abcdefgh ") for _ in range(size))
    for _ in range(n):
        b = list(base)
        for _ in range(at.randint(0, most)):
            b[at.randrange(size)] = at.choice("#$%")
        yield "".join(b)


@pytest.mark.parametrize("hot", [4, 1000])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(module, "BUCKET_BYTES", 10_000)
    monkeypatch.setattr(module, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(module, "PIECE", 500)
    monkeypatch.setattr(module, "HOT", hot)
    monkeypatch.setattr(module, "HOT_IN_BLOCK", hot // 2)
    at = random.Random(3)
    noise = lambda n: "".join(at.choice("klmnopqrst ") for _ in range(n))
    passage = noise(400)
    texts = [*ODD, *NULS, *edited(60, 1500, 40, 1), *(noise(at.randint(0, 90)) + passage + noise(at.randint(0, 90)) for _ in range(60)), noise(150_000) + passage]
    data = [*enumerate(texts), (None, "z" * 60), (700, "z" * 60), (700, "z" * 60), (700, "y" * 60), (701, "y" * 61)]
    docs = spark.createDataFrame([(d, t, "old", 1, 2, 3) for d, t in data], "doc_id long, text string, n_spans string, block int, first int, row int")
    assert substring_dedup(docs).columns == ["doc_id", "text", "block", "first", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    rows = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]), r["kept_sha256"]) for r in substring_dedup(docs).collect())
    assert rows == brute(data)


def test_query(spark, sf):
    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op6_substring_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, rows)) == [(*r[:4], r[5]) for r in brute(data)]


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(TypeError):
        substring_dedup(spark.createDataFrame([], "doc_id string, text string"))


def test_longest_previous_factors():
    at = random.Random(5)
    for _ in range(300):
        n = at.randint(0, 40)
        owner, common = np.array([at.randint(0, 6) for _ in range(n)], np.int64), np.array([0, *(at.randint(0, 9) for _ in range(n - 1))][:n], np.int64)
        expected = [max([0, *(min(common[min(i, j) + 1 : max(i, j) + 1]) for j in range(n) if owner[j] < owner[i])]) for i in range(n)]
        assert module.longest_previous_factors(owner, common).tolist() == expected


def test_suffix_order_and_common_prefixes():
    at = np.random.default_rng(2)
    around = at.integers(0, 2, (30, 84)).astype(np.uint8)
    around[5:20, 10:70] = around[5, 10:70]
    valid = at.integers(0, 2, (30, 35)).astype(bool)
    doc = at.integers(0, 9, 30)
    suffixes, common = module.suffix_array(around, valid, doc, 50)
    strings = [around[f // 35, f % 35 : f % 35 + 50].tobytes() for f in suffixes]
    keys = [(s, doc[f // 35]) for s, f in zip(strings, suffixes)]
    assert keys == sorted(keys) and sorted(suffixes) == np.flatnonzero(valid).tolist()
    assert common[1:].tolist() == [next((k for k in range(50) if a[k] != b[k]), 50) for a, b in zip(strings, strings[1:])]
