import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from siltworks.llm.byte_bpe import decode, digests, encode, merge, read_ranks, round_trips
from siltworks.llm.queries import op5_byte_bpe, vocabulary

RANKS = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [None, "", " ", "\n\n  x", "a" * 5000, "ab" * 1500 + "é", "日本語テキスト", "🙂" * 300, "don't <|endoftext|> 12345", "\x00\x01", "thethethe" * 400]


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_merge_long_piece_like_library():
    for text in ("x" * 999, "the" * 333, "zq" * 500):
        assert merge(text.encode(), RANKS) == LIBRARY._encode_single_piece(text.encode())


def test_ranks_with_gaps():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"bc": 10, b"abc": 4_000_000_000}
    assert merge(b"abc", ranks) == [4_000_000_000] and merge(b"bca", ranks) == [10, 0] and merge(b"abcabca", ranks) == [4_000_000_000, 4_000_000_000, 0]


def test_odd_texts_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(ODD)] + [(0, None, "old")], "doc_id long, text string, n_tokens string")
    rows = digests(docs, *vocabulary()).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(r["text"])


def test_round_trip(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    for r in decode(encode(docs, *vocabulary()), *vocabulary()).collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["ids"] == LIBRARY.encode_ordinary(r["text"] or "")


def test_ids_and_their_check_in_one_pass(spark):
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(ODD)] + [(0, None, "old")], "doc_id long, text string, ids string")
    out = round_trips(docs, *vocabulary())
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(((r["doc_id"], r["text"], r["ids"], r["decoded"]) for r in out.collect()), key=str) == sorted(((i, t, LIBRARY.encode_ordinary(t or ""), True) for i, t in [*enumerate(ODD), (0, None)]), key=str)


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(texts[r["doc_id"]])


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], "doc_id long, text string"), *vocabulary()).count() == 0
