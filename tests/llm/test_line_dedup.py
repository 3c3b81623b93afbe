import hashlib
import random
import re

import pytest

from siltworks.llm.line_dedup import common_prefixes, line_dedup, repeated_lines, suffix_intervals, suffix_paths
from siltworks.llm.queries import op1_line_dedup


def brute(docs, m):
    """{(doc_id, text): (kept text, lines, removed, runs)}"""
    lines = {(d is not None, d, t): t.split("\n") for d, t in docs if t is not None}
    first, out = {}, {}
    for d in sorted(lines, key=lambda x: (x[0], x[1] or 0)):
        for p in range(len(lines[d]) - m + 1):
            first.setdefault(tuple(lines[d][p : p + m]), (d, p))
    for d, ls in lines.items():
        gone = {q for p in range(len(ls) - m + 1) if first[tuple(ls[p : p + m])] != (d, p) for q in range(p, p + m)}
        out[d[1:]] = ("\n".join(x for i, x in enumerate(ls) if i not in gone), len(ls), len(gone), sum(q - 1 not in gone for q in gone))
    return out


TEXTS = [None, "", "one", "a\nb\nc", "x\na\nb", "a\na\na\na", "\n\n\n", "q\nx\na\nb\ny", "l\n" * 400, "é\nb\nc\nd", "a\nb\nc"]


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_against_brute_force(spark, m):
    data = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(i, t, "old", 1) for i, t in data], "doc_id long, text string, n_runs string, row int")
    expected = brute(data, m)
    rows = line_dedup(docs, min_lines=m).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(TEXTS)))
    for r in rows:
        t = TEXTS[r["doc_id"]]
        assert (r["text"], r["n_lines"], r["n_removed"], r["n_runs"]) == (expected[r["doc_id"], t] if t is not None else (None, 0, 0, 0))


def test_repeated_rows_null_keys_and_empty_table(spark):
    docs = spark.createDataFrame([(3, "a\nb"), (3, "a\nb"), (None, "a\nb"), (4, "a\nb\nc")], "doc_id long, text string")
    rows = line_dedup(docs).collect()
    assert len(rows) == 4
    assert {(r["doc_id"], r["text"]) for r in rows} == {(3, ""), (None, "a\nb"), (4, "c")}
    assert line_dedup(docs.limit(0)).count() == 0


def test_suffix_order_common_prefixes_and_intervals(spark):
    at = random.Random(4)
    texts = ["\n".join(at.choice("ab" if i % 3 else "abcdefg") for _ in range(at.randint(1, 25))) for i in range(40)] + ["\n".join("xyzxyzxyzxyzq" * 3), "\n".join("xyzxyzxyzxyz" * 3)]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[3])], "doc_id long, text string")
    lines = repeated_lines(docs, "doc_id", "text")
    suffixes = suffix_paths(lines)
    rows = common_prefixes(suffixes).orderBy("_part", "_at").collect()
    found = {(r["_key"], r["pos"]): r["left"] for r in lines.collect()}
    split = {k: (texts[3] if k is None else texts[k]).split("\n") for k in [None, *range(len(texts))]}
    suffix = lambda r: split[r["_key"]][r["pos"] : r["pos"] + found[r["_key"], r["pos"]]]
    assert {(r["_key"], r["pos"]) for r in rows} == set(found) and len(rows) == len(found)
    # lines are ordered by their numbers
    number = {}
    for r in lines.collect():
        number[split[r["_key"]][r["pos"]]] = r["rank"]
    ordered = [[number[x] for x in suffix(r)] for r in rows]
    assert ordered == sorted(ordered)
    shared = lambda x, y: next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    expected = [0, *(shared(a, b) for a, b in zip(ordered, ordered[1:]))]
    assert [r["common"] for r in rows] == expected
    for n in (1, 2, 3, 5):
        groups, said = {}, {(r["_key"], r["pos"]): r["interval"] for r in suffix_intervals(common_prefixes(suffixes, n), n).collect()}
        for r, c in zip(rows, expected):
            here = (r["_key"], r["pos"])
            groups[here] = groups[before] if c >= n else len(groups)
            before = here
        assert len(set(groups.values())) == len(set(said.values())) == len({(groups[k], said[k]) for k in groups})


def test_query(spark, sf):
    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    split, alone, expected = {d: t.split("\n") for d, t in data}, {}, {}
    for d in sorted(split):
        for p, line in enumerate(split[d]):
            alone.setdefault(line, (d, p))
    windows = {}
    for d in sorted(split):
        for p in range(len(split[d]) - 1):
            windows.setdefault(tuple(split[d][p : p + 2]), (d, p))
    for d, ls in split.items():
        gone = {q for p in range(len(ls) - 1) if windows[tuple(ls[p : p + 2])] != (d, p) for q in (p, p + 1)}
        gone |= {p for p, x in enumerate(ls) if (len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= 10 or len(x.strip(" ")) >= 100) and alone[x] != (d, p)}
        expected[d] = (len(ls), len(gone), sum(q - 1 not in gone for q in gone), hashlib.sha256("\n".join(x for i, x in enumerate(ls) if i not in gone).encode()).hexdigest())
    rows = op1_line_dedup(spark, sf).collect()
    assert len(rows) == len(data)
    assert all((r["n_lines"], r["n_removed"], r["n_runs"], r["kept_sha256"]) == expected[r["doc_id"]] for r in rows)


def test_very_long_text(spark):
    # one line of its own between repeated ones, so that sequences are short however long the text is
    long = "\n".join(f"{i}\nsame" if i % 3 else f"{i}\nsame\nrun" for i in range(30_000))
    docs = spark.createDataFrame([(1, long), (2, "same\nrun\nend")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert (rows[1]["n_lines"], rows[1]["n_removed"], rows[1]["n_runs"]) == (70_000, 2 * 9_999, 9_999) and rows[2]["text"] == "end"


@pytest.mark.parametrize("m", [1, 2, 3])
def test_long_single_lines_go_without_a_neighbour(spark, m):
    passage, wide, short = "one two three four five", "語" * 40, "one two three"
    texts = [f"a\n{passage}\nb", f"c\n{passage}\nd\n{wide}", passage, f"{short}\nx\n{wide}", f"{short}\ny", f"{passage}\n{passage}\n\n\nc\nd", f"q\n{passage}\na\n{passage}\nb", "\n", "r\n", None, short]
    lines = {i: t.split("\n") for i, t in enumerate(texts) if t is not None}
    first, alone = {}, {}
    for i, ls in lines.items():
        for p in range(len(ls) - m + 1):
            first.setdefault(tuple(ls[p : p + m]), (i, p))
        for p, x in enumerate(ls):
            alone.setdefault(x, (i, p))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = line_dedup(docs, min_lines=m, min_words=4).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if (i := r["doc_id"]) not in lines:
            continue
        ls = lines[i]
        gone = {q for p in range(len(ls) - m + 1) if first[tuple(ls[p : p + m])] != (i, p) for q in range(p, p + m)}
        gone |= {p for p, x in enumerate(ls) if (len(x.split()) >= 4 or len(x) >= 40) and alone[x] != (i, p)}
        assert (r["text"], r["n_removed"], r["n_runs"]) == ("\n".join(x for p, x in enumerate(ls) if p not in gone), len(gone), sum(p - 1 not in gone for p in gone))
