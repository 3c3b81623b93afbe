import re
from collections import Counter

from siltworks.llm.quality_rules import RULES, fit, judge, quality_rules, repeated_words
from siltworks.llm.queries import op10_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    ws = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    counts, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            hit.update(range(i, i + 5))
    return len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


TEXTS = [None, "", " \n\t", "one", "a b c d e a b c d e", "a " * 5000, "x y\nx y\n\n\nx y", "É# *$%&|<> z", "a b c d e f " * 3 + "g h", "w" * 100_000]


def test_base_figures(spark):
    for t in TEXTS:
        assert judge(t)[:5] == base(t)
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, kept string")
    rows = quality_rules(docs).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        n, *_, repeats = base(r["text"])
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules(docs.limit(0)).count() == 0


def test_repeats_cover_overlaps():
    assert repeated_words(["a"] * 6) == 6 and repeated_words(["a"] * 5) == 0


def test_fit_trusts_rules_that_agree():
    prior, ratio = fit([("+" * len(RULES), 800), ("-" * len(RULES), 200), ("-" + "+" * (len(RULES) - 1), 100)])
    assert prior > 0 and (ratio[:, 2] > 0).all() and (ratio[:, 0] < 0).all()
    assert abs(ratio[0, 0]) < abs(ratio[1, 0])
    assert fit([])[0] == 0


def test_query_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op10_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base(texts[r["doc_id"]])
    kept = {r["doc_id"]: r["kept"] for r in rows if not r["base_failed"]}
    labels = [(r["quality"], kept[r["doc_id"]]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in kept]
    assert sum(q == k for q, k in labels) >= 0.9 * len(labels)
    assert sum(k for q, k in labels if q) >= 0.97 * sum(q for q, _ in labels)
