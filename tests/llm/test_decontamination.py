import hashlib
import re

from siltworks.llm.decontamination import Matcher, decontaminate
from siltworks.llm.queries import op7_decontamination

W = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return W.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items, size=13):
    ws, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        for at in range(max(1, len(iw) - size + 1) if iw else 0):
            window = iw[at : at + size]
            for i in range(len(ws) - len(window) + 1):
                if ws[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
    return len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws)


ITEMS = [(1, "a b c"), (2, "One two, THREE four five six seven eight nine ten eleven twelve thirteen fourteen"), (3, None), (10, ""), (4, "x"), (5, "a b c"), (6, "ééé ß " * 9)]
TEXTS = [None, "", "...", "a b c a b c", "zz one two three four five six seven eight nine ten eleven twelve thirteen fourteen q", "X y x", "a b " * 40, "ééé ß " * 20, "x " * 3000]


def test_against_brute_force_in_one_and_many_blocks(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*TEXTS, TEXTS[3]])], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for size in (1 << 20, 64):
        rows = decontaminate(docs, bench, block_bytes=size).collect()
        assert len(rows) == len(TEXTS) + 1
        for r in rows:
            assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == brute(r["text"], ITEMS)


def test_items_without_ids_are_dealt_by_text(spark):
    """Blocks stay small although all items have one id, or none; repeated items count once."""
    texts = [" ".join(f"w{i}x{j}" for j in range(13)) for i in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for item in (7, None):
        bench = spark.createDataFrame([(item, t) for t in texts for _ in range(3)], "item_id long, text string")
        rows = decontaminate(docs, bench, block_bytes=1500).collect()
        assert len(rows) == 30 and all(r["contaminated"] and (r["n_hit"], r["n_items"]) == (13, 1) for r in rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not decontaminate(docs, bench).first()["contaminated"]
    assert decontaminate(docs.limit(0), bench).count() == 0


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {}
    for item, t in items:
        ws = words(t)
        for at in range(max(1, len(ws) - 12) if ws else 0):
            windows.setdefault(tuple(ws[at : at + 13]), set()).add(str(item))
    assert {len(w) for w in windows} == {13}
    hits = 0
    for r in op7_decontamination(spark, sf).collect():
        ws, hit, found = words(texts[r["doc_id"]]), set(), set()
        for i in range(len(ws) - 12):
            if own := windows.get(tuple(ws[i : i + 13])):
                hit.update(range(i, i + 13))
                found |= own
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(ws), len(hit), len(found))
        assert r["contaminated"] == (bool(hit) and 20 * len(hit) >= len(ws))
        hits += bool(hit)
    assert hits > 0


def test_shift_table_skips():
    m = Matcher([("1", "a b c d e f g h i j k l m")])
    assert max(m.machines[0].shift.values()) == 11
