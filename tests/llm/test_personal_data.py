import hashlib
import random
import re

from siltworks.llm.personal_data import KINDS, base_spans, examine, find_personal_data, luhn, redact
from siltworks.llm.queries import op2_personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_rules_on_random_texts():
    at = random.Random(0)
    for _ in range(30_000):
        text = "".join(at.choice("@@a.b-+ 0123456789()..é%\n") for _ in range(at.randint(0, 60)))
        assert base_spans(text) == brute(text)


def test_luhn_and_long_texts():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    for text in ("1" * 200_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000, "@" * 100_000, "x1" * 100_000):
        examine(text)


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"my phone is {'+1 555 010 %04d' % i if i < 20 else '555-010-%04d' % i} thanks" for i in range(24)] + [f"order number 55501{i:04d} shipped" for i in range(20)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, base_sha256 string")
    rows = {r["doc_id"]: r for r in find_personal_data(docs).collect()}
    assert len(rows) == len(texts)
    assert [(rows[i]["n_phone"], len(rows[i]["entities"])) for i in range(24)] == [(1, 1)] * 20 + [(0, 1)] * 4
    assert all(not rows[i]["entities"] for i in range(24, len(texts)))
    assert {r["text"] for r in redact(find_personal_data(docs)).where("doc_id < 24").collect()} == {"my phone is <phone> thanks"}
    assert find_personal_data(docs.limit(0)).count() == 0


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_personal_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        said = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(b[0] == k for b in base) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(said) <= set(spans) and len(spans) == r["n_found"] and sum(x.startswith("secret:") for x in spans) == r["n_secret"]


def test_contexts_discover_grouped_and_at_forms(spark):
    cards = [f"4111 1111 1111 {i:04d}" for i in range(2000)]
    cards = [c for c in cards if luhn(c.replace(" ", ""))][:20]
    known = [*(("phone is", f"+1 555 010 {i:04d}", "thanks") for i in range(20)), *(("card number", c, "please") for c in cards), *(("write to", f"a{i}@example.com", "soon") for i in range(20))]
    long = "x" * 70 + "1@localhost"
    new = [("phone is", "555 123 4567", "thanks"), ("phone is", "(555) 123-4567", "thanks"), ("card number", "4111 1111 1111 1112", "please"), ("write to", "john[at]example.com", "soon"), ("write to", "mary (at) example.com", "soon"), ("write to", long, "soon")]
    kinds = ["phone", "phone", "card", "email", "email", "email"]
    docs = spark.createDataFrame([(i, f"my {a} {x} {b}") for i, (a, x, b) in enumerate(known + new)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in find_personal_data(docs).collect()}
    for i, ((a, x, _), kind) in enumerate(zip(new, kinds, strict=True), len(known)):
        at = len(f"my {a} ")
        assert [tuple(e) for e in rows[i]["entities"]] == [(kind, at, at + len(x))], x


def test_what_is_discovered_induces_patterns(spark):
    known = [("call me on", f"+1 555 010 {i:04d}", "thanks") for i in range(30)]
    # the first context has seeds, the second one is reached through strings that the first discovers, the third through the second
    hop1 = [("call me on", f"555-011-{i:04d}", "thanks") for i in range(12)]
    hop2 = [("ring her at", f"555-011-{i:04d}", "today") for i in range(12)] + [("ring her at", f"555-012-{i:04d}", "today") for i in range(2)]
    hop3 = [("the fax is", f"555-012-{i:04d}", "there") for i in range(2)] + [("the fax is", f"555-011-{i:04d}", "there") for i in range(8)] + [("the fax is", "555-013-0000", "there")]
    clean = [("part number", f"555-02{i % 10}-{i:04d}", "ordered") for i in range(30)] + [("in the year", f"{1900 + i}", "he") for i in range(30)]
    texts = [f"please {a} {x} {b} {'word ' * 40}" for a, x, b in known + hop1 + hop2 + hop3 + clean]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = {r["doc_id"]: r for r in find_personal_data(docs).collect()}
    dirty = len(known + hop1 + hop2 + hop3)
    found = {i for i, r in rows.items() if r["entities"]}
    right = len(found & set(range(dirty)))
    assert right >= 0.9 * dirty and right >= 0.9 * len(found)
    last = rows[dirty - 1]
    at = texts[dirty - 1].index("555-013")
    assert [tuple(e) for e in last["entities"]] == [("phone", at, at + 12)]
    assert all(rows[i]["base_sha256"] == hashlib.sha256(b"").hexdigest() for i in range(len(known), len(texts)))


def test_secrets_and_long_contexts(spark):
    key = lambda i: hashlib.sha256(str(i).encode()).hexdigest()[:40]
    long = "x" * 500
    texts = [f'a token = "{key(i)}" b' for i in range(9)] + [f"commit {key(99)} was made", "token = none", f"{long} {long} a@b.cd {long}", "a " * 20_000 + "my password: Aa11Bb22Cc33Dd44Ee"]
    rows = {r["doc_id"]: r["entities"] for r in find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [[e["kind"] for e in rows[i]] for i in range(len(texts))] == [["secret"]] * 9 + [[], [], ["email"], ["secret"]]
