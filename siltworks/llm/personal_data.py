"""Personal data by bootstrapped contextual extraction.

Seeds are the spans that the base rules find (e-mail, IP address, payment card, phone) and secrets: long values of letters and
digits that are assigned to a name like token or password. Every seed, and every candidate with the shape of a kind, has lexical
patterns: the two words before it, and the words on its two sides. Patterns and instances (distinct strings) form a graph. Spark
scores it in rounds: a pattern's confidence in a kind is the mean score of its distinct instances, with PRIOR instances of score 0
added, if MIN_SEEDS distinct instances of score CONFIDENT support it; an instance's score is the noisy-or of the confidences of its
patterns, in the kinds whose shape it has. So what a pattern discovers supports further patterns in the next round. Rounds go on
until no pattern is new, ROUNDS at most. Candidates in a pattern of confidence CONFIDENT that have the shape of its kind are added.

Candidates are the tokens between white space with a digit or an @; what is joined by [at] or (at), with a space on each side at
most; and, outside base spans, runs of digits with single separators (space, dot, hyphen, slash, brackets) that have a kind's shape.
If a whole run has none, the shaped pieces between spaces at its two ends are tried. Found spans that lie in a larger found one are
dropped. Tokens and runs may be of any length, context words of LONGEST code points; the graph holds long ones by their hashes.

Sums over a pattern are pre-aggregated before the shuffle, and the heavy instances and patterns of a join are broadcast, so a pattern
with very many instances, or a string in very many patterns, is no hot group.

Defined cases: a null text is empty and has no spans; very long texts are read whole; repeated rows get the same spans each; an empty
table gives no rows; columns named like an output column are replaced, others may have any name. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.llm.common import heavy_join, per_row, scratch, stored

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]+")
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
AT = re.compile(r"[\[(]\x20?at\x20?[\])]", re.I)
BESIDE = re.compile(r"\x20?\S*")
RUN = re.compile(r"[(\[]?[0-9](?:[)\]]?[\x20./\u00a0-]?[(\[]?[0-9])*+")
GROUP = re.compile(r"[^\x20\u00a0]+")
WORD = re.compile(r"\S+")
ASSIGNED = re.compile(r"[=:]\s*[\"']?([A-Za-z0-9+/_=.-]{16,})")
NAMED = re.compile(r"(?:api[_ -]?key|access[_ -]?key|token|secret|passw(?:or)?d|pwd)[\"']?\s*$", re.I)
SECRET = re.compile(r"(?=(?:[^0-9]*[0-9]){4})(?=(?:[^A-Za-z]*[A-Za-z]){4})[A-Za-z0-9+/_=.-]{16,}")
EDGES = ".,;:!?()[]{}<>\"'|*#"

#: Distinct supporters that a pattern needs, instances of score 0 that are added to it, confidence to discover, rounds of scoring at most.
MIN_SEEDS, PRIOR, CONFIDENT, ROUNDS = 3, 2.0, 0.6, 6
#: Longer strings are held by their hashes; what stands beside a place for more code points without white space is no context word.
HELD, LONGEST = 64, 1000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str):
    """A local part can't hold an @, so each @ is looked at once: what stands before it, back to the last match or @."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        low = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            low = m.end()
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", *s) for s in emails(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(d := DIGITS.sub("", m[0])) <= 19 and luhn(d):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(DIGITS.sub("", m[0])) <= 15]
    return spans


def secrets(text: str) -> list[tuple[int, int]]:
    """Places of long values of letters and digits that are assigned to a name of a credential."""
    return [m.span(1) for m in ASSIGNED.finditer(text) if NAMED.search(text, max(0, m.start() - 24), m.start()) and SECRET.fullmatch(m[1])]


def shapes(token: str) -> list[str]:
    """Kinds whose form a token has, loosely: what the base rules are too strict for."""
    digits = DIGITS.sub("", token)
    found = []
    if 0 < token.find("@") < len(token) - 1 or AT.search(token):
        found.append("email")
    if re.fullmatch(r"[0-9]{1,3}(?:[.:\[\]]+[0-9]{1,3}){3}.*", token):
        found.append("ip")
    if 13 <= len(digits) <= 19 and len(digits) >= 0.7 * len(token):
        found.append("card")
    elif 7 <= len(digits) <= 15 and len(digits) >= 0.6 * len(token):
        found.append("phone")
    if SECRET.fullmatch(token):
        found.append("secret")
    return found


def held(said: str) -> str:
    return said if len(said) <= HELD else hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest()


class Contexts:
    """Patterns of the places of a text; its words are looked for once, when the first place asks."""

    def __init__(self, text: str):
        self.text, self.words = text, None

    def __call__(self, start: int, end: int) -> list[str]:
        if self.words is None:
            self.words = [m.span() for m in WORD.finditer(self.text)]
        text, words = self.text, self.words
        word = lambda a, b: held(re.sub(r"[0-9]+", "0", text[a:b].strip(EDGES).lower())) if b - a <= LONGEST else ""
        i = bisect_left(words, (start,))
        before = [word(a, min(b, start)) for a, b in words[max(0, i - 2) : i]]
        # a word that goes on behind the place counts from there
        j = bisect_left(words, (end,))
        if j and words[j - 1][1] > end:
            j -= 1
        after = [word(max(a, end), b) for a, b in words[j : j + 1]]
        found = []
        if len(before) == 2 and all(before):
            found.append(f"{before[0]} {before[1]} _")
        if before and before[-1] and after and after[0]:
            found.append(f"{before[-1]} _ {after[0]}")
        return found


def tokens(text: str):
    """Places of the white-space separated tokens that hold a digit or an @, without punctuation at their edges."""
    at = 0
    while m := MARK.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        gap = SPACE.search(text, m.end())
        end = at = gap.start() if gap else len(text)
        whole = text[start:end]
        start += len(whole) - len(whole.lstrip(EDGES))
        end -= len(whole) - len(whole.rstrip(EDGES))
        if start < end:
            yield start, end


def at_signs(text: str):
    """Places of what is joined by [at] or (at)."""
    at = 0
    while m := AT.search(text, at):
        start = m.start() - (m.start() > at and text[m.start() - 1] == " ")
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = at = BESIDE.match(text, m.end()).end()
        whole = text[start:end]
        start += len(whole) - len(whole.lstrip(EDGES + " "))
        end -= len(whole) - len(whole.rstrip(EDGES + " "))
        if start < m.start() and m.end() < end:
            yield start, end


def runs(text: str, low: int, high: int):
    """Places of the shaped runs of digits in a part of the text, or of the shaped pieces at the ends of a run."""
    for m in RUN.finditer(text, low, high):
        start, end = m.span()
        if text[start] in "([" and not re.search(r"[)\]]", m[0]):
            start += 1
        if shapes(text[start:end]):
            yield start, end
            continue
        edges = [g.span() for g in GROUP.finditer(text, start, end)]
        # a shape has 19 digits at most, so no more groups can be in a piece
        for n in range(1, min(len(edges), 20)):
            for a, b in {(start, edges[n - 1][1]), (edges[-n][0], end)}:
                if shapes(text[a:b]):
                    yield a, b


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
MENTIONS = pa.list_(pa.struct([("seed", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string())), ("shapes", pa.list_(pa.string()))]))
FOUND = pa.schema([*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("base", SPANS), ("mentions", MENTIONS)])
SPANS_DDL = "array<struct<kind:string,start:int,end:int>>"
FOUND_DDL = ", ".join([*(f"n_{k} bigint" for k in KINDS), f"base_sha256 string, base {SPANS_DDL}"]) + ", mentions array<struct<seed:string,start:int,end:int,instance:string,patterns:array<string>,shapes:array<string>>>"


def examine(text: str | None) -> tuple:
    """Counts, hash and spans of the base rules (and secrets among the spans), and all mentions that have patterns: seeds and shaped candidates."""
    text = text or ""
    base, patterns = base_spans(text), Contexts(text)
    counts = [sum(s[0] == k for s in base) for k in KINDS]
    said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
    seeds = [*base, *(("secret", s, e) for s, e in secrets(text))]
    taken = sorted(s[1:] for s in seeds)
    mentions = [(k, s, e, held(text[s:e].lower()), p, [k]) for k, s, e in seeds if (p := patterns(s, e))]
    places, low = set(tokens(text)) | set(at_signs(text)), 0
    for start, end in [*taken, (len(text), len(text))]:
        if start > low:
            places.update(runs(text, low, start))
        low = max(low, end)
    i = 0
    for start, end in sorted(places):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if any(s < end and e > start for s, e in taken[i : i + 3]):
            continue
        if (kinds := shapes(text[start:end])) and (p := patterns(start, end)):
            mentions.append((None, start, end, held(text[start:end].lower()), p, kinds))
    names = ("seed", "start", "end", "instance", "patterns", "shapes")
    return *counts, hashlib.sha256(said.encode()).hexdigest(), [dict(zip(("kind", "start", "end"), s, strict=True)) for s in seeds], [dict(zip(names, m, strict=True)) for m in mentions]


def confident_patterns(mentions: DataFrame) -> DataFrame:
    """pattern, kind, confidence and m (its mentions) of the patterns that discover; mentions: one row per mention."""
    edges = mentions.select(F.explode("patterns").alias("pattern"), "instance", "seed", "shapes")
    edges = stored(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("shapes").alias("shapes"), F.count("*").alias("m")))
    size = stored(edges.groupBy("pattern").agg(F.count("*").alias("n"), F.sum("m").alias("m")))
    degree = stored(edges.groupBy("instance").agg(F.count("*").alias("degree"), F.max("seed").alias("seed")))
    # a string that is a seed anywhere is known everywhere
    seeds = degree.where("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
    unseen = edges.join(degree.where("seed is null").select("instance"), "instance", "left_semi")
    scores, confident, before = seeds, None, 0
    for _ in range(ROUNDS):
        known = stored(scores.groupBy("instance").agg(F.collect_list(F.struct("kind", "score")).alias("kinds")).join(degree.select("instance", "degree"), "instance"))
        told = heavy_join(edges.select("pattern", "instance"), known, ["instance"], "degree").select("pattern", F.explode("kinds").alias("k")).select("pattern", "k.*")
        sums = told.groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count_if(F.col("score") >= CONFIDENT).alias("support")).where(F.col("support") >= MIN_SEEDS)
        scored = stored(sums.join(size, "pattern").select("pattern", "kind", (F.col("sum") / (F.col("n") + PRIOR)).alias("confidence"), "n", "m"))
        confident = scored.where(F.col("confidence") >= CONFIDENT)
        if (n := confident.count()) == before:
            break
        before = n
        by_pattern = stored(scored.groupBy("pattern").agg(F.collect_list(F.struct("kind", "confidence")).alias("kinds"), F.max("n").alias("n")))
        reached = heavy_join(unseen.select("pattern", "instance", "shapes"), by_pattern, ["pattern"], "n").select("instance", "shapes", F.explode("kinds").alias("k")).where(F.array_contains("shapes", F.col("k.kind")))
        scores = seeds.unionByName(reached.groupBy("instance", F.col("k.kind").alias("kind")).agg((1 - F.exp(F.sum(F.log(1 - F.col("k.confidence"))))).alias("score")))
    return confident


def find_personal_data(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with n_email, n_ip, n_card, n_phone (base spans), base_sha256 and entities: all spans (kind, start, end), in order."""
    new = [*(f"n_{k}" for k in KINDS), "base_sha256", "entities"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in new]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry), F.lit(0).alias("_none")).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = StructType([rows.schema["_row"], *StructType.fromDDL(FOUND_DDL).fields])
    with scratch(docs.sparkSession) as kept:
        seen = stored(rows.mapInArrow(per_row(examine, ["_text"], FOUND, ["_row"]), schema).withColumn("_number", F.monotonically_increasing_id()))
        mentions = seen.select("_number", F.explode("mentions").alias("m")).select("_number", "m.*")
        good = stored(confident_patterns(mentions).groupBy("pattern").agg(F.collect_list(F.struct("kind", "confidence")).alias("kinds"), F.max("m").alias("m")))
        unseen = mentions.where("seed is null").select("_number", "start", "end", "shapes", F.explode("patterns").alias("pattern"))
        found = heavy_join(unseen, good, ["pattern"], "m").select("_number", "start", "end", "shapes", F.explode("kinds").alias("k")).where(F.array_contains("shapes", F.col("k.kind")))
        added = found.groupBy("_number", "start", "end").agg(F.max_by("k.kind", F.struct("k.confidence", "k.kind")).alias("kind"))
        wider = Window.partitionBy("_number").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
        added = added.withColumn("_reached", F.max("end").over(wider)).where("_reached is null or end > _reached").groupBy("_number").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
        order = F.array(*map(F.lit, ALL_KINDS))
        spans = F.concat("base", F.coalesce("more", F.expr(f"cast(array() as {SPANS_DDL})")))
        ranked = F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        entities = F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        return kept(seen.join(added, "_number", "left").withColumn("entities", entities).select(*(F.col(f"_row.`{c}`") for c in carry), *new))


def redact(docs: DataFrame, text: str = "text", entities: str = "entities") -> DataFrame:
    """docs with each found span in text replaced by its kind in angle brackets; overlapping spans are replaced together, by the first's kind."""
    kept = F.aggregate(
        F.array_sort(F.transform(entities, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda done, s: F.when(s["start"] < done["at"], F.struct(done["out"].alias("out"), F.greatest(done["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(done["out"], F.substr(text, done["at"] + 1, s["start"] - done["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"), s["end"].alias("at"))
        ),
        lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1)),
    )
    return docs.withColumn(text, F.when(F.size(entities) > 0, kept).otherwise(F.col(text)))
