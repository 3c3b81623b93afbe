"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation over the counts of vote
patterns of ALL documents estimates how far each rule can be trusted; a document is kept when its posterior probability
of being good reaches ``threshold``. Documents that fail the base limits are never kept.

Defined cases: a null or empty text has no words, so it fails the base limits; repeated rows are judged alike; an empty
table gives an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import map_rows, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = b"#*$%&|<>"
# Very common words of four languages.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are as with his they at be this from have or by not but what all were when we there can an your "
    "le la les de des un une et est dans que qui pour sur pas au du en avec il elle par "
    "der die das und ist von mit zu den im für auf ein eine nicht des dem sich auch "
    "el los las y por para con una su lo como del se al".split()
)
RULES = ("length", "word_length", "symbols", "repeats", "duplicate_lines", "capitals", "line_ends", "stop_words", "variety")

BASE = pa.schema([(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
VOTES = pa.schema([("votes", pa.string())])


def repeated_words(words: list[str], n: int = 5) -> int:
    """Words that lie in an n-word window which the text has at least twice. Windows get dense numbers, so equality is exact."""
    if len(words) < n + 1:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    grams, base = ids, len(numbers)
    for step in range(1, n):
        grams, counts = np.unique(grams[: len(ids) - step] * base + ids[step:], return_inverse=True, return_counts=True)[1:]
        if step >= 2 and (counts == 1).all():
            return 0
    twice = counts[grams] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judge(text: str | None) -> tuple:
    """The base figures of one text, and its votes as a string of one of +, - and 0 for each rule."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    histogram = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    n_symbols = int(sum(histogram[c] for c in SYMBOLS))
    word_chars = sum(map(len, words))
    lines, seen, dup = 0, set(), 0
    closed = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
            closed += line.rstrip()[-1:] in ".!?…\"'»”:;)"
    repeats = repeated_words(words)
    if not n:
        return 0, 0, n_symbols, 0, 0, "-" + "0" * (len(RULES) - 1)

    def vote(good: bool, bad: bool) -> str:
        return "-" if bad else "+" if good else "0"

    upper, lower = int(histogram[65:91].sum()), int(histogram[97:123].sum())
    mean, symbols, copied = word_chars / n, n_symbols / n, repeats / n
    stops = sum(w in STOP_WORDS for w in words) / n
    variety = len(set(words)) / n
    votes = (
        vote(n >= 50, n < 10),
        vote(3 <= mean <= 10, not 2 <= mean <= 14),
        vote(symbols <= 0.02, symbols >= 0.1),
        vote(copied <= 0.05, copied > 0.2),
        vote(lines > 1 and not dup, dup > 0.3 * lines),
        vote(4 * upper <= upper + lower, 2 * upper > upper + lower and upper > 20),
        vote(closed >= 0.6 * lines, closed < 0.1 * lines and n >= 30),
        vote(stops >= 0.05, n >= 50 and stops < 0.01),
        vote(n < 100 or variety >= 0.3, n >= 100 and variety < 0.1),
    )
    return n, word_chars, n_symbols, dup, repeats, "".join(votes)


def fit(counts: list[tuple[str, int]], rounds: int = 50) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns. Returns log prior odds and, per rule and vote (-, 0, +), log likelihood ratios of good to bad.

    Both classes start from the majority of votes; with no patterns all weights are 0.
    """
    if not counts:
        return 0.0, np.zeros((len(RULES), 3))
    patterns = np.array([["-0+".index(v) for v in p] for p, _ in counts])
    weight = np.array([c for _, c in counts], float)
    good = 1 / (1 + np.exp(-1.5 * ((patterns == 2).sum(1) - 2.0 * (patterns == 0).sum(1) - 1)))
    one_hot = np.eye(3)[patterns]
    for _ in range(rounds):
        share = []
        for q in (good, 1 - good):
            w = q * weight
            table = np.einsum("p,prv->rv", w, one_hot) + 1.0
            share.append((np.log(table / table.sum(1, keepdims=True)), np.log(w.sum() + 1.0)))
        ratio, prior = share[0][0] - share[1][0], share[0][1] - share[1][1]
        # a vote may not speak against its own meaning
        ratio[:, 0], ratio[:, 2] = np.minimum(ratio[:, 0], 0), np.maximum(ratio[:, 2], 0)
        odds = prior + np.einsum("prv,rv->p", one_hot, ratio)
        good = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return float(prior), ratio


def quality_rules(docs: DataFrame, text: str = "text", threshold: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, votes, base_failed, posterior and kept.

    One pass over the texts computes figures and votes and stores them; the vote patterns (3 to the power of the number
    of rules at most, whatever the input) are counted by Spark and only these counts reach the driver.
    """
    outputs = pa.schema([*BASE, *VOTES])
    new = [*outputs.names, "base_failed", "posterior", "kept"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in new]
    judged = stored(map_rows(docs, carry, text, lambda: judge, outputs, ", ".join([*(f"{c} bigint" for c in BASE.names), "votes string"])))
    counts = [(r["votes"], r["n"]) for r in judged.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    prior, ratio = fit(counts)
    odds = F.lit(prior)
    for i, rule in enumerate(ratio):
        v = F.substring("votes", i + 1, 1)
        odds = odds + F.when(v == "-", float(rule[0])).when(v == "+", float(rule[2])).otherwise(float(rule[1]))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.withColumns({"base_failed": failed, "posterior": 1 / (1 + F.exp(-odds))}).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
