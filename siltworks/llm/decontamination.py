"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is 13 consecutive words of a benchmark item (a shorter item is one window). Windows of one length form one
matcher: a table gives for each block of words how far the search may jump, buckets keyed by the windows' suffix blocks
select the windows to test, and direct comparison confirms each occurrence.

The benchmark is searched for in blocks of bounded size (``block_bytes``), each against all documents; only one block is
broadcast at a time, so a benchmark of any size is searched for whole.

Defined cases: null and empty texts have no words; very long texts are searched whole; repeated items each count by their own
item_id; all items with a null item_id are one item, which counts in n_items and has no name in items_sha256; repeated rows are
judged alike; empty tables give empty or clean results; columns named like an output column are replaced, others may have any name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import map_rows, once_per_worker, packed, per_row, quoted, scratch, stored

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and other than ASCII characters, as UTF-8."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class WuManber:
    """Finds windows of exactly ``length`` words, given as tuples of word numbers over 0; block: words in a block."""

    def __init__(self, windows: list[tuple[int, ...]], length: int, base: int):
        self.length, self.block, self.base = length, min(2, length), base
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for window in windows:
            for end in range(self.block, length + 1):
                key = self.key(window, end)
                self.shift[key] = min(self.shift.get(key, length), length - end)
            self.buckets[self.key(window, length)].append(window)

    def key(self, ids, end: int) -> int:
        return ids[end - 1] if self.block == 1 else ids[end - 2] * self.base + ids[end - 1]

    def search(self, ids: list[int]):
        """(start, window) of every occurrence."""
        length, shift, jump, n = self.length, self.shift, self.length - self.block + 1, len(ids)
        end, pair, base = length, self.block == 2, self.base
        while end <= n:
            key = ids[end - 2] * base + ids[end - 1] if pair else ids[end - 1]
            move = shift.get(key, jump)
            if move:
                end += move
                continue
            start = end - length
            found = tuple(ids[start:end])
            for window in self.buckets[key]:
                if window == found:
                    yield start, window
            end += 1


class Matcher:
    """All windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = 13):
        self.vocabulary: dict[bytes, int] = {}
        self.owners: dict[tuple[int, ...], set[str | None]] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                self.owners[tuple(ids[at : at + window])].add(item)
        lengths = defaultdict(list)
        for w in self.owners:
            lengths[len(w)].append(w)
        self.machines = [WuManber(ws, n, len(self.vocabulary) + 1) for n, ws in sorted(lengths.items())]

    def __call__(self, text: str | None) -> tuple[int, list[int], list[str | None]]:
        """Number of words, the hit words' places, the items."""
        words = words_of(text)
        number = self.vocabulary.get
        ids = [number(w, 0) for w in words]
        hit, items = set(), set()
        for machine in self.machines:
            for start, window in machine.search(ids):
                hit.update(range(start, start + machine.length))
                items |= self.owners[window]
        return len(words), sorted(hit), sorted(items, key=lambda i: (i is None, i or ""))


def digest(n_words: int, hit: int, items: list[str | None]) -> tuple:
    return n_words, hit, len(items), hashlib.sha256(",".join(i for i in items if i is not None).encode()).hexdigest(), hit > 0 and 20 * hit >= n_words


NEW = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
DDL = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 13, block_bytes: int = 16 << 20, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with n_words, n_hit, n_items, items_sha256 and contaminated.

    With one block it is a map without a shuffle. With more, each block's hits are unioned and merged per row, by a row number
    that is stored first so that repeated rows stay apart.
    """
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c not in NEW.names]
    source = docs.select(*quoted(carry), *quoted([] if text in carry else [text]))
    benchmark = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = benchmark.agg(F.sum(F.octet_length("text") + F.lit(32))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    # repeated items count once, and those of one id, or of none, are dealt by their texts
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))

    def block(k: int):
        rows = [tuple(r) for r in benchmark.where(part == k).collect()]
        return hashlib.sha256(repr(sorted(rows, key=repr)).encode("utf-8", "surrogatepass")).hexdigest(), spark.sparkContext.broadcast(rows)

    def machine(name, items):
        return once_per_worker((name, window), lambda: Matcher(items.value, window))

    if n_blocks == 1:
        name, items = block(0)

        def make():
            match = machine(name, items)
            return lambda t: digest((r := match(t))[0], len(r[1]), r[2])

        return map_rows(docs, carry, text, make, NEW, DDL)

    rows, _ = packed(source)
    with scratch(spark) as kept:
        numbered = stored(rows.withColumn("_number", F.monotonically_increasing_id()))
        found = None
        for k in range(n_blocks):
            name, items = block(k)

            def hits(batches, name=name, items=items):
                match = machine(name, items)
                schema = pa.schema([("n", pa.int64()), ("hit", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
                return per_row(match, ["text"], schema, ["_number"])(batches)

            # each block's hits are written before the next block is read
            one = stored(numbered.select("_number", F.col(f"_row.`{text}`").alias("text")).mapInArrow(hits, "_number bigint, n bigint, hit array<int>, items array<string>"))
            items.destroy()
            found = one if found is None else found.unionByName(one)
        return kept(merged_hits(numbered, found, carry))


def merged_hits(numbered: DataFrame, found: DataFrame, carry: list[str]) -> DataFrame:
    """The rows with the hits of all blocks."""
    merged = found.groupBy("_number").agg(F.max("n").alias("n_words"), F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("bigint").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return numbered.join(merged, "_number").select(
        *(F.col(f"_row.`{c}`") for c in carry), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
