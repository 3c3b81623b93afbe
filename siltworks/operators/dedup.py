"""Duplicates: the first row of each key by partial aggregation, and marks on the others by a join that no hot key slows down. Equal NULLs are equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import columns as fn
from siltworks.functions.fixed import META_COLUMNS
from siltworks.operators.schema import quoted

#: A key with so many rows is heavy; the most frequent of these, so many at most, are broadcast (three numbers each).
HEAVY, MAX_HEAVY = 200, 1 << 14
#: Repeated keys are noted as bits, which are broadcast: so many words of 64 bits at most, whatever the number of keys.
WORDS = 1 << 19


def _keys(df: DataFrame, keys: list[str] | None) -> list[str]:
    return [k for k in keys or [] if k in df.columns] or [c for c in df.columns if c not in META_COLUMNS and not c.startswith("_")]


def marked(df: DataFrame, keys: list[Column], order: list[str | Column], into: str, only: Column | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """df with a boolean: whether a row with the same keys comes before it in the order, among the rows that ``only`` holds for (false elsewhere).

    Keys are grouped as two 64-bit hashes. One is counted alone first: each repeated one sets a bit, and rows whose bit isn't set are no copies and
    stay where they are. The firsts of the other rows' repeated keys are found in each task before the shuffle and joined back: those of heavy keys
    are broadcast, so that their rows need not meet in one task; keys beyond that bound hold at most 1 / MAX_HEAVY of all rows each. Rows that the
    order doesn't tell apart are ordered by their place; df is read several times for that, so it has to be stored or read from files then.

    keep: stores the bits and the firsts, which are used more than once; Spark shuffles them once by itself only if df is read from files.
    """
    keep = keep or (lambda df: df)
    there = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    parts = [x for k in keys for x in (k.isNull(), k)]
    rows = df.withColumns({"_k1": F.xxhash64(F.lit(1), *parts), "_k2": F.xxhash64(F.lit(2), *parts), "_place": F.monotonically_increasing_id(), "_there": there})
    repeated = rows.where("_there").groupBy("_k1").agg(F.count("*").alias("_n")).where("_n > 1")
    word, bit = F.expr(f"shiftright(_k1, 6) & {WORDS - 1}L"), "cast(_k1 & 63L AS int)"
    bits = keep(repeated.groupBy(word.alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("_bits")))
    rows = rows.withColumn("_word", word).join(F.broadcast(bits), "_word", "left").withColumn("_maybe", F.col("_there") & F.coalesce(F.expr(f"bit_get(_bits, {bit}) = 1"), F.lit(False)))
    alone = rows.where("not _maybe").select(*map(quoted, df.columns), F.lit(False).alias(into))
    rows = rows.where("_maybe").drop("_word", "_bits", "_maybe", "_there")
    at = F.struct(*(F.struct(c).alias(f"o{i}") for i, c in enumerate(order)), "_place")
    firsts = keep(rows.groupBy("_k1", "_k2").agg(F.min(at).alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("_k1", "_k2", F.col("_first._place").alias("_first"), "_n"))
    heavy = firsts.where(F.col("_n") >= HEAVY).orderBy(F.desc("_n"), "_k1", "_k2").limit(MAX_HEAVY).select("_k1", "_k2", F.col("_first").alias("_heavy"))
    light = firsts.select(F.col("_k1").alias("_dealt"), "_k2", F.col("_first").alias("_light"))
    # rows of heavy keys are dealt by their place: what they might match in the second join doesn't count
    known = rows.join(F.broadcast(heavy), ["_k1", "_k2"], "left")
    known = known.withColumn("_dealt", F.when(F.col("_heavy").isNotNull(), F.xxhash64("_place")).otherwise(F.col("_k1")))
    found = known.join(light, ["_dealt", "_k2"], "left")
    later = F.coalesce(F.col("_place") != F.coalesce("_heavy", "_light"), F.lit(False))
    return alone.union(found.select(*map(quoted, df.columns), later.alias(into)))


def without_copies(df: DataFrame, keys: list[str] | None = None, order: list | None = None) -> DataFrame:
    """The first row of each key. Firsts are found in each task before the shuffle, so a key with very many rows is no hot group."""
    keys = _keys(df, keys)
    row = F.struct(*map(quoted, df.columns))
    first = df.groupBy(*(quoted(k).alias(f"_key{i}") for i, k in enumerate(keys))).agg(F.min_by(row, F.struct(*(order or map(quoted, keys)))).alias("_first"))
    return first.select("_first.*")


def with_copies(df: DataFrame, keys: list[str] | None = None, order: list | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """df with _is_copy: false for the first row of each key (all data columns by default). keep: as in marked()."""
    keys = _keys(df, keys)
    return marked(df, [*map(quoted, keys)], order or [], "_is_copy", keep=keep)


def copies(df: DataFrame, keys: list[str] | None = None, order: list | None = None) -> DataFrame:
    """The rows that without_copies drops, with a _reason."""
    return with_copies(df, keys, order).where("_is_copy").drop("_is_copy").withColumn("_reason", F.lit("duplicate"))


def with_repeats(df: DataFrame, reference: Column, order: list, into: str) -> DataFrame:
    """df with a boolean: true from the second row on with the same trimmed reference. Rows without one are never repeats."""
    value = fn.trimmed(reference)
    return marked(df, [value], order, into, value.isNotNull())
