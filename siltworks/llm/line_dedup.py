"""Line dedup: a suffix array over sequences of line numbers, built by distributed prefix doubling. Only DataFrame expressions.

A line's number is its place in the order of all lines that occur more than once; a line that occurs once ends a sequence,
as nothing repeated can run across it. Each doubling step sorts the pairs (rank of the suffix, order so far of the suffix ``depth``
lines on) of the suffixes whose ranks are shared, and appends the new rank to the suffix's path. It goes on until every rank is
unique or its sequence has ended; then the paths, and after them document and line, put all suffixes in order.

Neighbours in that order have a longest common prefix: two paths that agree on c ranks share 2 ** (c - 1) lines, and what
lies behind is compared in the same way, by the paths of the suffixes there. Maximal intervals of neighbours that share
``min_lines`` lines are repeated runs. In each interval the suffix of the smallest (key, hash of the text, line) stays, the others
are later copies; the lines they cover are deleted as maximal runs. The earliest copy of a line's text is never deleted.

With ``min_words`` a run counts by its size too: a later copy of a single line of so many words (or of ten times so many code
points, for scripts without spaces) goes also where no neighbour repeats with it. Shorter lines and blank ones, which repeat as
headings, list items or brackets do, go only with their neighbours.

Whole copies of a text of ``min_lines`` lines are settled by two hashes before: the first goes into the order, all others go whole.

Hot lines: counts and first copies are pre-aggregated before each shuffle; in the joins back the few heavy ranks are broadcast, so
the lines of a hot rank stay where they are. The order of ranks is a prefix sum over range partitions, never one task.

Defined cases: a null or empty text has no lines that repeat; rows equal in key and text are one document (each row
gets its result); a null key comes before all others; blank lines are lines like others; a text of very many lines is read
whole, its lines are sorted in one task; an empty table gives no rows; columns named n_lines, n_removed or n_runs are replaced,
others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import forget, heavy_join, scratch, stored

DOC = ["_key", "_hash"]
RUNS = "array<struct<start:int,end:int>>"


def ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct keys with a count n: adds rank, the number of counted items with a smaller key.

    Keys are range-partitioned and stored with their partition's number; the offsets are one row per partition.
    """
    parts = stored(keys.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.sum("n").alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    ranks = parts.withColumn("_before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return ranks.join(F.broadcast(offsets), "_part").select(*by, "n", (F.col("_before") + F.col("_offset")).alias("rank"))


def identity(key: str, text: str) -> list[Column]:
    return [F.col(key).alias("_key"), F.xxhash64(text).alias("_hash")]


def documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct documents: key, two hashes of the text, its number of lines."""
    n = (F.regexp_count(F.col(text), F.lit("\n")) + 1).alias("n_lines")
    return docs.where(F.col(text).isNotNull()).select(*identity(key, text), F.xxhash64(F.lit(1), F.col(text)).alias("_more"), n).dropDuplicates(DOC)


def whole_copies(found: DataFrame, min_lines: int) -> DataFrame:
    """Later copies of whole texts of min_lines lines: document and n_lines; found: documents()."""
    first = found.where(F.col("n_lines") >= min_lines).groupBy("_hash", "_more").agg(F.min(F.struct("_key")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return heavy_join(found, first, ["_hash", "_more"], "n").where(~F.col("_key").eqNullSafe(F.col("first._key"))).select(*DOC, "n_lines")


def repeated_lines(docs: DataFrame, key: str, text: str, min_words: int | None = None, without: DataFrame | None = None) -> DataFrame:
    """Lines (document and pos) that occur more than once, with their number as rank and the number of lines left in their sequence; with ``min_words`` also whether each is long enough to go alone."""
    flag = [] if min_words is None else ["long"]
    long = lambda line: (F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) >= min_words) | (F.length(F.trim(line)) >= 10 * min_words)
    hashes = F.transform(F.split(text, "\n"), lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"), *(long(line).alias(f) for f in flag)))
    split = docs.where(F.col(text).isNotNull()).select(*identity(key, text), hashes.alias("lines")).dropDuplicates(DOC)
    if without is not None:
        gone = without.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"))
        split = split.join(gone, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")), "left_anti")
    split = stored(split)
    lines = split.select(*DOC, F.posexplode("lines").alias("pos", "line")).select(*DOC, "pos", *(f"line.{c}" for c in ("a", "b", *flag)))
    numbers = stored(ranked(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1"), ["a", "b"]))
    found = heavy_join(lines, numbers, ["a", "b"], "n").select(*DOC, "pos", "rank", *flag)
    sequence = F.col("pos") - F.row_number().over(Window.partitionBy(*DOC).orderBy("pos"))
    last = F.max("pos").over(Window.partitionBy(*DOC, "_sequence"))
    done = stored(found.withColumn("_sequence", sequence).withColumn("left", last - F.col("pos") + 1).drop("_sequence"))
    forget(split)
    return done


def suffix_paths(lines: DataFrame) -> DataFrame:
    """Suffixes with path: their ranks in the order of the first 1, 2, 4, ... lines, as long as a rank is shared and the sequence goes on."""
    suffixes, depth = lines.select(*DOC, "pos", "left", F.array("rank").alias("path"), F.lit(True).alias("shared")), 1
    while True:
        further = F.max("path").over(Window.partitionBy(*DOC).orderBy("pos").rangeBetween(depth, depth))
        # nothing sorts before what follows
        following = F.when(F.col("left") > depth, further).otherwise(F.expr("cast(array() as array<bigint>)"))
        rows = stored(suffixes.withColumn("own", F.element_at("path", -1)).withColumn("next", following))
        order = ranked(rows.where("shared").groupBy("own", "next").agg(F.count("*").alias("n")), ["own", "next"])
        again = F.col("n") > 1
        total, more = order.agg(F.sum("n"), F.count_if(again & (F.size("next") > 0))).first()
        sorted_further = heavy_join(rows.where("shared"), order, ["own", "next"], "n", total or 0).select(*DOC, "pos", "left", F.concat("path", F.array("rank")).alias("path"), (again & (F.col("left") > depth)).alias("shared"))
        after = stored(rows.where("not shared").select(*DOC, "pos", "left", "path", "shared").unionByName(sorted_further))
        forget(rows)
        if depth > 1:
            forget(suffixes)
        suffixes, depth = after, 2 * depth
        if not more:
            return suffixes


def agreeing(x: str, y: str) -> Column:
    """How many ranks two paths have in common. Ranks that differ stay apart in all that follows."""
    return F.coalesce(F.size(F.filter(F.zip_with(x, y, lambda a, b: a.eqNullSafe(b)), lambda same: same)), F.lit(0))


def common_prefixes(suffixes: DataFrame, enough: int | None = None) -> DataFrame:
    """Suffixes in order (_part, _at) with the longest common prefix, in lines, with the one before.

    ``enough``: prefixes that are known to reach so many lines are not measured further.
    """
    by = ["path", *DOC, "pos"]
    parts = stored(suffixes.select(*by, "left").repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    whole = F.struct(*by, "left")
    # one row for each partition
    lasts = parts.groupBy("_part").agg(F.max(whole).alias("_last")).select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_last"))
    order = Window.partitionBy("_part").orderBy(*by)
    pairs = parts.withColumns({"_at": F.row_number().over(order), "_before": F.lag(whole).over(order)}).join(F.broadcast(lasts), "_part")
    pairs = pairs.withColumn("_before", F.coalesce("_before", "_last")).withColumn("_both", F.least("left", "_before.left"))
    shared = lambda agree: F.when(F.col(agree) == 0, 0).otherwise(F.pow(2.0, F.col(agree) - 1).cast("int"))
    pairs = pairs.withColumn("_agree", agreeing("path", "_before.path"))
    pairs = pairs.select("_part", "_at", *DOC, "pos", F.struct(*(F.col(f"_before.{c}").alias(c) for c in (*DOC, "pos"))).alias("_before"), "_both", "_agree", F.coalesce(F.least(shared("_agree"), "_both"), F.lit(0)).alias("common"))
    undecided = (F.col("_agree") > 1) & (F.col("common") < F.col("_both")) & (F.lit(True) if enough is None else F.col("common") < enough)
    done = None
    while True:
        pairs = stored(pairs)
        ready = pairs.where(~undecided).select("_part", "_at", *DOC, "pos", "common")
        done = ready if done is None else done.unionByName(ready)
        pairs = pairs.where(undecided)
        if pairs.isEmpty():
            return done
        for side, doc, pos in (("_x", "", "pos"), ("_y", "_before.", "_before.pos")):
            there = suffixes.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), F.col("pos").alias("_p"), F.col("path").alias(side))
            at = F.col(f"{doc}_key").eqNullSafe(F.col("_k")) & (F.col(f"{doc}_hash") == F.col("_h")) & (F.col(pos) + F.col("common") == F.col("_p"))
            pairs = pairs.join(there, at, "left").drop("_k", "_h", "_p")
        pairs = pairs.withColumn("_agree", agreeing("_x", "_y")).withColumn("common", F.least(F.col("common") + shared("_agree"), F.col("_both"))).drop("_x", "_y")


def suffix_intervals(neighbours: DataFrame, n_lines: int) -> DataFrame:
    """Suffixes with the number of their maximal interval of neighbours that share n_lines lines; neighbours: common_prefixes(), stored."""
    opens = (F.col("common") < n_lines).cast("long")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    offsets = neighbours.groupBy("_part").agg(F.sum(opens).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = F.sum(opens).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return neighbours.withColumn("_within", within).join(F.broadcast(offsets), "_part").select(*DOC, "pos", (F.col("_within") + F.col("_offset")).alias("interval"))


def copies(suffixes: DataFrame, by: str, n_lines: int) -> DataFrame:
    """Where the later suffixes of each group start, and where their first ``n_lines`` lines end."""
    place = F.struct(*DOC, "pos")
    groups = stored(suffixes.groupBy(by).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"))
    return heavy_join(suffixes, groups, [by], "n").where(~place.eqNullSafe(F.col("first"))).select(*DOC, "pos", (F.col("pos") + n_lines).alias("end"))


def later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """The maximal repeated runs to delete: document (_key, _hash) and an array of (start, end), end exclusive, in order."""
    with scratch(docs.sparkSession) as kept:
        whole = stored(whole_copies(stored(documents(docs, key, text)), min_lines))
        lines = repeated_lines(docs, key, text, min_words, whole)
        neighbours = stored(common_prefixes(suffix_paths(lines), min_lines))
        spans = copies(stored(suffix_intervals(neighbours, min_lines)), "interval", min_lines)
        if min_words is not None:
            spans = spans.unionByName(copies(lines.where("long").select(*DOC, "pos", "rank"), "rank", 1))
        ordered = Window.partitionBy(*DOC).orderBy("pos")
        opens = F.coalesce(F.col("pos") > F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
        # lines that start at the same place are peers, so they get the same sum
        runs = spans.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(ordered)).groupBy(*DOC, "run").agg(F.min("pos").alias("start"), F.max("end").alias("end"))
        runs = runs.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
        return kept(runs.unionByName(whole.select(*DOC, F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").alias("end"))).alias("runs"))))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """docs with the later copies deleted from text, and n_lines, n_removed and n_runs (long)."""
    runs = later_copies(docs, key, text, min_lines, min_words).withColumnsRenamed({"_key": "_k", "_hash": "_h"})
    carried = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in carried), F.lit(0).alias("_none")).alias("row"), *identity(key, text), F.col(text).alias("_text"))
    joined = rows.join(runs.hint("shuffle_hash"), F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")), "left").select("row", "_text", F.coalesce("runs", F.expr(f"cast(array() as {RUNS})")).alias("runs"))
    parts = joined.withColumn("_lines", F.when(F.size("runs") > 0, F.split("_text", "\n")))
    # what stays is what lies before the first run and after each run
    after = F.concat(F.array(F.lit(0)), F.col("runs.end"))
    until = F.concat(F.col("runs.start"), F.array(F.size("_lines")))
    kept = F.flatten(F.zip_with(after, until, lambda a, b: F.slice(F.col("_lines"), a + 1, b - a)))
    out = F.when(F.size("runs") > 0, F.array_join(kept, "\n")).otherwise(F.col("_text"))
    counts = {
        "n_lines": F.when(F.col("_text").isNull(), 0).otherwise(F.regexp_count("_text", F.lit("\n")) + 1).cast("bigint"),
        "n_removed": F.aggregate("runs", F.lit(0).cast("bigint"), lambda total, r: total + r["end"] - r["start"]),
        "n_runs": F.size("runs").cast("bigint"),
    }
    columns = [out.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns if c not in counts]
    return parts.select(*columns, *(v.alias(c) for c, v in counts.items()))
