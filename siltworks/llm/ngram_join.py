"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with its transpose.

Documents with equal sets of shingles are one row of the matrix (a class). Columns are ordered: shingles that are frequent
in the corpus last, else by hash. Two sets of the wanted similarity share a column among the first ``n - ceil(n * similarity) + 1``
of each, so the product is taken over these columns: each column is a block whose pairs are multiplied out, sums of pairs are
accumulated by Spark, and a pair is discarded if its sizes are too far apart or if its sum plus all that can follow stays below the
overlap that its sizes ask for. What is left is counted exactly on the whole sets.

Frequent columns (large groups of near copies, passages that many documents share) are not multiplied out. Most are known before,
from repeats within chunks of shingles; a column that turns out to have THIN rows is treated alike, so no column with more is
multiplied out. The rows of a column that no chunk repeats are as many as there are chunks at most, which bounds what one task gets. Their members
are compared with the column's first member; then, of columns that still hold several components, the members are cut into
blocks of rows, families of them together, and blocks that share such a column are multiplied as matrices in a task, which gives
out only which components are joined. Blocks are sent to tasks by groups of them, each once for all its products there, so what is
sent doesn't grow as the number of products. So no link between different components is lost, and copies are never expanded into all pairs.

Defined cases: a document with fewer words than ``size`` has its whole sequence as one shingle; without words, or null, it
has none, links with nothing and is its own component; rows with the same text or key are separate rows of the result;
null keys are allowed and count in no component_id but their own (null); very long texts are read whole; an empty table gives no
rows; columns named n_shingles, component_id or first are replaced, others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.llm.common import as_json, collect_garbage, forget, heavy_join, packed, quoted, scratch, stored
from siltworks.llm.components import components
from siltworks.llm.line_dedup import ranked

#: Shingles whose repeats are counted together by a task; bounds its memory.
CHUNK = 2_000_000
#: A shingle with so many occurrences is frequent. Which ones are has no influence on the result, only on the work.
FREQUENT = 8
#: A column that turns out to have so many rows is not multiplied out either, though no chunk told that it is frequent.
THIN = 64
#: Most frequent shingles that are kept as such, and broadcast: 8 bytes each; as many heads of columns are broadcast, 24 bytes each.
MAX_FREQUENT = 1 << 20
#: A block of the product has so many rows and shingles at most (or one longer row), and so many columns at a time are multiplied.
BLOCK_ROWS, BLOCK_SHINGLES, BLOCK_COLUMNS = 256, 1 << 17, 4096
#: So many groups of blocks are wanted at most; a group has so many blocks at most, which bounds what a task gets: two groups (or longer rows).
BLOCK_GROUPS, GROUP_BLOCKS = 12, 16
#: The documents whose whole sets are asked for are noted as bits, which are broadcast: so many words of 64 bits at most.
WORDS = 1 << 19


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes (64 bits, signed) of the text's shingles."""
    from xxhash import xxh3_64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.int64)
    w = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[j : len(w) - n + 1 + j])
    return np.unique(h.view(np.int64))


def lists(arrays: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield batch.slice(at, 1000)


def frequent_shingles(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """The most frequent shingles: those that repeat within the chunks of shingles of a task, summed over all chunks."""

    def repeats(batches):
        held, n = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(values[many]), pa.array(counts[many])], names=["s", "n"])

        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                held.append(shingles(t, size))
                n += len(held[-1])
                if n >= CHUNK:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    sums = docs.select(text).mapInArrow(repeats, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    return np.sort(sums.orderBy(F.desc("n"), "s").limit(MAX_FREQUENT).select("s").toArrow().column(0).to_numpy())


def prefixes(frequent, size: int, percent: int) -> Callable:
    """A mapInArrow function: key, text -> key, n, two hashes of the set, the first columns that aren't frequent, those that are."""

    def run(batches):
        often = frequent.value
        for batch in slices(batches):
            n, h1, h2, first, hot = [], [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t, size)
                n.append(len(s))
                digest = np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64) if len(s) else (None, None)
                h1.append(digest[0])
                h2.append(digest[1])
                many = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s if len(often) else np.zeros(len(s), bool)
                p = len(s) - (percent * len(s) + 99) // 100 + (len(s) > 0)
                first.append(s[~many][:p])
                hot.append(s[many][: p - len(first[-1])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), lists(first), lists(hot)], names=["key", "n", "h1", "h2", "first", "hot"])

    return run


def column_pairs(percent: int) -> Callable:
    """A mapInArrow function over rows (s, c, n, i) sorted by s: the pairs (a, b) of each column with fewer than THIN rows whose
    sizes fit, a < b; of a column with more its rows (s, c, n, i), so that no column is multiplied out whose size isn't bounded."""

    def pairs(s, c, n):
        for d in range(1, THIN):
            # the d-th neighbour within the same column
            left = np.flatnonzero(s[:-d] == s[d:])
            if not len(left):
                break
            x, y, nx, ny = c[left], c[left + d], n[left], n[left + d]
            fit = (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & (x != y)
            yield np.minimum(x, y)[fit], np.maximum(x, y)[fit]

    def batch(pairs=None, rows=None):
        none = lambda k: pa.nulls(k, pa.int64())
        k = len(pairs[0] if pairs else rows[0])
        found = [*(map(pa.array, pairs) if pairs else (none(k), none(k))), *(map(pa.array, rows) if rows else [none(k)] * 4)]
        return pa.RecordBatch.from_arrays(found, names=["a", "b", "s", "c", "n", "i"])

    def run(batches):
        rest, hot = [np.empty(0, np.int64)] * 4, None
        for b in and_end(batches):
            now = rest if b is None else [np.concatenate(x) for x in zip(rest, (b.column(k).to_numpy() for k in range(4)), strict=True)]
            if not len(now[0]):
                continue
            s = now[0]
            starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            lengths = np.diff(np.append(starts, len(s)))
            many = np.repeat((lengths >= THIN) | (s[starts] == hot if hot is not None else False), lengths)
            # the last column may go on in the next batch; of one that is frequent already nothing has to be kept
            cut = len(s) if b is None or many[-1] else int(starts[-1])
            hot = int(s[-1]) if many[-1] else None
            done = [x[:cut] for x in now]
            if (rows := [x[many[:cut]] for x in done]) and len(rows[0]):
                yield batch(rows=rows)
            few = ~many[:cut]
            for found in pairs(*(x[few] for x in done[:3])):
                if len(found[0]):
                    yield batch(pairs=found)
            rest = [x[cut:] for x in now]

    return run


def and_end(batches):
    """The batches, then None."""
    yield from batches
    yield None


def overlap(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are links, counted on the whole sets (c, s)."""

    def count(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            good = []
            for i in range(batch.num_rows):
                u, v = x[i].values.to_numpy(), y[i].values.to_numpy()
                both = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
                good.append(100 * both >= percent * (len(u) + len(v) - both))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = pairs.select("a", "b").join(sets.select(F.col("c").alias("a"), F.col("s").alias("x")), "a")
    return left.join(sets.select(F.col("c").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(count, "a bigint, b bigint")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components so far; labels: node and component of the nodes with links."""
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")), end, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).drop("_a", "_b")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """One row (key, n_shingles, component_id) for each row of docs; component_id: the smallest key reachable by links. Keys are of any type with an order."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    with scratch(spark) as kept:
        return kept(labelled_rows(source, size, percent))


def labelled_rows(source: DataFrame, size: int, percent: int) -> DataFrame:
    spark = source.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_shingles(source, "text", size))
    fields = StructType.fromDDL("n bigint, h1 bigint, h2 bigint, first array<bigint>, hot array<bigint>").fields
    rows = stored(source.mapInArrow(prefixes(frequent, size, percent), StructType([source.schema["key"], *fields])))
    members = stored(rows.select("key", "n", "h1", "h2"))
    grouped = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("rep"), *(F.first(c).alias(c) for c in ("n", "first", "hot")), F.count("*").alias("members"))
    classes = stored(grouped.withColumn("c", F.monotonically_increasing_id()))
    forget(rows)
    collect_garbage(spark)

    sizes = classes.select("c", "n", F.size("hot").cast("bigint").alias("n_hot"))
    p = lambda n: F.col(n) - F.floor((percent * F.col(n) + 99) / 100) + 1
    incidence = classes.select("c", "n", F.posexplode("first").alias("i", "s")).select("s", "c", "n", F.col("i").cast("bigint").alias("i"))
    # a shingle of fewer occurrences than chunks of a task's shingles need not be known as frequent: then its column is, in this order
    product = stored(incidence.repartition("s").sortWithinPartitions("s").mapInArrow(column_pairs(percent), "a bigint, b bigint, s bigint, c bigint, n bigint, i bigint"))
    thin = product.where("s is not null").select("c", "n", "s", (F.col("i") < reach(percent)).alias("small"))
    product = product.where("s is null").groupBy("a", "b").agg(F.count("*").alias("sum"))
    counted_elsewhere = thin.groupBy("c").agg(F.count("*").cast("bigint").alias("n_thin"))
    sizes = sizes.join(counted_elsewhere, "c", "left").select("c", "n", (F.col("n_hot") + F.coalesce("n_thin", F.lit(0))).alias("n_hot"))
    for end in ("a", "b"):
        product = product.join(sizes.select(F.col("c").alias(end), F.col("n").alias(f"n_{end}"), F.col("n_hot").alias(f"hot_{end}")), end)
    more = F.greatest(F.col("n_a") - p("n_a"), F.col("n_b") - p("n_b")) + F.least("hot_a", "hot_b")
    needed = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    candidates = stored(product.where(F.col("sum") + more >= needed).select("a", "b", "sum"))
    collect_garbage(spark)

    listed = classes.where(F.size("hot") > 0).select("c", "n", F.size("first").alias("cold"), F.explode("hot").alias("s")).select("c", "n", "s", (F.col("cold") < reach(percent)).alias("small"))
    often = listed.unionByName(thin)
    heads = stored(often.groupBy("s").agg(F.min_by(F.struct("c", "n"), "c").alias("head"), F.count("*").alias("rows")).select("s", F.col("head.c").alias("a"), F.col("head.n").alias("n_a"), "rows").where("rows > 1"))
    stars = heavy_join(often, heads, ["s"], "rows", most=MAX_FREQUENT).where((F.col("c") != F.col("a")) & sizes_fit("n", "n_a", percent)).groupBy("a", F.col("c").alias("b")).agg(F.count("*").alias("sum"))
    stars = stored(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sum").groupBy("a", "b").agg(F.max("sum").alias("sum")))

    nodes = candidates.select(F.explode(F.array("a", "b")).alias("c")).unionByName(often.select("c")).distinct()
    sets = stored(whole_sets(source, classes, nodes, size))
    collect_garbage(spark)

    # each node's likeliest partner goes first, so that few pairs are left apart when all that remain are counted
    labels = components(overlap(likeliest(candidates.unionByName(stars)), sets, percent))
    labels = components(joined(labels, overlap(apart(candidates, labels), sets, percent)))
    collect_garbage(spark)
    links = stored(block_links(often, sets, labels, percent))
    if not links.isEmpty():
        labels = components(joined(labels, links))
    collect_garbage(spark)

    named = stored(classes.select("h1", "h2", "rep", "c", "members").join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c")))
    smallest = stored(named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("rows")))
    by_hash = stored(heavy_join(named, smallest, ["component"], "rows").select("h1", "h2", "component_id", "members"))
    some = heavy_join(members.where("n > 0"), by_hash, ["h1", "h2"], "members").select("key", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(members.where("n = 0").select("key", F.col("n").alias("n_shingles"), F.col("key").alias("component_id")))


def reach(percent: int) -> Column:
    """Of two linked sets the smaller one, of n shingles, shares one with the other among so many first ones."""
    return F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components so far, as links of their nodes to the smallest one, and more links."""
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)


def sizes_fit(x: str, y: str, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def likeliest(pairs: DataFrame) -> DataFrame:
    """For each b the pair with the largest sum."""
    return pairs.groupBy("b").agg(F.max_by("a", "sum").alias("a")).select("a", "b")


def block_links(often: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between components (as pairs of their labels) among members of frequent columns that still hold several.

    The members' whole sets are cut into blocks of rows, families of them together; two blocks are multiplied if they share such
    a column and aren't both of one and the same component. Of two linked sets the smaller one shares a column among its
    first ``n - ceil(2 n percent / (100 + percent)) + 1``; a set whose columns there are all infrequent need not be
    multiplied as the smaller one. A task gets the blocks of two groups that meet, each once, and multiplies those that meet.
    """
    labelled = often.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    several = stored(labelled.groupBy("s").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows")).where("lo < hi").select("s", "rows"))
    open_ = stored(heavy_join(labelled, several, ["s"], "rows", most=MAX_FREQUENT).select("s", "c", "n", "component", "small"))
    by = ["family", "alike", "component", "c"]
    ordered = ranked(families(open_), by)
    placed = stored(ordered.select("c", "component", F.floor(F.col("rank") / BLOCK_SHINGLES).alias("block")))
    blocks = stored(placed.join(sets, "c").groupBy("block").agg(F.collect_list(F.struct("component", "s")).alias("rows"), F.min("component").alias("lo"), F.max("component").alias("hi")))
    held = open_.select("s", "c", "small").join(placed.select("c", "block"), "c").groupBy("s", "block").agg(F.max("small").alias("small"))
    held = stored(held.join(blocks.select("block", "lo", "hi"), "block"))
    x, y = (held.select("s", *(F.col(c).alias(f"{c}_{end}") for c in ("block", "small", "lo", "hi"))) for end in "xy")
    apart_ = F.least("lo_x", "lo_y") < F.greatest("hi_x", "hi_y")
    met = stored(x.join(y, "s").where((F.col("block_x") <= F.col("block_y")) & (F.col("small_x") | F.col("small_y")) & apart_).select("block_x", "block_y").distinct())
    return sent_blocks(met, blocks).groupBy("group_x", "group_y").applyInArrow(block_products(percent), "a bigint, b bigint").distinct()


def families(open_: DataFrame) -> DataFrame:
    """For each row of open columns (s, c, n, component): its least column (alike), the least one of all rows that share a column with it (family), its weight n."""
    rows = stored(open_.groupBy("c", "component").agg(F.min("s").alias("alike"), F.greatest(F.max("n"), F.lit(BLOCK_SHINGLES // BLOCK_ROWS)).alias("n")))
    least = stored(open_.select("s", "c").join(rows.select("c", "alike"), "c").groupBy("s").agg(F.min("alike").alias("least"), F.count("*").alias("rows")))
    family = heavy_join(open_.select("s", "c"), least, ["s"], "rows", most=MAX_FREQUENT).groupBy("c").agg(F.min("least").alias("family"))
    return rows.join(family, "c")


def sent_blocks(met: DataFrame, blocks: DataFrame) -> DataFrame:
    """What tasks multiply: for each two groups of blocks that meet (group_x, group_y) their blocks that do, each once, with its rows and those it is multiplied with (others)."""
    last = met.agg(F.max("block_y")).first()[0] or 0
    group = lambda block: F.floor(F.col(block) / min(GROUP_BLOCKS, last // BLOCK_GROUPS + 1))
    pairs = met.select(group("block_x").alias("group_x"), group("block_y").alias("group_y"), "block_x", "block_y")
    ends = pairs.select("group_x", "group_y", F.col("block_x").alias("block"), F.col("block_y").alias("other"))
    ends = ends.unionByName(pairs.select("group_x", "group_y", F.col("block_y").alias("block"), F.lit(None).cast("bigint").alias("other")))
    return ends.groupBy("group_x", "group_y", "block").agg(F.collect_set("other").alias("others")).join(blocks.select("block", "rows"), "block")


def block_products(percent: int) -> Callable:
    """A function for applyInArrow: blocks of rows (component, s) and the blocks each is multiplied with -> the components that links join, each with the smallest one it is joined to."""

    def product(x: tuple, y: tuple) -> tuple[np.ndarray, np.ndarray]:
        both = np.intersect1d(x[3], y[3], assume_unique=True)
        places = []
        for _, n, v, _ in (x, y):
            at = np.minimum(np.searchsorted(both, v), max(len(both) - 1, 0))
            mine = both[at] == v if len(both) else np.zeros(len(v), bool)
            places.append((np.repeat(np.arange(len(n)), n)[mine], at[mine]))
        (cx, nx, *_), (cy, ny, *_) = x, y
        sums = np.zeros((len(cx), len(cy)), np.float64)
        for lo in range(0, len(both), BLOCK_COLUMNS):
            dense = []
            for (row, column), n in zip(places, (nx, ny), strict=True):
                part = (column >= lo) & (column < lo + BLOCK_COLUMNS)
                m = np.zeros((len(n), min(BLOCK_COLUMNS, len(both) - lo)), np.float32)
                m[row[part], column[part] - lo] = 1
                dense.append(m)
            sums += dense[0] @ dense[1].T
        linked = (100 * sums >= percent * (nx[:, None] + ny[None] - sums)) & (cx[:, None] != cy[None])
        i, j = np.nonzero(linked)
        return np.maximum(cx[i], cy[j]), np.minimum(cx[i], cy[j])

    def run(table: pa.Table) -> pa.Table:
        parts, found = {}, [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for block, r in zip(table.column("block").to_pylist(), table.column("rows"), strict=True):
            s = r.values.field("s")
            v = s.flatten().to_numpy()
            parts[block] = r.values.field("component").to_numpy(), s.value_lengths().to_numpy().astype(np.int64), v, np.unique(v)
        for block, others in zip(table.column("block").to_pylist(), table.column("others").to_pylist(), strict=True):
            found += (starred(*product(parts[block], parts[other])) for other in others)
        a, b = starred(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def starred(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of these links that aren't the smallest one of theirs, each with that one."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[u], label[v])
        after = label.copy()
        np.minimum.at(after, u, least)
        np.minimum.at(after, v, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    apart_ = label != np.arange(len(names))
    return names[apart_], names[label[apart_]]


def whole_sets(source: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The whole sets (c, s) of some classes, from the text of each class's first document.

    Texts are not shuffled: the first documents' keys set bits, and only texts whose key's bit is set are read for sets.
    """
    reps = stored(classes.select("c", "rep", "h1", "h2").join(nodes, "c"))

    def sets(batches):
        for batch in slices(batches):
            found = [shingles(t, size) for t in batch.column(0).to_pylist()]
            digests = [np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64) if len(s) else (None, None) for s in found]
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), lists(found)], names=["h1", "h2", "s"])

    # a key may stand for several texts and a bit for several keys, so the sets' hashes decide
    word, bit = lambda key: F.shiftright(F.xxhash64(key), 6).bitwiseAND(F.lit(WORDS - 1)), lambda key: F.xxhash64(key).bitwiseAND(F.lit(63)).cast("int")
    bits = reps.groupBy(word("rep").alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit("rep"))).alias("_bits"))
    chosen = source.withColumn("_word", word("key")).join(F.broadcast(bits), "_word").where(F.call_function("bit_get", "_bits", bit("key")) == 1).select("text")
    one = chosen.mapInArrow(sets, "h1 bigint, h2 bigint, s array<bigint>").where("h1 is not null").groupBy("h1", "h2").agg(F.first("s").alias("s"))
    return one.join(reps.select("h1", "h2", "c"), ["h1", "h2"]).select("c", "s")


def ngram_jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """docs with n_shingles, component_id, and first: whether the row stays if one document of each component does.

    Documents are told apart by key and text; of rows equal in both all are first, or none.
    """
    docs = docs.drop("n_shingles", "component_id", "first")
    identity = lambda key, text: F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"))
    result = jaccard_components(docs.select(identity(key, text).alias("key"), F.col(text).alias("text")), "key", "text", size, percent).dropDuplicates(["key"])
    result = result.select(F.col("key").alias("_key"), "n_shingles", F.col("component_id.key").alias("component_id"), (F.col("key") == F.col("component_id")).alias("first"))
    rows, carried = packed(docs)
    found = rows.withColumn("_own", identity(f"_row.`{key}`", f"_row.`{text}`")).join(result.hint("shuffle_hash"), F.col("_own") == F.col("_key"))
    return found.select(*(F.col(f"_row.`{c}`") for c in carried), "n_shingles", "component_id", "first")


def first_of_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """docs with exactly one row of each component: of rows equal in key and text one stays, also where the key is null.

    Of such rows that one stays whose other columns come first as JSON text, which any type has (maps and variants too). They are
    aggregated in each task before the shuffle that brings rows and labels together, so a key with very many rows sends one row per task.
    """
    identity = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash"))
    labels = jaccard_components(docs.select(identity.alias("key"), F.col(text).alias("text")), "key", "text", size, percent)
    stays = labels.where(F.col("key") == F.col("component_id")).select(F.col("key").alias("_own")).distinct()
    rows = docs.select(identity.alias("_own"), F.struct(*quoted(docs.columns)).alias("_row"), as_json(quoted([c for c in docs.columns if c not in (key, text)])).alias("_json"))
    one = rows.groupBy("_own").agg(F.min_by("_row", "_json").alias("row"))
    return one.join(stays.hint("shuffle_hash"), "_own", "left_semi").select("row.*")
