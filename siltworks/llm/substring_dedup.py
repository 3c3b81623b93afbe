"""Suffix-array dedup: removes bytes that lie in a string of ``length`` bytes which also starts in an earlier document.

Whole copies of a text are settled by their hash. In the distinct texts, sampled strings (the smallest 16-byte hash of each window
of ``length`` bytes, so every window has one, at the same place in all its copies) tell which parts can repeat at all. A window
belongs to its sampled string; the bytes of all windows of one sampled string are its surroundings.

1. Each block of texts tells the bucket of each sampled string its hash and a hash of its surroundings.
2. A bucket answers which sampled strings several texts have. Where all surroundings are equal, these settle it: all
   but the first document's go. Where they differ, one block for each different surroundings has to send their bytes.
3. In a bucket the differing surroundings get a suffix array (order of their windows), neighbours' longest common
   prefixes, and from the previous and next suffix of a smaller document the longest previous factor. Where it reaches
   ``length`` the window has an earlier copy and goes.

A sampled string with very many different surroundings (the edge of a passage that a third of all documents share) is not
brought together with their bytes: its windows are told apart by two 64-bit hashes each, in one row for each block and window, so
a bucket holds as many rows of one window as there are blocks (MAX_BLOCKS) at most.

The texts move once: they are stored as a table bucketed by block, and what the buckets say is brought to them by block.

Defined cases: keys are integers (other types are refused); a null text is empty; texts shorter than ``length`` lose nothing; rows
with the same key never remove from each other; a null key comes before all others; NUL bytes are bytes like others; very long
texts are read whole, in one block with others; an empty table gives no rows; columns named n_bytes, n_removed, n_spans, kept or
kept_sha256 are replaced, others may have any name.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import collect_garbage, forget, heavy_join, shared_dir, stored
from siltworks.llm.ngram_join import mixed

GRAM = 16
#: Bytes of text for each bucket of sampled strings.
BUCKET_BYTES = 4 << 20
#: Bytes of text for each block of texts, and for each file of the texts' table; at most so many of each.
BLOCK_BYTES, FILE_BYTES = 2 << 20, 16 << 20
MAX_BLOCKS, MAX_FILES = 1 << 22, 1 << 16
#: Different surroundings of a sampled string from which on its windows are compared by hash: in a block, in all.
HOT_IN_BLOCK, HOT = 64, 4096
#: Bytes of texts that are looked at together, so that their arrays stay in a core's cache.
LOOK_BYTES = 48 << 10
#: Surroundings that are sorted together.
PIECE = 4_000
FIRST_ID = -(1 << 63)
SEED = np.uint64(0x9E3779B97F4A7C15)


def sliding(h: np.ndarray, width: int, choose) -> np.ndarray:
    """The least or greatest of each window of width values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        h = choose(h[:-step], h[step:])
        done += step
    return h


def hashed(rows: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of rows of bytes."""
    if rows.shape[1] % 8:
        rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))
    words = np.ascontiguousarray(rows).view(np.uint64)
    h = np.full(len(rows), seed + 1, np.uint64)
    for i in range(words.shape[1]):
        h = mixed(h * SEED + words[:, i])
    return h


class Sampled:
    """Sampled strings of some texts: hash g, number of the text, start of the surroundings in it, their bytes (those of no window are 0),
    and their first and last window (low, high: places in the surroundings)."""

    def __init__(self, texts: list[bytes], length: int):
        self.gap, width = length - GRAM, length - GRAM + 1
        gap, size = self.gap, np.array([len(t) for t in texts], np.int64)
        starts = gap + np.concatenate([[0], np.cumsum(size + gap)[:-1]]).astype(np.int64)
        self.data = data = np.frombuffer(b"".join([bytes(gap), *(p for t in texts for p in (t, bytes(gap))), bytes(GRAM)]), np.uint8)
        h = data.astype(np.uint64)
        for bits in (8, 16, 32):
            step = bits // 8
            h = (h[:-step] << np.uint64(bits)) | h[step:]
        # 0 stands for no window
        h = mixed(mixed(h[:-8] + SEED) * SEED + h[8:]) | np.uint64(1)
        # strings across the end of a text are none
        def inside(n: int) -> np.ndarray:
            enough = size >= n
            step = np.zeros(len(data) + 1, np.int8)
            step[starts[enough]] = 1
            step[(starts + size - n + 1)[enough]] = -1
            return np.cumsum(step, dtype=np.int8) > 0

        grams, windows = inside(GRAM)[: len(h)], inside(length)
        h[~grams] = np.uint64(2**64 - 1)
        least = sliding(h, width, np.minimum)
        least[~windows[: len(least)]] = 0
        top = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        top[width - 1 : width - 1 + len(least)] = least
        at = np.flatnonzero((sliding(top, width, np.maximum) == h) & grams)
        v = h[at]
        # the run of windows whose least hash is a place's lies among the windows that contain the place
        edges = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        run = np.searchsorted(edges, np.minimum(at, len(least) - 1), "right") - 1
        while len(wrong := np.flatnonzero(least[edges[run]] != v)):
            run[wrong] -= 1
        last = np.append(edges[1:], len(least)) - 1
        first = at - gap
        self.g, self.text = v, np.searchsorted(starts, at, "right") - 1
        self.low = (np.maximum(edges[run], first) - first).astype(np.int16)
        self.high = (np.minimum(last[run], at) - first).astype(np.int16)
        self.start = (first - starts[self.text]).astype(np.int32)
        self.first, self.length = first, length

    def around(self, which: np.ndarray) -> np.ndarray:
        """The surroundings' bytes, padded to whole words."""
        length = self.length
        rows = np.zeros((len(which), -(-(2 * length - GRAM) // 8) * 8), np.uint8)
        rows[:, : 2 * length - GRAM] = sliding_window_view(self.data, 2 * length - GRAM)[self.first[which]]
        place, ends = np.arange(rows.shape[1]), np.arange(length - GRAM + 1)
        inside = (place >= ends[:, None, None]) & (place < ends[:, None] + length)
        rows &= np.where(inside, np.uint8(255), np.uint8(0))[self.low[which], self.high[which]]
        return rows

    def fingerprints(self, which: np.ndarray) -> np.ndarray:
        """Hashes of the surroundings' bytes, low and high."""
        found = [np.empty(0, np.uint64)]
        for k in range(0, len(which), 50_000):
            part = which[k : k + 50_000]
            ends = (self.low[part].astype(np.uint64) << np.uint64(16)) | self.high[part].astype(np.uint64)
            found.append(mixed(hashed(self.around(part)) * SEED + ends))
        return np.concatenate(found)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each window of some surroundings: whose it is, its place in them, two hashes."""
        n = (self.high[which] - self.low[which] + 1).astype(np.int64)
        whose = np.repeat(which, n)
        place = np.arange(len(whose)) - np.repeat(np.cumsum(n) - n, n) + self.low[whose]
        rows = sliding_window_view(self.data, self.length)[self.first[whose] + place]
        return whose, place, hashed(rows, 1), hashed(rows, 2)


def within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values stand in a sorted array."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def cuts(sorted_values: np.ndarray) -> list[np.ndarray]:
    """Index ranges of equal values."""
    return [p for p in np.split(np.arange(len(sorted_values)), np.flatnonzero(np.diff(sorted_values)) + 1) if len(p)]


def utf8(texts: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts.to_pylist()]


def looks(texts: list[bytes]):
    """(first, last) of texts that are looked at together."""
    first, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t) + GRAM
        if n >= LOOK_BYTES or i == len(texts) - 1:
            yield first, i + 1
            first, n = i + 1, 0


TOLD = ["bucket", "block", "g", "fp", "mark"]


def told_rows(length: int, n_buckets: int):
    """A mapInArrow function: block, text -> for each bucket g, fp and a mark of the block's sampled strings (1: more than once, 2: hot)."""

    def run(batches):
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for part in cuts(blocks):
                texts, found = utf8(batch.column(1).slice(part[0], len(part))), []
                for a, b in looks(texts):
                    s = Sampled(texts[a:b], length)
                    found.append((s.g, s.fingerprints(np.arange(len(s.g)))))
                g, fp = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((fp, g))
                g, fp = g[order], fp[order]
                new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (fp[1:] != fp[:-1])])) if len(g) else np.empty(0, np.int64)
                mark = (np.diff(np.append(new, len(g))) > 1).astype(np.uint8)
                g, fp = g[new], fp[new]
                _, at, n = np.unique(g, return_index=True, return_counts=True)
                hot = np.repeat(n > HOT_IN_BLOCK, n)
                stay = ~hot
                stay[at] = True
                mark[hot] = 2
                g, fp, mark = g[stay], fp[stay], mark[stay]
                bucket = (g % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                rows = [(int(bucket[order[p[0]]]), int(blocks[part[0]]), *(c[order[p]].tobytes() for c in (g, fp, mark))) for p in cuts(bucket[order])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), *[pa.binary()] * 3), strict=True)], names=TOLD)

    return run


def shared_rows(table: pa.Table) -> pa.Table:
    """A bucket's answer to each block: hashes that several texts have, surroundings whose bytes the block has to send, and hot hashes."""
    g, fp, mark = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("g", np.uint64), ("fp", np.uint64), ("mark", np.uint8)))
    block = np.repeat(table.column("block").to_numpy(), [len(x) for x in table.column("mark").to_pylist()])
    order = np.lexsort((block, fp, g))
    g, fp, mark, block = g[order], fp[order], mark[order], block[order]
    new_g = np.concatenate([[True], g[1:] != g[:-1]]) if len(g) else np.zeros(0, bool)
    new_fp = new_g | np.concatenate([[True], fp[1:] != fp[:-1]]) if len(g) else new_g
    group = np.cumsum(new_g) - 1
    n, n_fp = np.bincount(group), np.bincount(group, new_fp)
    most = np.maximum.reduceat(mark, np.flatnonzero(new_g)) if len(g) else mark
    hot = ((most == 2) | (n_fp > HOT))[group]
    shared = ((n > 1) | (most > 0))[group]
    sent = new_fp & (n_fp > 1)[group] & ~hot
    rows = []
    keep = np.flatnonzero(shared)
    keep = keep[np.argsort(block[keep], kind="stable")]
    for p in cuts(block[keep]):
        i = keep[p]
        rows.append((int(block[i[0]]), np.unique(g[i]).tobytes(), np.unique(fp[i][sent[i]]).tobytes(), np.unique(g[i][hot[i]]).tobytes()))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (pa.int64(), *[pa.binary()] * 3), strict=True)], names=["block", "hashes", "sent", "hot"])


SENT = [("g", np.uint64), ("fp", np.uint64), ("row", np.int64), ("doc", np.int64), ("start", np.int32), ("low", np.int16), ("high", np.int16), ("has", np.uint8)]
SENT_DDL = "bucket bigint, settled boolean, " + ", ".join(f"{c} binary" for c, _ in SENT) + ", around binary"


def collapsed(g: np.ndarray, fp: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal surroundings the first document's stand for all. Returns (places that stay, places covered whole)."""
    if not len(g):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.lexsort((doc, fp, g))
    x, y = g[order], fp[order]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]), np.arange(len(x)), 0))
    later = doc[order] > doc[order[head]]
    return np.sort(order[~later]), np.sort(order[later])


def block_surroundings(length: int, n_buckets: int):
    """A function for cogroup().applyInArrow: a block's texts, and their first documents and the buckets' answers -> shared surroundings by bucket; those settled in the block in a negative bucket."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        joined = lambda c: np.unique(np.frombuffer(b"".join(x for x in answers.column(c).to_pylist() if x), np.uint64))
        hashes, sent, hot = joined("hashes"), joined("sent"), joined("hot")
        rows = []
        if len(hashes) and texts.num_rows:
            firsts = dict(zip(zip(answers.column("h1").to_pylist(), answers.column("h2").to_pylist(), strict=True), answers.column("first").to_pylist(), strict=True))
            docs = np.array([firsts[k] for k in zip(texts.column("h1").to_pylist(), texts.column("h2").to_pylist(), strict=True)], np.int64)
            numbers = texts.column("row").to_numpy()
            encoded, found, around = utf8(texts.column("text")), [], [np.empty((0, 2 * length - GRAM), np.uint8)]
            for a, b in looks(encoded):
                s = Sampled(encoded[a:b], length)
                which = np.flatnonzero(within(s.g, hashes))
                by_hash = within(s.g[which], hot)
                whole, parts = which[~by_hash], s.windows(which[by_hash])
                whose, fp, zero = np.concatenate([whole, parts[0]]), s.fingerprints(whole), np.zeros(len(parts[0]), np.int16)
                has = within(fp, sent)
                around.append(s.around(whole[has])[:, : 2 * length - GRAM])
                found.append((
                    np.concatenate([s.g[whole], parts[2]]), np.concatenate([fp, parts[3]]), numbers[a + s.text[whose]], docs[a + s.text[whose]],
                    np.concatenate([s.start[whole], (s.start[parts[0]] + parts[1]).astype(np.int32)]), np.concatenate([s.low[whole], zero]), np.concatenate([s.high[whole], zero]), np.concatenate([has, zero]),
                ))
            columns = {c: np.concatenate(x).astype(t) for (c, t), x in zip(SENT, zip(*found, strict=True), strict=True)}
            around, place = np.concatenate(around), np.cumsum(columns["has"], dtype=np.int64) - 1
            stay, covered = collapsed(columns["g"], columns["fp"], columns["doc"])
            # one place of each different surroundings has their bytes
            _, one = np.unique(columns["fp"][stay], return_index=True)
            columns["has"][np.setdiff1d(stay, stay[one])] = 0
            bucket = (columns["g"][stay] % np.uint64(n_buckets)).astype(np.int64)
            order = stay[np.argsort(bucket, kind="stable")]
            for p in cuts(np.sort(bucket)):
                i = order[p]
                rows.append((int(columns["g"][i[0]] % np.uint64(n_buckets)), False, *(columns[c][i].tobytes() for c, _ in SENT), around[place[i[columns["has"][i] > 0]]].tobytes()))
            if len(covered):
                rows.append((-1 - int(numbers[0] >> 32), True, *(columns[c][covered].tobytes() for c, _ in SENT), b""))
        fields = [("bucket", pa.int64()), ("settled", pa.bool_()), *((c, pa.binary()) for c, _ in SENT), ("around", pa.binary())]
        return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True) if rows else [()] * len(fields), fields, strict=True)], names=[n for n, _ in fields])

    return run


def suffix_array(around: np.ndarray, valid: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (flat places in valid) in the order of their first length bytes, equal ones by document; and what each has in common with the one before, up to length."""
    row, place = np.nonzero(valid)
    strings = np.zeros((len(row), -(-length // 8) * 8), np.uint8)
    strings[:, :length] = sliding_window_view(around, length, axis=1)[row, place]
    words = strings.view(">u8").astype(np.uint64)
    order = np.lexsort((doc[row], *words.T[::-1]))
    words = words[order]
    differ = words[1:] ^ words[:-1]
    word = (differ != 0).argmax(axis=1)
    value = differ[np.arange(len(differ)), word]
    byte = 7 - np.searchsorted(np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64), value, "right")
    common = np.where(value == 0, length, 8 * word + byte)
    return row[order] * valid.shape[1] + place[order], np.concatenate([[0], common]) if len(order) else common


def smaller_before(owner: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of an order the nearest place before it with a smaller owner (-1: none), and the least of ``common`` on the way there."""
    n = len(owner)
    at, least = np.arange(n) - 1, common.astype(np.int64)
    open_ = np.flatnonzero(at >= 0)
    while len(open_ := open_[owner[at[open_]] >= owner[open_]]):
        # what lies between a place and the one it points to is not smaller than it, so it can be passed over
        via = at[open_]
        least[open_] = np.minimum(least[open_], least[via])
        at[open_] = at[via]
        open_ = open_[at[open_] >= 0]
    least[at < 0] = 0
    return at, least


def longest_previous_factors(owner: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in order, with their documents and what each has in common with the one before: the longest prefix that a suffix of a smaller document has too."""
    previous = smaller_before(owner, common)[1]
    following = smaller_before(owner[::-1], np.concatenate([[0], common[:0:-1]]))[1][::-1] if len(owner) else previous
    return np.maximum(previous, following)


def covered_rows(length: int):
    """A function for applyInArrow: a bucket of surroundings -> block, row, start, end of what an earlier document has too."""

    def run(table: pa.Table) -> pa.Table:
        columns = {c: np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in SENT}
        sent = np.frombuffer(b"".join(table.column("around").to_pylist()), np.uint8).reshape(-1, 2 * length - GRAM)
        g, fp, doc, row, start, low, high = (columns[c] for c in ("g", "fp", "doc", "row", "start", "low", "high"))
        if table.column("settled")[0].as_py():
            out = [(row, start + low, start + high + length)]
        else:
            stay, whole = collapsed(g, fp, doc)
            out = [(row[whole], start[whole] + low[whole], start[whole] + high[whole] + length)]
            # the bytes of each different surroundings
            owner = np.flatnonzero(columns["has"])
            order = np.argsort(fp[owner], kind="stable")
            known, by_fp = fp[owner][order], order
            stay = stay[within(fp[stay], known)]
            stay = stay[np.lexsort((doc[stay], g[stay]))]
            # pieces end where a sampled string's surroundings end
            starts = np.flatnonzero(np.concatenate([[True], g[stay][1:] != g[stay][:-1]])) if len(stay) else np.empty(0, np.int64)
            ends = {int(starts[k]) for at in range(PIECE, len(stay), PIECE) if (k := np.searchsorted(starts, at)) < len(starts)}
            for piece in np.split(stay, sorted(ends)):
                if not len(piece):
                    continue
                places = np.arange(length - GRAM + 1)
                valid = (places >= low[piece][:, None]) & (places <= high[piece][:, None])
                around = sent[by_fp[np.searchsorted(known, fp[piece])]]
                suffixes, common = suffix_array(around, valid, doc[piece], length)
                hit = np.zeros(valid.shape, bool)
                hit.ravel()[suffixes] = longest_previous_factors(doc[piece][suffixes // len(places)], common) >= length
                # maximal runs of windows that go
                edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                i, lo = np.nonzero(edge == 1)
                hi = np.nonzero(edge == -1)[1] - 1
                out.append((row[piece][i], start[piece][i] + lo, start[piece][i] + hi + length))
        r, s, e = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
        # touching ranges of a row are merged
        order = np.lexsort((s, r))
        r, s, e = r[order], s[order], e[order]
        if len(r):
            big = np.int64(1) << np.int64(40)
            number = np.cumsum(np.concatenate([[0], r[1:] != r[:-1]]))
            reach = np.maximum.accumulate(e + number * big)
            new = np.concatenate([[True], (s + number * big)[1:] > reach[:-1]])
            last = np.append(np.flatnonzero(new)[1:] - 1, len(r) - 1)
            r, s, e = r[new], s[new], (reach - number * big)[last]
        block = r >> 32
        parts = cuts(block)
        return pa.table({"block": pa.array([int(block[p[0]]) for p in parts], pa.int64()), **{c: pa.array([v[p].tobytes() for p in parts], pa.binary()) for c, v in (("rows", r), ("starts", s), ("ends", e))}})

    return run


def kept_bytes(data: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What stays, the number of bytes removed, the number of maximal removed runs."""
    at, kept, removed, spans = 0, [], 0, 0
    for low, end in sorted(ranges):
        start = max(low, at)
        if end <= at:
            continue
        spans += low > at or not removed
        kept.append(data[at:start])
        removed += end - start
        at = end
    return b"".join([*kept, data[at:]]), removed, spans


CUT = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("removed", pa.int64()), ("spans", pa.int64()), ("sha", pa.string()), ("kept", pa.binary())])


def cut_texts(with_bytes: bool):
    """A function for cogroup().applyInArrow: a block's texts and the ranges to remove -> what stays of each text."""

    def run(texts: pa.Table, ranges: pa.Table) -> pa.Table:
        r, s, e = (np.frombuffer(b"".join(ranges.column(c).to_pylist()), np.int64) for c in ("rows", "starts", "ends"))
        order = np.argsort(r, kind="stable")
        r, s, e = r[order], s[order], e[order]
        done = []
        for i in range(texts.num_rows):
            number = texts.column("row")[i].as_py()
            lo, hi = np.searchsorted(r, number), np.searchsorted(r, number, "right")
            kept, removed, spans = kept_bytes((texts.column("text")[i].as_py() or "").encode("utf-8", "surrogatepass"), list(zip(s[lo:hi].tolist(), e[lo:hi].tolist(), strict=True)))
            done.append((texts.column("h1")[i].as_py(), texts.column("h2")[i].as_py(), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True) if done else [()] * len(CUT), CUT, strict=True)], schema=CUT)

    return run


def first_in_task(batches):
    """Rows (block, h1, h2, text) without those whose hashes the task has seen, so that a text of very many copies is sent once by each task."""
    seen = set()
    for batch in batches:
        new = []
        for k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            new.append(k not in seen)
            seen.add(k)
        yield batch.filter(pa.array(new, pa.bool_()))


def numbered(batches):
    """Rows (block, h1, h2, text) in order -> the same without repeats, with row: the block and a number within it."""
    before, n = None, 0
    for batch in batches:
        new, numbers = [], []
        for k in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if new_one := k != before:
                n = n + 1 if before and before[0] == k[0] else 0
                numbers.append((k[0] << 32) + n)
                before = k
            new.append(new_one)
        kept = batch.filter(pa.array(new, pa.bool_()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(numbers, pa.int64())], names=["block", "h1", "h2", "text", "row"])


def by_block(texts: DataFrame, n_files: int) -> DataFrame:
    """Stores the texts as a table bucketed by block, so that they need not move again; only its files stay."""
    spark = texts.sparkSession
    name = f"siltworks_{uuid.uuid4().hex}"
    moved = texts.mapInArrow(first_in_task, texts.schema).repartition(n_files, "block").sortWithinPartitions("block", "h1", "h2")
    rows = moved.mapInArrow(numbered, "block bigint, h1 bigint, h2 bigint, text string, row bigint")
    rows.write.option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}").bucketBy(n_files, "block").sortBy("block").format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018  resolved before the name goes; the files are outside the warehouse and stay
    spark.sql(f"DROP TABLE {name}")
    return table


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, with_bytes: bool = True) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans (long), kept_sha256 and, if with_bytes, kept (the remaining bytes, which may cut a character)."""
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{key} has to be an integer: documents are ordered by it")
    doc, words = F.coalesce(F.col(key).cast("bigint"), F.lit(FIRST_ID)), F.coalesce(F.col(text), F.lit(""))
    hashes = [F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(1), words).alias("h2")]
    total = docs.agg(F.sum(F.octet_length(words))).first()[0] or 0
    n_blocks = min(MAX_BLOCKS, max(1, math.ceil(total / BLOCK_BYTES)))
    n_files = min(MAX_FILES, max(1, math.ceil(total / FILE_BYTES)))
    block = F.pmod("h1", F.lit(n_blocks)).alias("block")
    heads = stored(docs.select(doc.alias("doc"), *hashes).groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count("*").alias("n")))
    texts = by_block(docs.select(words.alias("text"), *hashes).select(block, "h1", "h2", "text"), n_files)
    collect_garbage(docs.sparkSession)

    n_buckets = max(1, math.ceil(total / BUCKET_BYTES))
    told = texts.where(F.octet_length("text") >= length).select("block", "text").mapInArrow(told_rows(length, n_buckets), "bucket bigint, block bigint, g binary, fp binary, mark binary")
    answers = stored(told.groupBy("bucket").applyInArrow(shared_rows, "block bigint, hashes binary, sent binary, hot binary"))
    collect_garbage(docs.sparkSession)

    none = F.lit(None)
    firsts = heads.select(block, *(none.cast("binary").alias(c) for c in ("hashes", "sent", "hot")), "h1", "h2", "first")
    told = answers.select("*", *(none.cast("bigint").alias(c) for c in ("h1", "h2", "first"))).unionByName(firsts)
    around = texts.select("block", "row", "h1", "h2", "text").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(block_surroundings(length, n_buckets), SENT_DDL)
    ranges = stored(around.groupBy("bucket").applyInArrow(covered_rows(length), "block bigint, rows binary, starts binary, ends binary"))
    forget(answers)
    collect_garbage(docs.sparkSession)

    cut = texts.select("block", "row", "h1", "h2", "text").groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(cut_texts(with_bytes), "h1 bigint, h2 bigint, removed bigint, spans bigint, sha string, kept binary")
    cut = stored(cut if with_bytes else cut.drop("kept"))
    forget(texts)
    forget(ranges)
    collect_garbage(docs.sparkSession)

    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    carried = [c for c in docs.columns if c not in new]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in carried)).alias("r"), doc.alias("doc"), F.octet_length(words).cast("bigint").alias("n_bytes"), *hashes)
    joined = heavy_join(rows, cut.drop("kept").join(heads, ["h1", "h2"]), ["h1", "h2"], "n")
    copy = (F.col("doc") > F.col("first")) & (F.col("n_bytes") >= length)
    columns = [
        F.col("n_bytes"), F.when(copy, F.col("n_bytes")).otherwise(F.col("removed")).alias("n_removed"), F.when(copy, F.lit(1).cast("bigint")).otherwise(F.col("spans")).alias("n_spans"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).otherwise(F.col("sha")).alias("kept_sha256"),
    ]
    if with_bytes:
        # copies have none, so a text of very many copies asks for its bytes once
        asks = F.when(~copy, F.col("h1")).otherwise(-1 - F.pmod(F.xxhash64("doc"), F.lit(1 << 40)))
        bytes_of = cut.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "kept")
        joined = joined.withColumn("_asks", asks).join(bytes_of, (F.col("_asks") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
        columns.append(F.coalesce("kept", F.lit(b"")).alias("kept"))
    return joined.select(*(F.col(f"r.`{c}`") for c in carried), *columns)
