"""Packing of token ids into sequences, as a cutting-stock problem solved by column generation.

A document's ids and an end mark are cut at multiples of the sequence size, so that only the last piece is shorter. The histogram of all pieces'
lengths (one number for each length) is covered by patterns: multisets of lengths that share a sequence. A linear program picks how often
each pattern is used; a pattern costs its padded length, and each length may also be cut freely for a small charge. New patterns
are priced by a knapsack program over exact totals. Solutions are rounded down, and patterns of large fractions are used once more
where pieces are left for them. Pieces are ranked within their length, by counts of each task that read them, so that no task sees all
pieces of a length; a pattern takes a range of ranks of each of its lengths. What no pattern takes is laid end to end, by length and rank, and cut
where a sequence is full; the last sequence is cut at powers of two, which need no padding.

The ids are those of the tokenizers library for the same file, whose merges are ranks: each match of the file's splitting pattern is
encoded by tiktoken, which takes a fifth of the time. Strings of special tokens in a text are ordinary text.

Defined cases: a null text is empty and has the end mark only; very long texts are encoded in parts that end before a single space
between other characters, where the pattern always splits; rows with one key are documents of their own; a null key is carried; any share
of pieces may have one length; an empty table gives no rows; columns named like an output column are replaced, others may
have any name; without ``carry`` all columns but the text are carried, for each piece again.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltworks.llm.common import once_per_worker, quoted, scratch, stored

#: Characters of a part of a text that is encoded at once, and bytes of ids in a batch.
PART, BATCH_BYTES = 1 << 16, 4 << 20
#: Patterns that enter the linear program between two pricings.
PIVOTS = 32
#: Bits of a rank in a key of length and rank.
RANK_BITS = 44
SPLIT = re.compile(r"(?<=\S) (?=\S)")


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a file of the tokenizers library, whose tokens are written in printable characters: bytes without one of their own follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    as_byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    return {bytes(as_byte[c] for c in token): i for token, i in vocabulary.items() if all(c in as_byte for c in token)}


def parts_of(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART and (m := SPLIT.search(text, at + PART)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encoder(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    library = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        return np.concatenate([np.array(library.encode_ordinary(part), "<u4") for part in parts_of(text)])

    return encode


class Patterns:
    """The linear program: min cost of columns that cover each length exactly as often as it occurs."""

    def __init__(self, lengths: list[int], demand: list[int], size: int, cut: float):
        self.lengths, self.demand, self.size = np.array(lengths), np.array(demand, float), size
        m = len(lengths)
        powers = {1 << b for b in range(size.bit_length())}
        self.padded = np.array([c if c in powers else size for c in range(size + 1)], float)
        self.cut = self.lengths + cut
        self.inverse = np.eye(m)
        self.start()
        self.refactor()

    def start(self) -> None:
        """The first basis: each column uses up one length, the longest that is left with few others that fill a sequence or, where that pads more than it saves, by cuts."""
        left, at = self.demand.copy(), {int(x): k for k, x in enumerate(self.lengths)}
        self.columns, self.costs = [{k: 1} for k in range(len(left))], self.cut.astype(float)
        has = np.zeros(self.size + 1, bool)
        has[self.lengths] = True
        while (lengths := np.flatnonzero(has)).size:
            own, rest = Counter([at[int(lengths[-1])]]), self.size - int(lengths[-1])
            while (fits := lengths[: np.searchsorted(lengths, rest, "right")]).size:
                pairs = fits[has[rest - fits]]
                take = int(pairs[-1] if pairs.size and fits[-1] < rest else fits[-1])
                own[at[take]] += 1
                rest -= take
            if (cost := self.padded[self.size - rest]) > sum(self.cut[k] * a for k, a in own.items()):
                left[at[int(lengths[-1])]] = 0.0
            else:
                k = min(own, key=lambda k: left[k] / own[k])
                n = left[k] / own[k]
                for j, a in own.items():
                    left[j] -= n * a
                left[k] = 0.0
                self.columns[k], self.costs[k] = dict(own), cost
            has[self.lengths] = left > 1e-9

    def priced(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Knapsack: for each exact total the best value of lengths, and the last length put in."""
        value, last = np.full(self.size + 1, -np.inf), np.full(self.size + 1, -1)
        value[0] = 0.0
        fit = np.searchsorted(self.lengths, np.arange(self.size + 1), "right")
        for c in range(int(self.lengths[0]), self.size + 1):
            with_each = value[c - self.lengths[: fit[c]]] + y[: fit[c]]
            last[c] = k = with_each.argmax()
            value[c] = with_each[k]
        return value, last

    def pattern(self, last: np.ndarray, total: int, first: int | None = None) -> dict[int, int]:
        found: Counter[int] = Counter()
        if first is not None:
            found[first] += 1
            total -= int(self.lengths[first])
        while total > 0:
            found[k := int(last[total])] += 1
            total -= int(self.lengths[k])
        return dict(found)

    def enter(self, pattern: dict[int, int], cost: float, y: np.ndarray) -> np.ndarray | None:
        """Takes a column into the basis if it lowers the cost; the new prices, or None."""
        at, times = np.array(list(pattern)), np.array(list(pattern.values()), float)
        gain = cost - y[at] @ times
        if gain > -1e-7 * cost:
            return None
        direction = self.inverse[:, at] @ times
        ok = direction > 1e-9
        if not ok.any():
            return None
        ratio = np.full(len(direction), np.inf)
        ratio[ok] = self.used[ok] / direction[ok]
        r = int(ratio.argmin())
        step = ratio[r]
        self.used = np.maximum(self.used - step * direction, 0.0)
        self.used[r] = step
        row = self.inverse[r] / direction[r]
        direction[r] -= 1.0
        self.inverse -= np.outer(direction, row)
        self.costs[r], self.columns[r] = cost, pattern
        return y + gain * row

    def solve(self, gap: float, rounds: int) -> float:
        """Until the cost is within a share of a bound (all tokens, or what scaled prices give), or for so many rounds of pricing; gives cost over bound."""
        exact, tokens, ratio = self.demand, float(self.demand @ self.lengths), np.inf
        # slightly different demands keep steps from having length 0; they are exact again at the end
        self.demand = exact + np.random.default_rng(0).uniform(1e-4, 1e-3, len(exact))
        for _ in range(rounds):
            self.refactor()
            y = self.costs @ self.inverse
            value, last = self.priced(y)
            scaled = max(1.0, (value[1:] / self.padded[1:]).max(), (y / self.cut).max())
            ratio = float(y @ exact) / max(tokens, float(y @ exact) / scaled)
            if ratio <= 1 + gap:
                break
            # the best pattern of each total, and of each length with the rest of a full sequence
            offers = [(self.padded[c] - value[c], c, None) for c in range(1, self.size + 1) if value[c] > self.padded[c]]
            whole = value[self.size - self.lengths] + y
            offers += [(self.size - whole[k], self.size, k) for k in np.flatnonzero(whole > self.size)]
            moved = 0
            for _, c, k in sorted(offers, key=lambda o: o[0]):
                after = self.enter(self.pattern(last, c, None if k is None else int(k)), self.padded[c], y)
                if after is not None:
                    y, moved = after, moved + 1
                if moved >= PIVOTS:
                    break
            for k in np.flatnonzero(y > self.cut * (1 + 1e-6)):
                if (after := self.enter({int(k): 1}, float(self.cut[k]), y)) is not None:
                    y, moved = after, moved + 1
            if not moved:
                break
        self.demand = exact
        self.refactor()
        return ratio

    def refactor(self) -> None:
        basis = np.zeros_like(self.inverse)
        for k, column in enumerate(self.columns):
            basis[list(column), k] = list(column.values())
        self.inverse = np.linalg.inv(basis)
        self.used = np.maximum(self.inverse @ self.demand, 0.0)

    def rounded(self) -> list[tuple[dict[int, int], int]]:
        """Patterns (number of pieces by length) and how often each is used, never more than there are pieces."""
        left = {int(k): int(d) for k, d in enumerate(self.demand)}
        patterns = zip(self.used.tolist(), self.columns, self.costs.tolist(), strict=True)
        chosen = [(x, c) for x, c, cost in patterns if x > 1e-6 and cost == self.padded[sum(a * self.lengths[k] for k, a in c.items())]]
        times = []
        for x, c in chosen:
            n = min(int(x + 1e-6), *(left[k] // a for k, a in c.items()))
            times.append(n)
            for k, a in c.items():
                left[k] -= n * a
        for p in sorted(range(len(chosen)), key=lambda p: chosen[p][0] % 1, reverse=True):
            c = chosen[p][1]
            if all(left[k] >= a for k, a in c.items()):
                times[p] += 1
                for k, a in c.items():
                    left[k] -= a
        return [({int(self.lengths[k]): a for k, a in c.items()}, n) for (_, c), n in zip(chosen, times, strict=True) if n]


class Places:
    """Where a piece of a length and rank lies: arrays of ranges of ranks, sorted by length and first rank."""

    def __init__(self, histogram: dict[int, int], chosen: list[tuple[dict[int, int], int]], size: int):
        taken, ranges, sequence = Counter(), [], 0
        for pattern, n in chosen:
            offset = 0
            for length in sorted(pattern, reverse=True):
                copies = pattern[length]
                ranges.append((length << RANK_BITS | taken[length], copies, offset, sequence))
                taken[length] += n * copies
                offset += copies * length
            sequence += n
        line = 0
        for length in sorted(histogram, reverse=True):
            ranges.append((length << RANK_BITS | taken[length], 0, line, sequence))
            line += (histogram[length] - taken[length]) * length
        self.first, self.copies, self.offset, self.sequence = np.array(sorted(ranges), np.int64).reshape(-1, 4).T
        self.line_sequence, self.size = sequence, size
        # sequences of the line: full ones, then the powers of two that make up the rest
        self.full, rest = divmod(line, size)
        bits = [1 << b for b in reversed(range(size.bit_length())) if rest >> b & 1]
        self.tail = self.full * size + np.concatenate([np.zeros(1, np.int64), np.cumsum(np.array(bits, np.int64))])

    def of(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of each part of a piece."""
        k = int(np.searchsorted(self.first, length << RANK_BITS | rank, "right")) - 1
        nth = rank - (int(self.first[k]) & (1 << RANK_BITS) - 1)
        if copies := int(self.copies[k]):
            return [(0, length, int(self.sequence[k]) + nth // copies, int(self.offset[k]) + nth % copies * length)]
        at, out, done = int(self.offset[k]) + nth * length, [], 0
        while done < length:
            p = at + done
            if p < self.full * self.size:
                number, begin, end = p // self.size, p // self.size * self.size, (p // self.size + 1) * self.size
            else:
                t = int(np.searchsorted(self.tail, p, "right")) - 1
                number, begin, end = self.full + t, int(self.tail[t]), int(self.tail[t + 1])
            n = min(length - done, end - p)
            out.append((done, n, self.line_sequence + number, p - begin))
            done += n
        return out


def batch_of(rows: pa.Array, take: list[int], columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rows.take(pa.array(take, pa.int64())), *(pa.array(v, kind) for v, kind in columns.values())], names=["_row", *columns])


def token_pieces(batches: Iterator[pa.RecordBatch], get, size: int, end: int) -> Iterator[pa.RecordBatch]:
    """Every document's pieces, ranked by their order among the task's pieces of their length."""
    from pyspark import TaskContext

    encode, part, seen = get(), TaskContext.get().partitionId(), Counter()
    kinds = {"part": pa.int32(), "rank": pa.int64(), "start": pa.int64(), "length": pa.int32(), "doc_tokens": pa.int64(), "ids": pa.binary()}
    for batch in batches:
        rows, take, out, held = batch.column("_row"), [], [], 0
        for i, text in enumerate(batch.column("_text")):
            ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
            for at in range(0, len(ids), size):
                own = ids[at : at + size]
                take.append(i)
                out.append((part, seen[len(own)], at, len(own), len(ids), own.tobytes()))
                seen[len(own)] += 1
                held += own.nbytes
                if held > BATCH_BYTES:
                    yield batch_of(rows, take, {n: ([o[k] for o in out], kind) for k, (n, kind) in enumerate(kinds.items())})
                    take, out, held = [], [], 0
        if out:
            yield batch_of(rows, take, {n: ([o[k] for o in out], kind) for k, (n, kind) in enumerate(kinds.items())})


def placed(batches: Iterator[pa.RecordBatch], places: Places) -> Iterator[pa.RecordBatch]:
    """The pieces with their sequences and offsets, cut where the line of what no pattern took is cut."""
    kinds = {"start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            take, out = [], []
            values = zip(*(batch.column(c).to_pylist() for c in ("rank", "before", "start", "length", "doc_tokens", "ids")), strict=True)
            for i, (rank, before, start, length, tokens, ids) in enumerate(values):
                for begin, n, sequence, offset in places.of(length, rank + before):
                    take.append(i)
                    out.append((start + begin, n, ids[4 * begin : 4 * (begin + n)], tokens, sequence, offset))
            yield batch_of(batch.column("_row"), take, {n: ([o[k] for o in out], kind) for k, (n, kind) in enumerate(kinds.items())})


def pack(docs: DataFrame, vocabulary: str, pattern: str, size: int = 1024, end: int = 0, cut_share: float = 0.01, gap: float = 0.005, rounds: int = 100, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """For each piece the carried columns with start, length, ids (little-endian unsigned 32-bit numbers), doc_tokens, sequence_id and offset.

    end: the id after each document. cut_share: what a cut of a short document counts, as a share of a sequence. gap: the linear program stops within
    this share of its bound, or after so many rounds of pricing; both change how well patterns fill sequences, not what is packed.
    """
    made = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    carry = [c for c in ([c for c in docs.columns if c != text] if carry is None else carry) if c not in made]
    ranks = ranks_of(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    get = lambda: once_per_worker(("packing", vocabulary, pattern, len(ranks)), lambda: encoder(sent.value, pattern))
    used = docs.select(F.struct(*quoted(carry), F.lit(0).alias("_none")).alias("_row"), F.col(f"`{text}`").alias("_text"))
    row = StructType([used.schema["_row"]])
    with scratch(docs.sparkSession) as kept:
        schema = StructType([*row, *StructType.fromDDL("part int, rank bigint, start bigint, length int, doc_tokens bigint, ids binary")])
        pieces = stored(used.mapInArrow(lambda b: token_pieces(b, get, size, end), schema))
        # a row for each task and length
        counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
        histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
        chosen = []
        if histogram:
            program = Patterns(sorted(histogram), [histogram[x] for x in sorted(histogram)], size, cut_share * size)
            program.solve(gap, rounds)
            chosen = program.rounded()
        places = Places(histogram, chosen, size)
        before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
        schema = StructType([*row, *StructType.fromDDL("start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")])
        done = pieces.join(before, ["part", "length"]).select("_row", "rank", "before", "start", "length", "doc_tokens", "ids").mapInArrow(lambda b: placed(b, places), schema)
        return kept(done.select(*(F.col(f"_row.`{c}`") for c in carry), *made))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, their ids one after another, and n_tokens; padding follows from the size."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    whole = pieces.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
    return whole.withColumn("n_tokens", (F.octet_length("ids") / F.lit(4)).cast("bigint"))
