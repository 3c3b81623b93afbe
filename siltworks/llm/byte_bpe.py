"""Byte-level BPE encoding and decoding.

Within each match of the splitting pattern, a segment tree over byte positions stores the leftmost minimum rank of the
pairs that start there. Each merge takes the root and makes logarithmic point updates on the merged place and its live
neighbours, so a long match without white space costs n log n. Nodes have ``FAN`` children, whose least one call finds: the
tree of a usual match is its leaves and a root.

Defined cases: a null text is empty and has no tokens; every text's decoded bytes are its UTF-8 bytes; very long texts are
encoded whole, match by match; repeated rows get the same ids each; an empty table gives no rows; columns named like an output
column are replaced, others may have any name. The vocabulary file's path is a parameter; its bytes (a file of fixed size) are broadcast.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltworks.llm.common import map_rows, once_per_worker

#: Distinct matches remembered by a Python worker.
REMEMBERED = 500_000
#: Ranks are below 2 ** RANK_BITS, with or without gaps between them.
RANK_BITS = 32
#: Children of a node of the segment tree.
FAN = 32


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n, get = len(piece), ranks.get
    bits = n.bit_length()
    none, place = 1 << RANK_BITS + bits, (1 << bits) - 1
    # rank and place in one number; the smallest is the leftmost of the lowest rank
    leaves = [none if (rank := get(piece[i : i + 2])) is None else rank << bits | i for i in range(n - 1)]
    leaves.append(none)
    after, before = list(range(1, n + 2)), list(range(-1, n))
    levels = [leaves]
    while len(levels[-1]) > FAN:
        levels.append([min(levels[-1][k : k + FAN]) for k in range(0, len(levels[-1]), FAN)])
    top, inner = levels[-1], list(zip(levels, levels[1:], strict=False))

    def lift(i: int) -> None:
        """The nodes above a changed leaf, up to the first that stays the same."""
        for below, above in inner:
            k = i // FAN
            least = min(below[k * FAN : k * FAN + FAN])
            if above[k] == least:
                break
            above[k], i = least, k

    while (least := min(top)) != none:
        i = least & place
        j = after[i]
        k = after[i] = after[j]
        leaves[j] = none
        if k < n:
            before[k] = i
            leaves[i] = none if (rank := get(piece[i : after[k]])) is None else rank << bits | i
        else:
            leaves[i] = none
        b = before[i]
        if b >= 0:
            leaves[b] = none if (rank := get(piece[b:k])) is None else rank << bits | b
        if inner:
            lift(j)
            lift(i)
            if b >= 0:
                lift(b)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Codec(dict):
    """Match of the pattern to ids, as little-endian 32-bit numbers; remembers a bounded number of matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.pieces = {i: token for token, i in ranks.items()}
        self.older = {}

    def __missing__(self, match: str) -> bytes:
        if (ids := self.older.get(match)) is None:
            ids = np.array(merge(match.encode("utf-8", "surrogatepass"), self.ranks), "<u4").tobytes()
        if len(match) <= 64:
            if len(self) >= REMEMBERED // 2:
                # what was used since the last time stays
                self.older = dict(self)
                self.clear()
            self[match] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec_for(spark, vocabulary: str, pattern: str):
    """A function that each Python worker calls to get its codec, which lasts from task to task with what it remembers."""
    ranks = read_ranks(vocabulary)
    key = hashlib.sha256(repr((sorted(ranks.items(), key=lambda x: x[1]), pattern)).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(ranks)
    return lambda: once_per_worker(key, lambda: Codec(sent.value, pattern))


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", into: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with an array of token ids."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != into]
    get = codec_for(docs.sparkSession, vocabulary, pattern)

    def make():
        codec = get()
        return lambda t: (np.frombuffer(codec.encode(t or ""), "<u4").tolist(),)

    return map_rows(docs, carry, text, make, pa.schema([(into, pa.list_(pa.int32()))]), f"`{into}` array<int>")


def decode(docs: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", into: str = "decoded", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with the decoded bytes; a null array has none."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != into]
    get = codec_for(docs.sparkSession, vocabulary, pattern)

    def make():
        codec = get()
        return lambda x: (codec.decode(np.array(x or [], "<u4").tobytes()),)

    return map_rows(docs, carry, ids, make, pa.schema([(into, pa.binary())]), f"`{into}` binary")


def round_trips(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", into: str = "ids", same: str = "decoded", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with an array of token ids, and whether these decode to the text's bytes: encoding and decoding in one pass.

    encode() and decode() in a row hold two Python workers, each with a codec, for each task at a time; this holds one.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in (into, same)]
    get = codec_for(docs.sparkSession, vocabulary, pattern)

    def make():
        codec = get()

        def row(t):
            ids = codec.encode(t or "")
            return np.frombuffer(ids, "<u4"), codec.decode(ids) == (t or "").encode("utf-8", "surrogatepass")

        return row

    return map_rows(docs, carry, text, make, pa.schema([(into, pa.list_(pa.int32())), (same, pa.bool_())]), f"`{into}` array<int>, `{same}` boolean")


def digests(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with n_tokens, ids_sha256 and decoded_sha256: encoding and decoding in one pass."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("n_tokens", "ids_sha256", "decoded_sha256")]
    get = codec_for(docs.sparkSession, vocabulary, pattern)
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def make():
        codec = get()

        def row(t):
            ids = codec.encode(t or "")
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

        return row

    return map_rows(docs, carry, text, make, schema, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
