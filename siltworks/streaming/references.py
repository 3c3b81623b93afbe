"""Repeated references on a stream: one state for each reference, which expires."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from siltworks.functions import columns as fn
from siltworks.functions import fixed, names
from siltworks.operators import rules
from siltworks.operators.schema import quoted

#: Where states have to be kept for this operator, and parts over which rows without a reference are spread.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPREAD = 4096


class Repeats(StatefulProcessor):
    """Gives each row of a reference back with whether one came before: in the order column within a micro-batch, by the state between them."""

    def __init__(self, names: list[str], order: str, keep_ms: int | None):
        self.names, self.order, self.keep_ms = names, order, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        out = Row(*self.names)
        if key[0] is None:  # nothing to remember
            for r in rows:
                yield out(*(r[n] for n in self.names[:-1]), False)
            return
        before = self.seen.exists()
        # a micro-batch's rows of one reference
        for r in sorted(rows, key=lambda r: (r[self.order] is None, r[self.order])):
            yield out(*(r[n] for n in self.names[:-1]), before)
            before = True
        self.seen.update((True,))

    def close(self) -> None:
        pass


def with_stream_repeats(stream: DataFrame, reference: Column, order: str, keep: int | None = None, into: str = rules.REPEATED) -> DataFrame:
    """The stream with a boolean: whether a row with the same trimmed reference came before. keep: seconds after which a reference that didn't come
    again is forgotten (never by default); processing time goes on by itself, so a stream that forgets runs until it is stopped, whatever its trigger. Rows without one are spread and never repeats. The session has to keep states in RocksDB (STATE_STORE).
    """
    value = fn.trimmed(reference)
    part = F.when(value.isNull(), F.pmod(F.xxhash64(*map(quoted, stream.columns)), F.lit(SPREAD))).otherwise(0)
    rows = stream.select(value.alias("_reference_key"), part.cast("int").alias("_reference_part"), *map(quoted, stream.columns))
    schema = StructType([*stream.schema.fields, StructField(into, BooleanType())])
    processor = Repeats(schema.names, order, keep * 1000 if keep else None)
    return rows.groupBy("_reference_key", "_reference_part").transformWithState(processor, schema, "append", "ProcessingTime" if keep else "None")


def stream_validated_all(stream: DataFrame, table: str, active: set[str], order: str, as_of: date | None = None, keep: int | None = None) -> DataFrame:
    """Validation of a stream with all rules, repeated references (BNK-012) among them."""
    reference = names.Resolver(stream.columns).first(fixed.REFERENCE_COLUMNS)
    if "BNK-012" in active and reference:
        stream = with_stream_repeats(stream, quoted(reference).cast("string"), order, keep)
    return rules.validated(stream, table, active, as_of)
