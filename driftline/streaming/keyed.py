"""What a stream remembers of a key from one micro-batch to the next: its last image, and how often a version was met."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..staging import importable

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class KeepBefore(StatefulProcessor):
    """Updates whose image has NULLs get the last values known since the key's last create or delete.

    A key that was deleted is forgotten ``forget`` seconds after its last change, if it isn't made again before; as a delete ends what later updates
    may fall back on, but for its own image, that loses nothing unless a key is updated after its delete and that time.
    """

    def __init__(self, schema: T.StructType, keys: list[str], payload: list[str], order: str, forget: float | None):
        self.keys, self.payload, self.order, self.forget = keys, payload, order, forget
        self.names = schema.names
        self.kept = T.StructType([*[schema[c] for c in payload], T.StructField("closed", T.BooleanType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", self.kept)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.last.get()
        values, closed = (list(held[:-1]), held[-1]) if held else ([None] * len(self.payload), False)
        for row in sorted(rows, key=lambda r: r[self.order]):  # a key's changes of one micro-batch
            own = [row[c] for c in self.payload]
            known = [v if w is None else w for v, w in zip(values, own)]
            values, closed = (known, closed) if row["_op"] == "u" else (own, row["_op"] == "d")
            filled = dict(zip(self.payload, known if row["_op"] == "u" else own))
            yield Row(*self.names)(*[filled.get(c, row[c]) for c in self.names])
        self.last.update((*values, closed))
        if self.forget is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            if closed:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.forget * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


class Ordinals(StatefulProcessor):
    """Numbers rows alike from 0 on, over all micro-batches."""

    def __init__(self, schema: T.StructType, order: list[str]):
        self.names, self.order = schema.names, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.met = handle.getValueState("met", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.met.get()
        n = held[0] if held else 0
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in self.order)):
            yield Row(*self.names, "duplicate")(*row, n)
            n += 1
        self.met.update((n,))

    def close(self) -> None:
        pass


def keep_before(changes: DataFrame, keys: list[str], payload: list[str], order: str = "_pos", forget: float | None = None) -> DataFrame:
    """As ``changes.keep_before``, for a stream in log order: the same rows whether they come in one micro-batch, in many, or after a restart. Of a key it
    holds one image, and while a micro-batch is worked on, that batch's changes of the key, which the source's limit bounds."""
    importable(changes.sparkSession).conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    processor = KeepBefore(changes.schema, keys, payload, order, forget)
    return changes.groupBy(*keys).transformWithState(processor, changes.schema, "append", "none" if forget is None else "processingTime")


def ordinals(rows: DataFrame, alike: list[str], order: list[str]) -> DataFrame:
    """``duplicate``: how many rows alike came before, in this micro-batch by ``order``, or in one before it."""
    importable(rows.sparkSession).conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    out = T.StructType([*rows.schema.fields, T.StructField("duplicate", T.LongType())])
    return rows.groupBy(*alike).transformWithState(Ordinals(rows.schema, order), out, "append", "none")
