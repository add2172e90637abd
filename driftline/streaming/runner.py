"""A change stream into a target that keeps positions and tombstones, so replays and late batches change nothing; snapshots beside a running log."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import after, chunk, fold, numbered, reconcile, renamed
from ..operators.snapshots import chunk_of, reconcile_chunks
from ..plans.transforms import Pipeline
from ..staging import staged
from .state import Checkpoints, Signals, Snapshot, Store
from .target import Target

__all__ = ["Control", "Limits", "Target", "parallel_snapshot", "run", "snapshot", "sync"]


@dataclass
class Control:
    """What a running stream does on request, between two batches. ``tables(names)`` gives present rows of tables with the target's columns; a request without
    tables calls ``refresh``, which gives tables' present names."""

    signals: Signals
    tables: Callable[[list[str]], DataFrame] | None = None
    position: Callable[[], int | str] | None = None
    refresh: Callable[[], dict[str, str]] | None = None

    def drain(self, target: Target, pipeline: Pipeline, names: dict[str, str]) -> dict[str, str]:
        """Takes requests up in their order. A table's rows count as of the position before they were read: whatever the log says later wins,
        also what it said while they were read, and reaches the target with the stream."""
        for id_, wanted in self.signals.pending():
            if wanted:
                low = self.position()
                rows = self.tables(wanted).withColumns({"_op": F.lit("c"), "_pos": F.lit(low)})
                target.merge(pipeline.rows(rows))
            elif self.refresh:
                names = self.refresh()
            self.signals.acknowledge(id_)
        return names


@dataclass
class Limits:
    """Where a stream ends by itself: before a position, after so many rows (the earliest), after so many batches, or at a deadline in seconds from its start."""

    until: int | str | None = None
    rows: int | None = None
    batches: int | None = None
    seconds: float | None = None
    reached: threading.Event = field(default_factory=threading.Event)

    def cut(self, batch: DataFrame, seen: int) -> DataFrame:
        if self.until is not None:
            batch = batch.where(F.col("_pos") < self.until)
        return batch if self.rows is None else batch.orderBy("_pos").limit(max(0, self.rows - seen))

    def note(self, highest, seen: int, batches: int) -> None:
        if (self.until is not None and highest is not None and highest >= self.until) or (self.rows is not None and seen >= self.rows) or (self.batches is not None and batches >= self.batches):
            self.reached.set()


class Reached(Exception):
    """A batch that came after the limit; it is not applied, and read again by the next run."""


def sync(stream: DataFrame, target: Target, checkpoint: str, pipeline: Pipeline = Pipeline(), fail: Callable[[int], None] | None = None, continuous: bool = False, checkpoints: Checkpoints | None = None, names: dict[str, str] = {}, control: Control | None = None, limits: Limits | None = None, **trigger) -> StreamingQuery:
    """Transforms every change of a micro-batch, then merges what is left, so that the result doesn't depend on where the stream is cut.

    A batch's changes are evaluated once, and a batch that is in already isn't at all. ``continuous`` waits for batches as long as the pipeline's
    options say. A batch that fails ends the query, or with the policy ``skip`` is noted and passed over without a write. Rows are counted as they
    are read, before transforms drop or add some (``target.head()["seen"]``, by checkpoint). Changes of tables that have been renamed go under their present
    ``names``. Requests to ``control`` are taken up before a batch.
    """
    present, taken = dict(names), [0]

    def write(batch: DataFrame, number: int) -> None:
        nonlocal present
        if limits and limits.reached.is_set():
            raise Reached(number)
        if control:
            present = control.drain(target, pipeline, present)
        head = target.head()
        if head["done"].get(checkpoint, -1) >= number:
            return
        try:
            whole, own = Observation(), Observation()
            events = batch.observe(whole, F.max("_pos").alias("highest"))
            if limits:
                events = limits.cut(events, head["seen"].get(checkpoint, 0))
            events = events.observe(own, F.count(F.lit(1)).alias("rows"), F.max("_pos").alias("highest"))
            target.merge(pipeline.rows(renamed(events, present)), checkpoint, number, lambda: own.get["rows"])
            taken[0] += 1
            if limits:
                limits.note(whole.get["highest"], target.head()["seen"][checkpoint], taken[0])
            if checkpoints:
                checkpoints.written(own.get["highest"])
            if fail:
                fail(number)
        except Exception:
            if pipeline.options.failure_policy != "skip":
                raise
            target.skip(checkpoint, number)

    when = trigger or (pipeline.options.trigger() if continuous else {"availableNow": True})
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**when).start()


def run(stream: DataFrame, target: Target, checkpoint: str, limits: Limits, checkpoints: Checkpoints | None = None, poll: float = 0.05, **more) -> None:
    """``sync`` until a limit is reached or nothing is left, and then the last position is saved, whatever the policy's interval."""
    began = time.monotonic()
    query = sync(stream, target, checkpoint, checkpoints=checkpoints, limits=limits, **more)
    while query.isActive and not limits.reached.is_set():
        if limits.seconds is not None and time.monotonic() - began >= limits.seconds:
            limits.reached.set()
        query.awaitTermination(poll)
    if limits.reached.is_set():
        while query.isActive and query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            time.sleep(poll)  # the batch that is being applied, or the next, which is refused
        query.stop()
    failed = query.exception()
    if failed and "Reached" not in str(failed):
        raise failed
    if checkpoints:
        checkpoints.flush()


def snapshot(tables: dict[str, tuple[DataFrame, list[str]]], log: DataFrame, store: Store, emit: Callable[[str, DataFrame], None], position: Callable[[], int], size: int = 1_000_000, signals: Signals | None = None, wave: int = 1, marks: Callable[[Column], tuple[Column, Column]] | None = None) -> None:
    """Table after table in chunks, each read once between two positions of the log, reconciled with it and emitted, with progress saved after each; a stopped
    snapshot goes on after the last saved key.

    One chunk at a time takes a few jobs and a look through the table for each. With a ``wave`` of more, what is left of a table is read at once, cut into the
    same chunks, and ``wave`` chunks are reconciled and emitted in one job, with progress saved after it. They share the positions before and after that read,
    unless ``marks`` gives each chunk, by its number in the table, a window of its own.
    """
    state = Snapshot.load(store)
    if store.get("full_sync_start") is None:
        store.phase("full_sync_start", position())
    queue = [t for t in tables if t not in state.done]
    while queue:
        name = queue.pop(0)
        rows, keys = tables[name]
        if wave > 1:
            _snapshot_waves(name, rows, keys, log.where(F.col("_table") == name).drop("_table"), state, store, emit, position, size, wave, marks)
        while wave == 1:
            low = position()
            part = staged(chunk(rows, keys, size, state.last_keys.get(name)), "chunk")
            last = part.orderBy(*[F.desc(k) for k in keys]).limit(1).select(*keys).first()
            high = position()
            if last is None:
                break
            seen = F.col("_pos") > (-1 if state.position is None else state.position)
            own = log.where((F.col("_table") == name) & seen & (F.col("_pos") <= high)).drop("_table")
            emit(name, reconcile(part, own, keys, low, high, tombstones=True))
            state.after(name, list(last), 1, high)
            state.save(store)
        state.done.append(name)
        state.save(store)
        for id_, wanted in signals.pending() if signals else []:
            for t in wanted:
                if t in tables:
                    state.done = [d for d in state.done if d != t]
                    state.last_keys.pop(t, None)
                    state.chunks.pop(t, None)
                    queue.append(t)
            signals.acknowledge(id_)
    store.phase("full_sync_end", state.position)
    store.phase("snapshot_handoff", state.position)


def _snapshot_waves(name: str, rows: DataFrame, keys: list[str], log: DataFrame, state: Snapshot, store: Store, emit: Callable[[str, DataFrame], None], position: Callable[[], int], size: int, wave: int, marks: Callable[[Column], tuple[Column, Column]] | None) -> None:
    """What is left of a table, ``wave`` chunks in a job. Of a shared window the log also wins at its end, so a key that it names there has one row at that position."""
    last, first = state.last_keys.get(name), state.chunks.get(name, 0)
    low = position()
    cut = numbered(rows.where(after(keys, last)) if last else rows, keys, size)
    cut = staged(cut.withColumn("_chunk", F.col("chunk_no") + first).drop("row_index", "chunk_no"), "chunks")
    high = position()
    kind = dict(log.dtypes)["_pos"]
    ends = marks(F.col("_chunk")) if marks else (F.lit(low), F.lit(high))
    cut = cut.withColumns({"_low": ends[0].cast(kind), "_high": ends[1].cast(kind)})
    until = F.col("_at") < F.col("_high") if marks else F.col("_at") <= F.col("_high")
    number = (cut.agg(F.max("_chunk")).first()[0] or 0) + 1 - first
    for at in range(first, first + number, wave):
        part = cut.where(F.col("_chunk").between(at, at + wave - 1))
        found = part.agg(F.count_distinct("_chunk").alias("n"), F.min("_low").alias("low"), F.max("_high").alias("high"), F.max(F.struct(*keys)).alias("last")).first()
        if not found["n"]:
            break
        window = log.where((F.col("_pos") > found["low"]) & (F.col("_pos") <= found["high"])).select(*keys, F.col("_pos").alias("_at"))
        said = part.select(*keys, "_low", "_high").join(window, keys).where((F.col("_at") > F.col("_low")) & until).select(*keys).distinct()
        read = part.join(said, keys, "left_anti").withColumns({"_op": F.lit("c"), "_pos": F.col("_high"), "_phase": F.lit(1)}).drop("_chunk", "_low", "_high")
        own = log.where((F.col("_pos") > (-1 if state.position is None else state.position)) & (F.col("_pos") <= found["high"]))
        emit(name, fold(read.unionByName(own.withColumn("_phase", F.lit(0)), allowMissingColumns=True), keys, ["_pos", "_phase"], tombstones=True).drop("_phase"))
        state.after(name, list(found["last"]), found["n"], found["high"])
        state.save(store)


def parallel_snapshot(name: str, rows: DataFrame, keys: list[str], bounds: list[list], log: DataFrame, store: Store, emit: Callable[[str, DataFrame], None], position: Callable[[], int], waves: int = 1) -> None:
    """A table in as many chunks as ``bounds`` cut it into, all of a wave in one job. A wave is read once, between two positions that its chunks share, and
    emitted; a stopped snapshot goes on with the wave after the last one saved. What the log says from the first position on is emitted at the end."""
    plan = store.get(f"waves_{name}") or {"next": 0, "bounds": bounds, "start": position()}
    bounds = plan["bounds"]  # those that a stopped snapshot has begun with
    chunks = len(bounds) + 1
    edges = sorted({round(i * chunks / waves) for i in range(waves + 1)})
    for first, stop in [(a, b) for a, b in zip(edges, edges[1:]) if a >= plan["next"]]:
        own = rows
        if first:
            own = own.where(_from(keys, bounds[first - 1]))
        if stop < chunks:
            own = own.where(~_from(keys, bounds[stop - 1]))
        low = position()
        part = staged(own.withColumn("_chunk", chunk_of(keys, bounds, rows)), "wave")
        high = position()
        marks = rows.sparkSession.createDataFrame([(c, low, high) for c in range(first, stop)], "_chunk int, _low long, _high long")
        window = log.where((F.col("_table") == name) & (F.col("_pos") > low) & (F.col("_pos") <= high)).drop("_table")
        emit(name, reconcile_chunks(part, window, keys, bounds, marks, tombstones=True))
        plan = {**plan, "next": stop, "high": high}
        store.put(f"waves_{name}", plan)
    rest = log.where((F.col("_table") == name) & (F.col("_pos") > plan["start"]) & (F.col("_pos") <= plan["high"])).drop("_table")
    emit(name, rest)
    store.phase("snapshot_handoff", plan["high"])


def _from(keys: list[str], bound: list):
    """At or beyond a bound."""
    same = F.lit(True)
    for k, v in zip(keys, bound):
        same = same & (F.col(k) == v)
    return after(keys, bound) | same
