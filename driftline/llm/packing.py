"""Best-two-fit packing of documents into sequences of bounded length.

Only lengths decide a packing, and there are at most ``capacity`` of them. So the driver packs the histogram of lengths, by
patterns (the lengths in one sequence) with the number of times each is used: one step uses a pattern as often as the
remaining counts allow, which ends at least one length, so patterns are few however many documents there are. Documents then
take the places of their length in the order of their rank, without any being compared or moved to the driver.

A pattern: fill greedily, each time with the longest that fits; then replace its smallest document by two unpacked ones
that fit the gap, as the smallest leaves it, more tightly.

Defined cases: a null text is empty and an empty text is its end id alone; equal rows are separate documents; a null doc_id
is kept; an empty table gives no pieces; other columns are not read. A document longer than the capacity is cut so that
its first piece is the shorter one.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, plain, slices, stage
from .tokenizing import encoder, with_end

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"


class Lengths:
    """Counts by length, with the longest not above a bound found by bisection."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: n for k, n in counts.items() if n > 0}
        self.keys = sorted(self.count)

    def longest(self, most: int, used: dict[int, int] | None = None) -> int | None:
        i = bisect_right(self.keys, most) - 1
        while i >= 0 and used and self.count[self.keys[i]] <= used.get(self.keys[i], 0):
            i -= 1
        return self.keys[i] if i >= 0 else None

    def take(self, pattern: dict[int, int], times: int) -> None:
        for k, n in pattern.items():
            self.count[k] -= n * times
            if not self.count[k]:
                del self.count[k]
                self.keys.remove(k)


def best_two(free: Lengths, used: dict[int, int], smallest: int, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths that together fill ``room`` more than ``smallest`` does, as much as any two can."""
    best, found = smallest, None
    for a in reversed(free.keys):
        if a >= room or 2 * a <= best:
            if 2 * a <= best:
                break
            continue
        left = {**used, a: used.get(a, 0) + 1}
        if free.count[a] < left[a]:
            continue
        b = free.longest(min(a, room - a), left)
        if b and a + b > best:
            best, found = a + b, (a, b)
            if best == room:
                break
    return found


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Packs the histogram: (lengths in a sequence, number of such sequences)."""
    free, made = Lengths(counts), []
    while free.keys:
        used: dict[int, int] = {}
        gap = capacity
        while gap > 0 and (k := free.longest(gap, used)):
            used[k] = used.get(k, 0) + 1
            gap -= k
        if gap and len(used) and sum(used.values()) > 1:
            small = min(used)
            rest = {**used, small: used[small] - 1}
            if two := best_two(free, rest, small, gap + small):
                used = {k: n for k, n in rest.items() if n}
                for k in two:
                    used[k] = used.get(k, 0) + 1
        times = min(free.count[k] // n for k, n in used.items())
        free.take(used, times)
        made.append((sorted((k for k, n in used.items() for _ in range(n)), reverse=True), times))
    return made


def places(made: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset), in the order of ranks. A run of places ends where the next begins."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for lengths, times in made:
        offset = 0
        for k in lengths:
            out.setdefault(k, []).append((taken.get(k, 0), first, offset))
            taken[k] = taken.get(k, 0) + times
            offset += k
        first += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Tokenizes and cuts. ``rank`` counts a task's pieces of that length, ``part`` names the task; the caller must write them once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            ids, bounds = with_end(*enc.encode(batch.column("text")), end_id)
            size = np.diff(bounds)
            n = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = size - (n - 1) * capacity
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            at = 4 * (bounds[doc] + start)
            crcs = [zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            same = length[order]
            firsts = np.searchsorted(same, same)
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - firsts + seen[same]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64()), pa.array(np.full(len(doc), part), pa.int32()), pa.array(rank)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    return mapped(plain(docs, "doc_id", "text"), cut, PIECES, keeps=True)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, end_id, capacity), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # within a length one row for each task, not one for each document
    before = by_part.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    slots = spark.sparkContext.broadcast(places(patterns(counts, capacity)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("global_rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                place = slots.value[int(k)]
                at = np.searchsorted(place[:, 0], rank[own], side="right") - 1
                sequence[own] = place[at, 1] + rank[own] - place[at, 0]
                offset[own] = place[at, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = cut.join(before.select("part", "length", "before"), ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("global_rank"))
    return mapped(ranked, assign, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids in order, for documents whose doc_id is unique."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches, "text"):
            ids, bounds = with_end(*enc.encode(batch.column("text")), end_id)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    ids = mapped(plain(docs, "doc_id", "text"), encode, "doc_id bigint, ids array<int>", keeps=True)
    own = packed.join(ids, "doc_id").select("sequence_id", "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids"))
    # a sequence holds at most its capacity of ids, so its group is bounded
    return own.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
