"""A table that change streams are merged into: runs of folded changes, put together when they are read."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import fold
from .state import Store


class Target:
    """Rows by key, with tombstones and positions.

    A merge writes its changes once, as a run of its own, and a numbered commit names the runs that count, so it writes as much as it changes. Positions decide
    between runs, never their order, so merges may come in any order and twice. Of runs of about one size ``fanout`` are folded into one, which writes a row
    again a few times for each doubling of the table, on the whole.

    A commit's file is made only if no other has its number. Who comes second reads the other's commit, adds its own run to that, and tries again after a pause
    that doubles; a compaction whose runs have gone meanwhile is dropped. So writers of one table lose nothing. The folder of a run that no longer counts is
    removed ``KEPT`` commits later, so a reader has that long.
    """

    KEPT = 8

    def __init__(self, spark: SparkSession, path: str, keys: list[str], fanout: int = 4, pause: float = 0.1, attempts: int = 12):
        self.spark, self.path, self.keys, self.fanout, self.pause, self.attempts = spark, path.rstrip("/"), keys, fanout, pause, attempts
        self.store = Store(spark, f"{self.path}/_state")

    def head(self) -> dict:
        """The last commit: its version, its runs, and of each stream the last batch (``done``), the rows read (``seen``) and the batches passed over."""
        return self.store.get("commit") or {"version": 0, "runs": [], "gone": {}, "done": {}, "seen": {}, "skipped": {}}

    @property
    def version(self) -> int:
        return self.head()["version"]

    def commit(self, change: Callable[[dict], dict | None]) -> dict | None:
        """Makes the next commit of what ``change`` gives for the present one; None leaves things as they are."""
        for attempt in range(self.attempts):
            now = self.head()
            after = change(now)
            if after is None:
                return None
            after = {**now, **after, "version": now["version"] + 1}
            dropped = {r["path"] for r in now["runs"]} - {r["path"] for r in after["runs"]}
            old = [p for p, v in now["gone"].items() if v + self.KEPT < after["version"]]
            after["gone"] = {p: v for p, v in now["gone"].items() if p not in old} | {p: after["version"] for p in dropped}
            if self.store.put_new("commit", after["version"], after):
                for path in old:
                    fs, at = self.store.at(f"{self.path}/{path}")
                    fs.delete(at, True)
                return after
            time.sleep(min(5.0, self.pause * 2**attempt))
        raise TimeoutError(f"other writers were first {self.attempts} times")

    def _write(self, rows: DataFrame) -> dict | None:
        """A run of folded rows, with what a reader wants to know of it."""
        path = f"run-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{path}")
        n, low, high = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{path}").agg(F.count(F.lit(1)), F.min("_pos"), F.max("_pos")).first()
        fs, at = self.store.at(f"{self.path}/{path}")
        if not n:
            fs.delete(at, True)
            return None
        plain = isinstance(low, (int, str))
        return {"path": path, "rows": n, "bytes": fs.getContentSummary(at).getLength(), "low": low if plain else None, "high": high if plain else None}

    def merge(self, changes: DataFrame, stream: str | None = None, batch: int = -1, seen: Callable[[], int] = lambda: 0) -> bool:
        """Whether anything was done: a ``batch`` of a ``stream`` that is in already is not evaluated again. ``seen`` is asked once the changes are written."""
        if stream and self.head()["done"].get(stream, -1) >= batch:
            return False
        run = self._write(fold(changes, self.keys, tombstones=True))
        came = seen() if stream else 0

        def add(now: dict) -> dict | None:
            more = {"runs": [*now["runs"], *([run] if run else [])]}
            if stream:
                if now["done"].get(stream, -1) >= batch:
                    return None
                more |= {"done": {**now["done"], stream: batch}, "seen": {**now["seen"], stream: now["seen"].get(stream, 0) + came}}
            return more if run or stream else None

        self.commit(add)
        while self.compact():
            pass
        return True

    def skip(self, stream: str, batch: int) -> None:
        """Notes a batch that is passed over."""
        self.commit(lambda now: {"done": {**now["done"], stream: batch}, "skipped": {**now["skipped"], stream: [*now["skipped"].get(stream, []), batch]}})

    def compact(self) -> bool:
        """Folds the newest runs that are no larger than the last, by powers of ``fanout``, if they are that many."""
        tier = lambda r: int(math.log(max(r["rows"], 1), self.fanout) + 1e-9)
        runs = self.head()["runs"]
        last = [i for i in range(len(runs)) if all(tier(r) <= tier(runs[-1]) for r in runs[i:])]
        if len(last) < self.fanout:
            return False
        old = runs[last[0] :]
        gone = {r["path"] for r in old}
        try:
            new = self._write(self._folded(old))
        except Exception:
            if gone <= {r["path"] for r in self.head()["runs"]}:
                raise
            return False  # another writer has folded them

        def swap(now: dict) -> dict | None:
            if not gone <= {r["path"] for r in now["runs"]}:
                return None
            at = min(i for i, r in enumerate(now["runs"]) if r["path"] in gone)
            rest = [r for r in now["runs"] if r["path"] not in gone]
            return {"runs": [*rest[:at], new, *rest[at:]]}

        return self.commit(swap) is not None

    def _read(self, runs: list[dict]) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self.spark.read.parquet(f"{self.path}/{r['path']}") for r in runs])

    def _folded(self, runs: list[dict]) -> DataFrame:
        """The last row of each key. If the largest run is older than all others, as with a stream in order, it is only searched for their keys,
        which Spark does without a shuffle while they are few."""
        if len(runs) == 1:
            return self._read(runs)
        base = max(runs, key=lambda r: r["rows"])
        rest = [r for r in runs if r is not base]
        newer = fold(self._read(rest), self.keys, tombstones=True) if len(rest) > 1 else self._read(rest)
        if base["high"] is None or any(r["low"] is None or r["low"] <= base["high"] for r in rest):
            return fold(self._read([base]).unionByName(newer, allowMissingColumns=True), self.keys, tombstones=True)
        old, by = self._read([base]), newer.select(*[F.col(k).alias(f"_new_{k}") for k in self.keys])
        same = reduce(lambda a, b: a & b, [old[k].eqNullSafe(by[f"_new_{k}"]) for k in self.keys])
        return old.join(by, same, "left_anti").unionByName(newer, allowMissingColumns=True)

    def all(self) -> DataFrame | None:
        """Rows with tombstones and positions; None before the first merge."""
        runs = self.head()["runs"]
        return self._folded(runs) if runs else None

    def rows(self) -> DataFrame | None:
        """The present rows, without tombstones and positions; None before the first merge."""
        held = self.all()
        return None if held is None else held.where("_op <> 'd'").drop("_op", "_pos")
