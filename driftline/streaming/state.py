"""Checkpoints of a synchronisation as JSON files: phases, snapshot progress, covered tables, ad-hoc snapshot requests."""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

PHASES = ("full_sync_start", "full_sync_end", "snapshot_progress", "snapshot_handoff", "catch_up_progress")


class Store:
    """Files in one folder, local or in any store that the session's file systems reach.

    Each value is a file of its own, numbered, and the highest number counts. A file gets its name once it is whole, and the one before goes only after
    that, so whenever a writer stops there is a value, the old or the new one. Of writers of one number only one succeeds; that takes a store whose
    rename fails where there is a file, as HDFS's does, or a local one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf, self.root = spark._jvm, spark._jsc.hadoopConfiguration(), path.rstrip("/")

    def at(self, path: str):
        """The file system of a path, and the path."""
        made = self.jvm.org.apache.hadoop.fs.Path(path)
        return made.getFileSystem(self.conf), made

    def _path(self, name: str):
        return self.at(f"{self.root}/{name}")

    def _numbers(self, name: str) -> list[int]:
        fs, root = self._path("")
        if not fs.exists(root):
            return []
        own = re.compile(re.escape(name) + r"\.(\d+)\.json")
        return sorted(int(m[1]) for f in fs.listStatus(root) if (m := own.fullmatch(f.getPath().getName())))

    def put(self, name: str, value: dict) -> None:
        numbers = self._numbers(name)
        if not self.put_new(name, numbers[-1] + 1 if numbers else 0, value, numbers):
            raise OSError(f"another writer has put {name}")

    def put_new(self, name: str, n: int, value: dict, old: list[int] | None = None) -> bool:
        """Puts a value under a number that no one has used, whole or not at all; False if someone has. Those before the last go."""
        fs, part = self._path(f"{name}.{n:012d}.{uuid.uuid4().hex}.part")
        to = self._path(f"{name}.{n:012d}.json")[1]
        out = fs.create(part, True)
        out.write(json.dumps(value, sort_keys=True).encode())
        out.close()
        if fs.getScheme() == "file":  # there a rename replaces what is there, a link doesn't
            try:
                os.link(fs.makeQualified(part).toUri().getPath(), fs.makeQualified(to).toUri().getPath())
                made = True
            except FileExistsError:
                made = False
            fs.delete(part, False)
        else:
            made = not fs.exists(to) and fs.rename(part, to)
        if made:
            for k in old if old is not None else [k for k in self._numbers(name) if k < n - 1]:
                fs.delete(self._path(f"{name}.{k:012d}.json")[1], False)
        return made

    def get(self, name: str) -> dict | None:
        numbers = self._numbers(name)
        if not numbers:
            return None
        fs, path = self._path(f"{name}.{numbers[-1]:012d}.json")
        try:
            stream = fs.open(path)
        except Exception:  # another writer has put the next two meanwhile
            if self._numbers(name) == numbers:
                raise
            return self.get(name)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def phase(self, phase: str, position) -> None:
        if phase not in PHASES:
            raise ValueError(f"unknown phase: {phase}")
        self.put(phase, {"position": position})


@dataclass
class Checkpoints:
    """When a stream's position is saved beside the engine's own checkpoint: after ``each`` batch, ``never``, or at an ``interval`` of seconds and
    at the end. Only positions of batches that are written are saved."""

    store: Store
    policy: str = "each"
    seconds: float = 0.0
    waiting: int | str | None = None
    saved_at: float = 0.0

    def __post_init__(self) -> None:
        if self.policy not in ("each", "never", "interval"):
            raise ValueError(f"unknown policy: {self.policy}")

    def written(self, position, now: float | None = None) -> None:
        now = time.monotonic() if now is None else now
        if position is not None and (self.waiting is None or position > self.waiting):
            self.waiting = position
        if self.policy == "each" or self.policy == "interval" and now - self.saved_at >= self.seconds:
            self.flush(now)

    def flush(self, now: float | None = None) -> None:
        if self.policy != "never" and self.waiting is not None:
            before = (self.store.get("catch_up_progress") or {}).get("position")
            if before is None or self.waiting > before:
                self.store.phase("catch_up_progress", self.waiting)
            self.waiting, self.saved_at = None, time.monotonic() if now is None else now


@dataclass
class Snapshot:
    """Where a snapshot of several tables stands."""

    position: int | str | None = None
    last_keys: dict[str, list] = field(default_factory=dict)
    done: list[str] = field(default_factory=list)
    chunks: dict[str, int] = field(default_factory=dict)

    def after(self, name: str, last: list, chunks: int, position) -> None:
        """``chunks`` more of a table are in, up to the key ``last``."""
        self.last_keys[name], self.chunks[name], self.position = last, self.chunks.get(name, 0) + chunks, position

    def save(self, store: Store) -> None:
        store.put("snapshot_progress", asdict(self))

    @classmethod
    def load(cls, store: Store) -> Snapshot:
        return cls(**(store.get("snapshot_progress") or {}))


@dataclass
class CatchUp:
    """Tables that the log covers from a position on."""

    position: int | str | None = None
    tables: list[str] = field(default_factory=list)

    def merge(self, tables: list[str], position) -> CatchUp:
        return CatchUp(position if self.position is None else max(self.position, position), sorted({*self.tables, *tables}))

    def prune(self, requested: list[str]) -> CatchUp:
        return CatchUp(self.position, sorted({*self.tables} & {*requested}))

    def pending(self, requested: list[str]) -> list[str]:
        return sorted({*requested} - {*self.tables})


class Signals:
    """Requests, acknowledged once taken up: for snapshots of single tables, or, with no table, for the schema to be read again."""

    def __init__(self, store: Store):
        self.store = store

    def _all(self) -> dict:
        return self.store.get("signals") or {}

    def request(self, id: str, tables: list[str]) -> None:
        self.store.put("signals", self._all() | {id: {"tables": tables, "done": False}})

    def pending(self) -> list[tuple[str, list[str]]]:
        return [(k, v["tables"]) for k, v in sorted(self._all().items()) if not v["done"]]

    def acknowledge(self, id: str) -> None:
        every = self._all()
        self.store.put("signals", every | {id: every[id] | {"done": True}})
