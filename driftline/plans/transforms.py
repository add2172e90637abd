"""Transform stages over rows or changes, from code or TOML."""

from __future__ import annotations

import json
import queue
import random
import re
import shutil
import subprocess
import threading
import time
import tomllib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import flatten_id

# fixed values: seconds in a unit of a duration
DURATION = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


def seconds(text: str) -> float:
    m = re.fullmatch(r"(\d+)(ms|s|m|h)", text.strip())
    if not m:
        raise ValueError(f"not a duration: {text}")
    return int(m[1]) * DURATION[m[2]]


@dataclass(frozen=True)
class Options:
    """How a stream is cut into batches, and what a failed batch does."""

    failure_policy: str = "fail"
    batch_size: int = 1
    batch_max_wait: float = 0.5
    timeout: float = 60.0
    max_in_flight: int = 1

    def trigger(self) -> dict[str, str]:
        """How long a stream waits for a batch to fill."""
        return {"processingTime": f"{round(self.batch_max_wait * 1000)} milliseconds"}


@dataclass
class Stage:
    """``rows`` for tables; ``edges`` for relations, and a stage without it refuses them."""

    rows: Callable[[DataFrame], DataFrame]
    edges: Callable[[DataFrame], DataFrame] | None = None


def identity() -> Stage:
    return Stage(lambda df: df, lambda df: df)


def flattened(separator: str = ":", column: str = "_id") -> Stage:
    """Array ids become text; scalar ids stay as they are."""

    def run(df: DataFrame) -> DataFrame:
        arrays = [c for c in (column, "in", "out") if dict(df.dtypes).get(c) == "array<string>"]
        return df.withColumns({c: flatten_id(F.col(c), separator) for c in arrays}) if arrays else df

    return Stage(run, run)


@dataclass(frozen=True)
class Retry:
    attempts: int = 1
    backoff: float = 0.1
    most: float = 5.0

    def waits(self) -> Iterator[float]:
        for i in range(self.attempts - 1):
            yield min(self.most, self.backoff * 2**i) * (0.5 + random.random() / 2)


class Exchange:
    """One worker process: a header line with batch_id, count and kind, then the rows, both ways, a JSON object a line.

    Lines are written and read at the same time, so a worker may answer while it is still being fed; one that is silent for ``timeout``
    seconds, or ends, fails the batch, and ``kill`` ends it.
    """

    def __init__(self, command: list[str], timeout: float = 60.0):
        self.timeout = timeout
        self.process = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True)
        self.lines: queue.Queue = queue.Queue(10_000)
        threading.Thread(target=self._read, daemon=True).start()

    def _read(self) -> None:
        for line in self.process.stdout:
            self.lines.put(line)
        self.lines.put(None)

    def _line(self) -> dict:
        try:
            line = self.lines.get(timeout=self.timeout)
        except queue.Empty:
            raise TimeoutError(f"the worker was silent for {self.timeout} s") from None
        if line is None:
            self.lines.put(None)
            raise RuntimeError("the worker ended within a batch")
        return json.loads(line)

    def _feed(self, send: list[str]) -> None:
        try:
            for line in send:
                self.process.stdin.write(line + "\n")
            self.process.stdin.flush()
        except (OSError, ValueError):  # it ended, which the reader notices
            pass

    def run(self, batch: int, rows: list[dict], kind: str) -> list[dict]:
        feed = threading.Thread(target=self._feed, args=([json.dumps({"batch_id": batch, "count": len(rows), "kind": kind}), *map(json.dumps, rows)],), daemon=True)
        feed.start()
        head = self._line()
        if head.get("batch_id") != batch:
            raise RuntimeError(f"the worker answered batch {head.get('batch_id')}, not {batch}")
        out = [self._line() for _ in range(head["count"])]
        feed.join(self.timeout)
        if feed.is_alive():
            raise TimeoutError(f"the worker took no input for {self.timeout} s")
        return out

    def close(self) -> None:
        self.process.stdin.close()
        try:
            self.process.wait(timeout=min(10.0, self.timeout))
        except subprocess.TimeoutExpired:
            self.kill()

    def kill(self) -> None:
        self.process.kill()
        self.process.wait()


def command(argv: list[str], schema: str | None = None, persistent: bool = True, retry: Retry = Retry(), kind: str = "rows", timeout: float = 60.0, batch_size: int = 1000) -> Stage:
    """Rows through an external program, a process for each partition or, not ``persistent``, for each batch of ``batch_size`` rows. It may
    drop and add rows. A process that failed is ended before the batch is tried again with a new one."""
    if not argv or shutil.which(argv[0]) is None:
        raise ValueError(f"no such command: {argv[:1]}")

    def run(df: DataFrame) -> DataFrame:
        names = df.columns

        def exchange(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            worker = None
            parts = (frame.iloc[a : a + batch_size] for frame in frames for a in range(0, len(frame), batch_size))
            try:
                for i, frame in enumerate(parts):
                    rows = json.loads(frame.to_json(orient="records", date_format="iso"))
                    for wait in (*retry.waits(), None):
                        try:
                            worker = worker or Exchange(argv, timeout)
                            out = worker.run(i, rows, kind)
                            break
                        except Exception:
                            if worker:
                                worker.kill()
                                worker = None
                            if wait is None:
                                raise
                            time.sleep(wait)
                    if not persistent:
                        worker.close()
                        worker = None
                    yield pd.DataFrame(out, columns=names if schema is None else None)
            finally:
                if worker:
                    worker.close()

        return df.mapInPandas(exchange, schema or df.schema)

    return Stage(run)


@dataclass
class Pipeline:
    stages: list[Stage] = field(default_factory=list)
    options: Options = Options()

    @property
    def is_identity(self) -> bool:
        return not self.stages

    def rows(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, s: d.transform(s.rows), self.stages, df)

    def edges(self, df: DataFrame) -> DataFrame:
        if any(s.edges is None for s in self.stages):
            raise ValueError("a stage has no handler for relations")
        return reduce(lambda d, s: d.transform(s.edges), self.stages, df)

    def then(self, *stages: Stage) -> Pipeline:
        """Stages of code come after those of the file; options that were the identity's become those of batches."""
        options = self.options
        if self.is_identity and stages and options == Options():
            options = replace(options, batch_size=1000)
        return Pipeline([*self.stages, *stages], options)


def _only(given: dict, *known: str) -> None:
    if extra := set(given) - set(known):
        raise ValueError(f"unknown keys: {', '.join(sorted(extra))}")


def load(text: str) -> Pipeline:
    """``[pipeline]`` and ``[[transforms]]``; nothing, or passthrough stages alone, is the identity."""
    raw = tomllib.loads(text)
    _only(raw, "pipeline", "transforms")
    head = raw.get("pipeline", {})
    _only(head, "failure_policy", "batch_size", "batch_max_wait", "timeout", "max_in_flight")
    options = Options() if not raw else replace(Options(), batch_size=1000)
    if head.get("failure_policy", "fail") not in ("fail", "skip"):
        raise ValueError("failure_policy is fail or skip")
    if head.get("max_in_flight", 1) > 1:
        raise ValueError("max_in_flight: micro-batches are applied one at a time, in order")
    options = replace(options, **{k: seconds(v) if k in ("batch_max_wait", "timeout") else max(1, v) if isinstance(v, int) else v for k, v in head.items()})
    stages = []
    for t in raw.get("transforms", []):
        kind = t.get("type")
        if kind == "passthrough":
            _only(t, "type")
        elif kind == "flatten_id":
            _only(t, "type", "separator")
            stages.append(flattened(t.get("separator", ":")))
        elif kind == "command":
            _only(t, "type", "command", "mode", "stdio", "timeout", "retry")
            if t.get("mode", "persistent") not in ("persistent", "transient"):
                raise ValueError("mode is persistent or transient")
            r = t.get("retry", {})
            _only(r, "max_attempts", "initial_backoff", "max_backoff")
            retry = Retry(r.get("max_attempts", 1), seconds(r.get("initial_backoff", "100ms")), seconds(r.get("max_backoff", "5s")))
            if t.get("stdio", {}).get("framer", "ndjson") != "ndjson":
                raise ValueError("the framer is ndjson")
            timeout = seconds(t["timeout"]) if "timeout" in t else options.timeout
            stages.append(command(t.get("command", []), persistent=t.get("mode", "persistent") == "persistent", retry=retry, timeout=timeout, batch_size=options.batch_size))
        else:
            raise ValueError(f"unknown transform: {kind}")
    return Pipeline(stages, options)
