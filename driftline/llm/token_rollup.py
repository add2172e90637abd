"""Delta-maintained token-count rollups by source, language and tokenizer version.

A batch of changes is aggregated to signed deltas and written as one table, ``deltas/batch=<id>``, in the store's folder; the writer's
_SUCCESS file commits it. A batch that is already committed is not written again, and what a failed attempt left is overwritten, so
commits are idempotent. Totals are the sums of committed deltas; ``compact`` replaces deltas by their sums and remembers whose they were.

A change carries counts, not texts: an insert has ``tokens_after``, a delete ``tokens_before``, a revision both. Changes may have a column ``before``, a struct of
source, lang and tokenizer: a revision that has one moved its document, which counts off there and on at its new keys.

Defined cases: null sources and languages are groups of their own; a null count is 0; a change of an unknown kind raises; repeated rows count each
time; an empty batch commits and changes nothing; null and empty texts have no tokens, and texts are counted whole, however long; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, plain, slices
from .tokenizing import encoder

KEY = ["source", "lang", "tokenizer"]
CHANGES = "kind string, source string, lang string, tokenizer string, tokens_before bigint, tokens_after bigint"
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


def counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang and n_tokens of whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches, "text"):
            _, bounds = enc.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array(np.diff(bounds))], ["doc_id", "source", "lang", "n_tokens"])

    return mapped(plain(docs, "doc_id", "source", "lang", "text"), count, "doc_id bigint, source string, lang string, n_tokens bigint", keeps=True)


def inserts(counted: DataFrame, version: str) -> DataFrame:
    return counted.select(F.lit("insert").alias("kind"), "source", "lang", F.lit(version).alias("tokenizer"), F.lit(None).cast("long").alias("tokens_before"), F.col("n_tokens").alias("tokens_after"))


def revisions(counted: DataFrame, version: str, after) -> DataFrame:
    return inserts(counted, version).select(F.lit("revise").alias("kind"), *KEY, F.col("tokens_after").alias("tokens_before"), after.alias("tokens_after"))


def deletes(counted: DataFrame, version: str) -> DataFrame:
    return inserts(counted, version).select(F.lit("delete").alias("kind"), *KEY, F.col("tokens_after").alias("tokens_before"), F.lit(None).cast("long").alias("tokens_after"))


def moves(counted: DataFrame, version: str, source=None, lang=None, after=None) -> DataFrame:
    """Revisions of documents that get another source or language, and another count if ``after`` says so."""
    plain_ = revisions(counted, version, F.col("tokens_after") if after is None else after)
    before = F.struct("source", "lang", "tokenizer")
    return plain_.withColumn("before", before).withColumns({k: c for k, c in (("source", source), ("lang", lang)) if c is not None})


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums by key; combined in each task before the shuffle, so a source with most rows is no hot group."""
    kind = F.col("kind")
    if "before" in changes.columns:  # a move is a delete and an insert
        cells = lambda k, key, b, a: F.struct(k.alias("kind"), *[key[c].alias(c) for c in KEY], b.alias("tokens_before"), a.alias("tokens_after"))
        own = F.struct(*KEY)
        none = F.lit(None).cast("bigint")
        moved = (kind == "revise") & F.col("before").isNotNull()
        two = F.array(cells(F.lit("delete"), F.col("before"), F.col("tokens_before"), none), cells(F.lit("insert"), own, none, F.col("tokens_after")))
        one = F.array(cells(kind, own, F.col("tokens_before"), F.col("tokens_after")))
        changes = changes.select(F.inline(F.when(moved, two).otherwise(one)))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("null")))))
    before, after = F.coalesce("tokens_before", F.lit(0)), F.coalesce("tokens_after", F.lit(0))
    tokens = F.when(kind == "insert", after).when(kind == "delete", -before).otherwise(after - before)
    return changes.groupBy(*KEY).agg(F.sum(docs.cast("long")).alias("docs"), F.sum(tokens).alias("tokens"))


class Rollup:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        made = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return made.getFileSystem(self.spark._jsc.hadoopConfiguration()), made

    def _listed(self, folder: str) -> list[str]:
        """Committed tables in a folder, by name."""
        fs, path = self._files(f"{self.path}/{folder}")
        if not fs.exists(path):
            return []
        names = sorted(x.getPath().getName() for x in fs.listStatus(path))
        return [n for n in names if fs.exists(self._files(f"{self.path}/{folder}/{n}/_SUCCESS")[1])]

    def _base(self) -> str | None:
        found = self._listed("base")
        return f"{self.path}/base/{found[-1]}" if found else None

    def committed(self, batch: str) -> bool:
        """Whether a batch is committed: its own mark says so, or the list of those that were compacted."""
        fs, mark = self._files(f"{self.path}/deltas/batch={batch}/_SUCCESS")
        base = self._base()
        return fs.exists(mark) or (base is not None and not self.spark.read.parquet(f"{base}/batches").where(F.col("batch") == batch).isEmpty())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Whether the batch was new. One batch id has one writer at a time."""
        if self.committed(batch):
            return False
        deltas(changes).write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        return True

    def _loose(self) -> list[str]:
        """Committed batches since the last compaction, whose deltas count."""
        names = [n.removeprefix("batch=") for n in self._listed("deltas")]
        base = self._base()
        if base is None or not names:
            return names
        done = {r["batch"] for r in self.spark.read.parquet(f"{base}/batches").where(F.col("batch").isin(names)).collect()}
        return [n for n in names if n not in done]

    def totals(self) -> DataFrame:
        base = self._base()
        paths = [f"{self.path}/deltas/batch={n}" for n in self._loose()]
        parts = [self.spark.read.schema(DELTA).parquet(*paths)] if paths else []
        if base:
            parts.append(self.spark.read.schema(DELTA).parquet(f"{base}/sums"))
        rows = parts[0] if parts else self.spark.createDataFrame([], DELTA)
        for p in parts[1:]:
            rows = rows.unionByName(p)
        # keys whose documents have all gone drop out
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Sums up all committed deltas; the new base counts only once its own _SUCCESS is there, and then old deltas are ignored and removed."""
        names, base = self._loose(), self._base()
        n = len(self._listed("base"))
        to = f"{self.path}/base/{n:08d}"
        self.totals().write.mode("overwrite").parquet(f"{to}/sums")
        batches = self.spark.createDataFrame([(b,) for b in names], "batch string")
        batches = batches if base is None else batches.unionByName(self.spark.read.parquet(f"{base}/batches"))
        batches.write.mode("overwrite").parquet(f"{to}/batches")
        fs, mark = self._files(f"{to}/_SUCCESS")
        fs.create(mark, True).close()
        for b in names:
            fs.delete(self._files(f"{self.path}/deltas/batch={b}")[1], True)
