"""Approximate nearest neighbours with a permutation index.

A vector is represented by its ``LISTED`` nearest pivots in order; each pivot's inverted file lists the vectors that name it, with
the rank they give it. A query adds up, over the files of its own pivots, how much closer each candidate's order is than one with no
pivot in common (the footrule distance, a missing pivot counting as rank ``LISTED``); the closest ``SHARE`` of a block's vectors, and
``LEAST`` at least, are ranked again by their exact inner product. Every vector is indexed, in blocks of a task's rows; the best of all blocks are merged for each query.

Queries are sent to the blocks ``QUERIES`` at a time. Pivots are a bounded sample (the ``PIVOTS`` smallest hashes of ids).

Defined cases: vectors that are null, zero, hold a null or non-finite component, or whose length isn't the most common one (the larger, in
a tie) take no part, nor do rows with a null id; rows with the query's id are the query's own, and are left out before candidates are cut;
rows that share an id are one candidate, which counts by the best of them, and one query, which asks with each and goes by the best; equal
scores go to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, plain, shared_dir, stage

PIVOTS = 512
LISTED = 64
SHARE = 0.2
LEAST = 300
#: Rows in one block of the index, at most.
ROWS = 20_000
QUERIES = 8192
FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The vectors that take part, and their length."""
    v = F.col("embedding")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = plain(vectors, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, odd) & F.exists(v, lambda x: x != 0))
    size = kept.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (kept.where(F.size(v) == size["d"]), size["d"]) if size else (kept, 0)


class PermutationBlock:
    """The inverted files of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, listed: int):
        order = np.argsort(ids, kind="stable")
        again = np.append(False, (ids[order][1:] == ids[order][:-1]) & (vectors[order][1:] == vectors[order][:-1]).all(axis=1))
        order = order[~again]  # a row said twice
        self.ids, self.vectors, self.pivots = ids[order], vectors[order], pivots
        self.listed = min(listed, len(pivots))
        self.first = np.flatnonzero(np.append(True, self.ids[1:] != self.ids[:-1])[: len(self.ids)])  # of each id's rows
        self.repeats = len(self.first) < len(self.ids)
        near = self.nearest(self.vectors)
        flat = near.ravel()
        by = np.argsort(flat, kind="stable")
        self.begin = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
        self.row, self.rank = by // self.listed, by % self.listed

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        return np.argsort(-(vectors @ self.pivots.T), axis=1, kind="stable")[:, : self.listed]

    def candidates(self, order: np.ndarray, share: float, least: int, own: int) -> np.ndarray:
        """Rows of the ids of smallest footrule distance to the pivots in ``order``, ties to smaller ids, without the id ``own``."""
        at = np.concatenate([np.arange(self.begin[p], self.begin[p + 1]) for p in order])
        asked = np.repeat(np.arange(self.listed), self.begin[order + 1] - self.begin[order])
        gain = np.bincount(self.row[at], self.listed - np.maximum(asked, self.rank[at]), len(self.ids))
        ids = self.ids[self.first]
        if self.repeats:
            gain = np.maximum.reduceat(gain, self.first)
        mine = ids == own
        most = max(least, int(np.ceil(share * len(ids))))
        if most >= len(ids) - mine.sum():
            chosen = np.flatnonzero(~mine)
        else:
            gain[mine] = -1
            worst = -np.partition(-gain, most - 1)[most - 1]
            sure = np.flatnonzero(gain > worst)
            chosen = np.concatenate([sure, np.flatnonzero(gain == worst)[: most - len(sure)]])
        if not self.repeats:
            return chosen
        size = np.diff(np.append(self.first, len(self.ids)))[chosen]
        return np.repeat(self.first[chosen] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, share: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out: tuple[list, list, list] = ([], [], [])
        for query, vector, order in zip(ids, vectors, self.nearest(vectors)):
            rows = self.candidates(order, share, least, query)
            score = self.vectors[rows] @ vector
            best = np.lexsort((self.ids[rows], -score))
            if self.repeats:  # an id counts by its best row
                best = best[np.sort(np.unique(self.ids[rows[best]], return_index=True)[1])]
            best = best[:k]
            for x, y in zip(out, (np.full(len(best), query), self.ids[rows[best]], score[best])):
                x.append(y)
        return tuple(np.concatenate(x) if x else np.empty(0) for x in out)


def search(vectors: DataFrame, queries: Column, k: int, pivots: int = PIVOTS, listed: int = LISTED, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that ``queries`` holds for, its ``k`` nearest found by inner product."""
    spark = vectors.sparkSession
    kept, size = usable(vectors)
    made = [r["embedding"] for r in kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("embedding").collect()]
    sent_pivots = spark.sparkContext.broadcast(np.array(made, np.float64).reshape(len(made), size))
    asked = stage(kept.where(queries).distinct(), "queries")
    n = max(1, -(-asked.count() // QUERIES))
    path = f"{shared_dir(spark)}/found-{uuid.uuid4().hex}"
    for i in range(n):
        own = asked if n == 1 else asked.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)) == i)
        rows = own.collect()  # about ``QUERIES``
        sent = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in rows], np.int64), np.array([r["embedding"] for r in rows], np.float64).reshape(len(rows), size)))

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids: list[np.ndarray] = []
            parts: list[np.ndarray] = []

            def ask() -> pa.RecordBatch:
                block = PermutationBlock(np.concatenate(ids), np.concatenate(parts), sent_pivots.value, listed)
                query, vec, score = block.search(*sent.value, k, share, least)
                ids.clear(), parts.clear()
                return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"])

            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    part = batch.slice(a, ROWS)
                    if sum(map(len, ids)) + part.num_rows > ROWS and ids:
                        yield ask()
                    ids.append(part.column("vec_id").to_numpy())
                    parts.append(part.column("embedding").flatten().to_numpy().astype(np.float64).reshape(part.num_rows, size))
            if ids and sum(map(len, ids)):
                yield ask()

        # from each block at most k rows a query
        mapped(kept, look, FOUND).write.mode("append").parquet(path)
    found = spark.read.schema(FOUND).parquet(path).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
