"""Chunks of a snapshot that are read side by side: bounds by sampling, and a log reconciled with all chunks at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import fold

#: Bounds that are sent along with an expression at most, and rows sampled for each.
MOST, SAMPLED = 10_000, 20


def bounds(df: DataFrame, keys: list[str], chunks: int) -> list[list]:
    """Keys that cut ``df`` into about ``chunks`` parts of equal size; as many rows are looked at on the driver as ``SAMPLED`` times the chunks, with some
    to spare. Chunks differ in size by chance, which changes no result."""
    if not 1 <= chunks <= MOST:
        raise ValueError(f"chunks: 1 to {MOST}")
    rows = df.count()
    share = min(1.0, SAMPLED * chunks / max(1, rows))
    drawn = sorted(map(list, df.select(*keys).dropna().sample(share, 7).limit(2 * SAMPLED * chunks).collect()))
    cuts = [drawn[i * len(drawn) // chunks] for i in range(1, chunks)] if drawn else []
    return [b for i, b in enumerate(cuts) if i == 0 or b != cuts[i - 1]]


def chunk_of(keys: list[str], bounds: list[list], like: DataFrame) -> Column:
    """The number of the chunk that a row is in: how many bounds its key has reached. A binary search in one sorted array of ``MOST`` bounds at most; keys with
    a null are in the first chunk."""
    if not bounds:
        return F.lit(0)
    kinds = dict(like.dtypes)
    cell = lambda b: F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(keys, b)])
    held = F.array(*[cell(b) for b in bounds])
    own = F.struct(*[F.col(k) for k in keys])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        return F.when(at["lo"] >= at["hi"], at).when(own >= F.get(held, mid), F.struct((mid + 1).alias("lo"), at["hi"].alias("hi"))).otherwise(F.struct(at["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(math.ceil(math.log2(len(bounds) + 1)) + 1)), start, halve)["lo"]


def reconcile_chunks(rows: DataFrame, log: DataFrame, keys: list[str], bounds: list[list], marks: DataFrame, tombstones: bool = False) -> DataFrame:
    """``rows`` with ``_chunk``, each chunk read between marks of its own (``_chunk, _low, _high``), and the log: within a chunk's window the log wins,
    before it the chunk, after it the log, as ``reconcile`` does chunk by chunk. One row for each chunk is broadcast."""
    own = F.broadcast(marks)
    in_window = log.withColumn("_chunk", chunk_of(keys, bounds, rows)).join(own, "_chunk").where((F.col("_pos") > F.col("_low")) & (F.col("_pos") < F.col("_high"))).select(*keys).distinct()
    kind = dict(log.dtypes)["_pos"]
    survivors = rows.join(in_window, keys, "left_anti").join(own, "_chunk").withColumns({"_op": F.lit("c"), "_pos": F.col("_high").cast(kind), "_phase": F.lit(1)}).drop("_chunk", "_low", "_high")
    both = survivors.unionByName(log.withColumn("_phase", F.lit(0)), allowMissingColumns=True)
    folded = fold(both, keys, ["_pos", "_phase"], tombstones).drop("_phase")
    return folded if tombstones else folded.drop("_op", "_pos")
