"""Change logs: the last state of each key, reconciliation with a snapshot, keyset chunks and tails.

A change has ``_op`` (c, u or d), ``_pos`` (any orderable position) and payload columns. Order is always ``_pos``, never arrival.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import partitions, staged


def fold(changes: DataFrame, keys: list[str], order: list[str] = ["_pos"], tombstones: bool = False) -> DataFrame:
    """The last change of each key. Combined in each task before the shuffle, so a key with many changes is no hot group; deleted keys go unless ``tombstones``."""
    rest = [c for c in changes.columns if c not in keys]
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*keys, "_last.*").select(changes.columns)
    return latest if tombstones or "_op" not in rest else latest.where("_op <> 'd'")


def apply(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` after the changes: a create or update replaces the whole row, a delete removes it."""
    payload = [c for c in target.columns if c not in keys]
    last = fold(changes, keys, tombstones=True)
    kept = target.join(last.select(*keys), keys, "left_anti")
    return kept.unionByName(last.where("_op <> 'd'").select(*keys, *payload)).select(target.columns)


def _ranges(rows: DataFrame, position: str) -> DataFrame:
    """``rows`` written once, with the number of the range of positions that each is in; equal positions share one."""
    n = partitions(rows.sparkSession)
    return staged(rows.repartitionByRange(n, position).withColumn("_range", F.spark_partition_id()), "ranges")


def keep_before(changes: DataFrame, keys: list[str], payload: list[str], order: str = "_pos") -> DataFrame:
    """Updates whose after-image has a NULL keep the value before: the last known one since the key's last create or delete.

    Positions are dealt to ranges, so a key's changes are several tasks' work; a row for each key and range says what one range leaves to the next.
    """
    born = F.col("_op").isin("c", "d")
    dealt = _ranges(changes, order)
    lived = dealt.withColumn("_life", F.count_if(born).over(Window.partitionBy(*keys, "_range").orderBy(order)))
    held = [f"_held_{i}" for i in range(len(payload))]
    own = Window.partitionBy(*keys, "_range", "_life").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    lived = lived.withColumns({h: F.last(c, ignorenulls=True).over(own) for h, c in zip(held, payload)})
    left = lived.groupBy(*keys, "_range").agg(F.max("_life").alias("_births"), F.max_by(F.struct(*held), F.col(order)).alias("_left"))
    so_far = Window.partitionBy(*keys).orderBy("_range")
    left = left.withColumn("_era", F.sum("_births").over(so_far))  # the births of a key up to the end of a range
    era = Window.partitionBy(*keys, "_era").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    left = left.select(*keys, "_range", F.struct(*[F.last(f"_left.{h}", ignorenulls=True).over(era).alias(h) for h in held]).alias("_known"))
    came = left.select(*keys, "_range", F.lag("_known").over(so_far).alias("_came"))
    joined = lived.join(came, [*keys, "_range"], "left")
    known = lambda h: F.coalesce(h, F.when(F.col("_life") == 0, F.col(f"_came.{h}")))
    filled = [F.when(F.col("_op") == "u", known(h)).otherwise(F.col(c)).alias(c) for h, c in zip(held, payload)]
    return joined.select(*[c for c in changes.columns if c not in payload], *filled).select(changes.columns)


def reconcile(chunk: DataFrame, log: DataFrame, keys: list[str], low: Column | int, high: Column | int, tombstones: bool = False) -> DataFrame:
    """A chunk read between two marks of the log, and the log: in the window the log wins, before it the chunk, after it the log. With ``tombstones`` deletes stay, and ``_op`` and ``_pos``."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    window = log.where((F.col("_pos") > low) & (F.col("_pos") < high)).select(*keys).distinct()
    survivors = chunk.join(window, keys, "left_anti").withColumns({"_op": F.lit("c"), "_pos": high.cast(dict(log.dtypes)["_pos"]), "_phase": F.lit(1)})
    both = survivors.unionByName(log.withColumn("_phase", F.lit(0)), allowMissingColumns=True)
    folded = fold(both, keys, ["_pos", "_phase"], tombstones).drop("_phase")
    return folded if tombstones else folded.drop("_op", "_pos")


def after(columns: list[str], values: list) -> Column:
    """Rows beyond a key in lexicographic order, spelled so that a scan can be given it: a > x or (a = x and b > y) ..."""
    lit = [v if isinstance(v, Column) else F.lit(v) for v in values]
    terms = [reduce(lambda p, q: p & q, [F.col(c) == v for c, v in zip(columns[:i], lit[:i])], F.col(columns[i]) > lit[i]) for i in range(len(columns))]
    return reduce(lambda p, q: p | q, terms)


def chunk(df: DataFrame, keys: list[str], size: int = 1024, last: list | None = None) -> DataFrame:
    """The next rows in key order; with a limit this is a top-k, not a sort."""
    return (df.where(after(keys, last)) if last else df).orderBy(*keys).limit(size)


def page(df: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(size)


def chunks(df: DataFrame, keys: list[str], size: int, last: list | None = None):
    """Chunk after chunk from a key on, each with its last key; the caller may stop and begin again from any of them."""
    while True:
        rows = chunk(df, keys, size, last)
        end = rows.orderBy(*[F.desc(k) for k in keys]).limit(1).select(*keys).collect()
        if not end:
            return
        last = list(end[0])
        yield rows, last


def numbered(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Each row's chunk number in key order. Rows are dealt by key range, as many as a shuffle has partitions, written once and counted within
    a range; only the counts are summed in one place."""
    n = partitions(df.sparkSession)
    dealt = staged(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_range").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    joined = dealt.withColumn("_row", place).join(F.broadcast(counts.select("_range", "_before")), "_range")  # a row for each range
    row = F.col("_row") + F.col("_before")
    return joined.withColumns({"row_index": row.cast("long"), "chunk_no": F.floor(row / size).cast("long")}).drop("_range", "_row", "_before")


def tail(df: DataFrame, at: str, key: str, since, last, size: int = 100) -> DataFrame:
    """What a polled timestamp shows next: later rows, and those of the same instant with a larger key."""
    return df.where(after([at, key], [since, last])).orderBy(at, key).limit(size)


def between(df: DataFrame, position: str, low, high) -> DataFrame:
    """(low, high]"""
    return df.where((F.col(position) > low) & (F.col(position) <= high))


def until(df: DataFrame, position: str, stop) -> DataFrame:
    return df.where(F.col(position) < stop)


def as_of(events: DataFrame, maps: DataFrame, key: str, position: str, payload: list[str]) -> DataFrame:
    """Each event with the payload of the last map of its key before it.

    Positions are dealt to ranges, so a key with most events is several tasks' work; a row for each key and range says which map comes from those before.
    """
    both = events.withColumn("_map", F.lit(0)).unionByName(maps.select(key, position, F.struct(*payload).alias("_found")).withColumn("_map", F.lit(1)), allowMissingColumns=True)
    dealt = _ranges(both, position)
    last = dealt.groupBy(key, "_range").agg(F.max_by("_found", F.when(F.col("_map") == 1, F.col(position))).alias("_last"))
    came = last.select(key, "_range", F.last("_last", ignorenulls=True).over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_came"))
    before = Window.partitionBy(key, "_range").orderBy(position, F.desc("_map")).rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumn("_here", F.last("_found", ignorenulls=True).over(before)).where("_map = 0").join(came, [key, "_range"], "left")
    return found.withColumn("_found", F.coalesce("_here", "_came")).select(*events.columns, "_found.*")


def pending(requested: DataFrame, covered: DataFrame) -> DataFrame:
    return requested.distinct().join(covered, requested.columns, "left_anti")


def effective(requested: DataFrame, covered: DataFrame) -> DataFrame:
    return requested.unionByName(covered).distinct()


def pruned(covered: DataFrame, requested: DataFrame) -> DataFrame:
    return covered.distinct().join(requested, covered.columns, "left_semi")


def renamed(changes: DataFrame, names: dict[str, str]) -> DataFrame:
    """Changes under their tables' present names."""
    if not names:
        return changes
    mapping = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return changes.withColumn("_table", F.coalesce(F.element_at(mapping, F.col("_table")), F.col("_table")))

