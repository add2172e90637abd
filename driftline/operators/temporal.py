"""System-versioned tables: versions of current and history rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import content_hash
from ..staging import partitions, spread, staged


def open_period(end: Column) -> Column:
    """Whether a period's end is the sentinel of a row that still holds."""
    return F.year(end) >= 9999


def union_versions(current: DataFrame, history: DataFrame) -> DataFrame:
    return current.withColumn("is_current", F.lit(True)).unionByName(history.withColumn("is_current", F.lit(False)), allowMissingColumns=True)


def version_ids(versions: DataFrame, keys: list[str], start: str, end: str, content: dict[str, Column], scan_order: list[Column], ordinal: bool = True) -> DataFrame:
    """``version_hash``, ``duplicate`` (0, 1, ... for versions alike in key, period and content, in scan order; 0 where ``ordinal`` is off) and ``version_id``."""
    digest = content_hash(content)
    rows = _ordinals(versions, digest, [*keys, start, end, "version_hash"], scan_order) if ordinal else versions.withColumns({"version_hash": digest, "duplicate": F.lit(0).cast("long")})
    return rows.withColumn("version_id", F.array(*[F.col(c).cast("string") for c in (*keys, start, end, "version_hash", "duplicate")]))


def _ordinals(versions: DataFrame, digest: Column, alike: list[str], scan_order: list[Column]) -> DataFrame:
    """``version_hash`` and ``duplicate``, a row's place among those alike. Rows are dealt to ranges of the scan order, once, and numbered within each, after a row that says
    how many came in the ranges before; so a version that comes again and again is several tasks' work. Rows equal in the scan order share a range."""
    ranged = versions.repartitionByRange(partitions(versions.sparkSession), *scan_order)  # what is sampled for the ranges has no hash yet
    dealt = staged(ranged.withColumns({"_range": F.spark_partition_id(), "version_hash": digest}), "versions")
    size, here = dealt.count(), [*alike, "_range"]
    counts = spread(dealt.select(here), here, size).groupBy(*here).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*alike).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = spread(counts, alike, size).withColumn("_before", F.sum("_n").over(earlier)).where("_before > 0").drop("_n")
    both = spread(dealt.unionByName(before.withColumn("_told", F.lit(True)), allowMissingColumns=True), here, size)
    own = Window.partitionBy(*alike, "_range").orderBy(F.col("_told").isNull(), *scan_order)
    told = F.first("_before").over(own.rowsBetween(Window.unboundedPreceding, 0))
    numbered = both.withColumn("duplicate", F.row_number().over(own) - 1 + F.coalesce(told - 1, F.lit(0)))
    return numbered.where("_told IS NULL").drop("_told", "_before", "_range")
