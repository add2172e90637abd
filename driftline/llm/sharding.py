"""Extendible hashing: shards are hash prefixes, each as short as keeps it within a byte limit.

The directory begins with no bits; a bucket over the limit splits on its next bit, other buckets don't. Sizes are summed by cells (long
prefixes) first, so documents are read once for the sizes, and the splitting works on cells: a cell's shard is its shortest prefix
that fits. Only documents of cells that are still too large are summed by longer prefixes.

Defined cases: a bucket of one document over the limit stays as it is and is marked ``oversized``; documents that share all bits (one doc_id
many times) and are together too large go to overflow pages, each within the limit; null texts count no bytes; null doc_ids hash as an empty string; an empty
table has no shards; repeated rows are rows of their own; other columns are not read by ``shards``, and ``write`` keeps every row and column, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import plain, stage

#: Bits of the hash that the directory can use.
BITS = 60
#: Bits by which one round of sums goes deeper.
STEP = 20


def key_hash(c: Column) -> Column:
    """The first 60 bits of the md5 of the value's text."""
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    return F.call_function("shiftright", h, (F.lit(BITS) - (F.lit(depth) if isinstance(depth, int) else depth)).cast("int"))


def directory(sized: DataFrame, limit: int) -> DataFrame:
    """shard_id, depth, prefix, n_docs, n_bytes of every shard of ``sized(h, bytes)``. ``shard_id`` is the prefix behind a leading 1."""
    found = None
    open_, low = sized, 0
    while True:
        deep = min(BITS, low + STEP)
        cells = stage(open_.groupBy(_prefix(F.col("h"), deep).alias("cell")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")), "cells")
        depths = cells.select("cell", "b", "n", F.explode(F.sequence(F.lit(low), F.lit(deep))).alias("depth"))
        prefix = F.expr(f"shiftright(cell, {deep} - depth)")
        buckets = depths.groupBy("depth", prefix.alias("prefix")).agg(F.sum("b").alias("n_bytes"), F.sum("n").alias("n_docs"))
        fits = (F.col("n_bytes") <= limit) | (F.col("n_docs") == 1) | (F.col("depth") == BITS)
        fitting = stage(buckets.withColumn("fits", fits), "buckets")
        # a bucket is a shard if it fits and the one a bit shorter doesn't
        above = fitting.where(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        own = fitting.where("fits").withColumn("up", F.expr("shiftright(prefix, 1)"))
        made = own.where(F.col("depth") > low).join(above, ["depth", "up"], "left_semi").unionByName(own.where(F.col("depth") == low))
        made = made.select("depth", "prefix", "n_docs", "n_bytes")
        found = made if found is None else found.unionByName(made)
        large = fitting.where((F.col("depth") == deep) & ~F.col("fits")).select(F.col("prefix").alias("cell"))
        if deep == BITS or large.isEmpty():
            break
        open_ = open_.withColumn("cell", _prefix(F.col("h"), deep)).join(large, "cell", "left_semi").drop("cell")
        # the next round begins one bit deeper, below buckets that are known not to fit
        low = deep + 1
    return found.select((F.expr("shiftleft(1L, depth)") + F.col("prefix")).alias("shard_id"), "depth", "prefix", "n_docs", "n_bytes")


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """doc_id, shard_id, depth, page, n_bytes (of the document) and oversized, for every document."""
    return _placed(plain(docs, "doc_id", "text").select("doc_id", *_sized()), limit)


def _sized() -> list[Column]:
    return [key_hash(F.col("doc_id")).alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")]


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """The columns of ``rows`` but h and bytes, and where each row goes.

    Each cell of ``STEP`` bits that lies in one shard is joined with it first, and rows with their cell; only rows of cells that
    several shards divide are tried with every longer prefix in use.
    """
    own = [c for c in rows.columns if c not in ("h", "bytes")]
    rows = stage(rows.withColumn("cell", _prefix(F.col("h"), STEP)), "sized")
    shard = stage(directory(rows, limit), "directory").withColumnRenamed("n_bytes", "shard_bytes")
    depths = [r["depth"] for r in shard.select("depth").distinct().collect()]  # at most one for each bit
    tried = lambda df, ds: df.withColumn("depth", F.explode(F.array(*map(F.lit, ds)).cast("array<int>")))
    cells = tried(rows.select("cell").distinct(), [d for d in depths if d <= STEP]).withColumn("prefix", F.expr(f"shiftright(cell, {STEP} - depth)"))
    cells = stage(cells.join(shard, ["depth", "prefix"]).drop("prefix"), "cells-of-shards")
    placed = rows.join(cells, "cell")
    if deep := [d for d in depths if d > STEP]:
        rest = tried(rows.join(cells, "cell", "left_anti"), deep).withColumn("prefix", F.expr(f"shiftright(h, {BITS} - depth)"))
        placed = placed.unionByName(rest.join(shard, ["depth", "prefix"]).drop("prefix"))
    spilled = (F.col("shard_bytes") > limit) & (F.col("n_docs") > 1)
    whole = placed.where(~spilled).select(*own, "shard_id", "depth", F.lit(0).cast("long").alias("page"), F.col("bytes").alias("n_bytes"), (F.col("shard_bytes") > limit).alias("oversized"))
    return whole.unionByName(_pages(placed.where(spilled).select(*own, "shard_id", "depth", "bytes"), limit, own))


def _pages(rows: DataFrame, limit: int, own: list[str]) -> DataFrame:
    """Pages of buckets that no bit splits. Documents of one power of two of bytes share pages of so many as surely fit; ranks are
    counted in each task and moved up by the tasks before, so no bucket is gathered."""
    kind = F.ceil(F.log2(F.greatest(F.col("bytes"), F.lit(1)))).cast("int")
    rows = stage(rows.withColumn("kind", kind).withColumn("part", F.spark_partition_id()), "overflow")
    key = ["shard_id", "kind"]
    counts = rows.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "part").orderBy(*own, "bytes")) - 1).join(before, [*key, "part"])
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.pow(F.lit(2), F.col("kind")))).cast("long")
    page = (F.floor((F.col("rank") + F.col("before")) / fit) * 64 + F.col("kind") + 1).cast("long")
    return ranked.select(*own, "shard_id", "depth", page.alias("page"), F.col("bytes").alias("n_bytes"), (F.col("bytes") > limit).alias("oversized"))


def write(docs: DataFrame, path: str, limit: int) -> None:
    """Writes every row as one folder for each shard and page; the folders' columns get an underscore before their name for each time that a column has it."""
    names = {}
    for name in ("row", "shard_id", "page"):
        names[name] = name
        while names[name] in (*docs.columns, *[v for k, v in names.items() if k != name]):
            names[name] = f"_{names[name]}"
    # rows are numbered once: a doc_id may be null or come again
    numbered = stage(docs.withColumn(names["row"], F.monotonically_increasing_id()), "numbered")
    placed = _placed(numbered.select(F.col(names["row"]).alias("row"), *_sized()), limit)
    placed = placed.select(F.col("row").alias(names["row"]), F.col("shard_id").alias(names["shard_id"]), F.col("page").alias(names["page"]))
    dealt = numbered.join(placed, names["row"]).drop(names["row"])
    folders = [names["shard_id"], names["page"]]
    dealt.repartition(*folders).write.partitionBy(*folders).parquet(path)


def sql(limit: int) -> str:
    """``shards`` as DuckDB SQL, for tables whose doc_ids differ."""
    return f"""
    WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS b, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS // 4}))::BIGINT AS h FROM documents),
    c AS (SELECT k AS depth, h >> ({BITS} - k) AS p, sum(b) AS bytes, count(*) AS n FROM d, (SELECT unnest(range(0, {BITS} + 1)) AS k) GROUP BY 1, 2),
    f AS (SELECT d.doc_id, min(c.depth) AS depth FROM d JOIN c ON c.p = d.h >> ({BITS} - c.depth) WHERE c.bytes <= {limit} OR c.n = 1 GROUP BY 1)
    SELECT d.doc_id, (CAST(1 AS BIGINT) << f.depth) + (d.h >> ({BITS} - f.depth)) AS shard_id, CAST(f.depth AS INT) AS depth, CAST(0 AS BIGINT) AS page, CAST(d.b AS BIGINT) AS n_bytes, d.b > {limit} AS oversized
    FROM d JOIN f USING (doc_id)"""
