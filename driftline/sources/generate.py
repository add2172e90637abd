"""Deterministic rows: every cell is a function of seed, column and index, so any partition can make any row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import numbered
from ..schema import quoted


def _hash(seed: int, name: str, salt: str = "", *more: Column) -> Column:
    """60 bits of the md5 of all of it, a hash that any other engine has too."""
    said = F.concat_ws("/", F.lit(str(seed)), F.lit(name + salt), F.col("_index").cast("string"), *[m.cast("string") for m in more])
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _unit(seed: int, name: str, salt: str = "") -> Column:
    """Uniform in [0, 1)."""
    return F.pmod(_hash(seed, name, salt), F.lit(1 << 52)) / F.lit(float(1 << 52))


def cell(kind: str, seed: int, name: str, **o) -> Column:
    """One generator: uuid, sequential, pattern, int_range, float_range, decimal_range, duration_range, timestamp_range, timestamp_now, bool, one_of, sample_array, static or null."""
    index, unit = F.col("_index"), _unit(seed, name)
    if kind == "uuid":
        h = F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(name), index.cast("string")))
        return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    if kind == "sequential":
        return (index + o.get("start", 1)).cast("bigint")
    if kind == "pattern":
        made = F.replace(F.lit(o["pattern"]), F.lit("{index}"), index.cast("string"))
        made = F.replace(made, F.lit("{uuid}"), cell("uuid", seed, name))
        # so many random digits, new ones at every place
        for place, n in enumerate(re.findall(r"\{rand:(\d+)\}", o["pattern"])):
            digits = F.regexp_replace(F.concat(*[F.sha2(_hash(seed, name, f"{place}/{i}").cast("string").cast("binary"), 256) for i in range(int(n) // 32 + 1)]), "[a-f]", "7")
            made = F.regexp_replace(made, F.lit(r"^((?:(?!\{rand:).)*)\{rand:" + n + r"\}"), F.concat(F.lit("$1"), F.substring(digits, 1, int(n))))
        return made
    if kind == "int_range":
        return (o["min"] + F.floor(unit * (o["max"] - o["min"] + 1))).cast("bigint")
    if kind == "float_range":
        return o["min"] + unit * (o["max"] - o["min"])
    if kind == "decimal_range":
        return F.round(F.lit(o["min"]) + unit * (o["max"] - o["min"]), o.get("scale", 2)).cast(f"decimal({o.get('precision', 38)},{o.get('scale', 2)})")
    if kind == "duration_range":
        return F.make_dt_interval(secs=(o["min"] + F.floor(unit * (o["max"] - o["min"] + 1))).cast("decimal(18,6)"))
    if kind == "timestamp_range":  # the end is not looked at: a row follows its index from the start on
        return F.timestamp_seconds(F.unix_timestamp(F.lit(o["start"]).cast("timestamp")) + index * o.get("step", 1))
    if kind == "timestamp_now":
        return F.current_timestamp()
    if kind == "bool":
        return unit < o.get("weight", 0.5)
    if kind == "one_of":
        values = o["values"]
        return F.get(F.array(*map(F.lit, values)), F.floor(unit * len(values)).cast("int"))
    if kind == "sample_array":
        values, low, high = o["values"], o.get("min", 0), o["max"]
        size = (low + F.floor(_unit(seed, name, "size") * (high - low + 1))).cast("int")
        pool = F.array(*map(F.lit, values))
        pick = lambda i: F.get(pool, F.pmod(_hash(seed, name, "", i), F.lit(len(values))).cast("int"))
        return F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), pick)).otherwise(F.array().cast("array<string>" if isinstance(values[0], str) else "array<bigint>"))
    if kind == "static":
        return F.lit(o["value"])
    if kind == "null":
        return F.lit(None)
    raise ValueError(f"unknown generator: {kind}")


def generate(spark: SparkSession, rows: int, columns: dict[str, dict], seed: int = 42, partitions: int | None = None, parents: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """``columns``: name to {generator: kind, ...options}. ``parents``: name to a table and its key column; each row draws one of the keys, all alike likely
    (NULL where the table has none). Keys are numbered in their order, and rows joined to them by the number they drew."""
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    base = base.withColumnRenamed("id", "_index")
    made = [cell(o["generator"], seed, name, **{k: v for k, v in o.items() if k != "generator"}).alias(name) for name, o in columns.items()]
    for name, (table, key) in (parents or {}).items():
        keys = numbered(table.select(F.col(quoted(key)).alias(name)).dropna().distinct(), [name], 1).select(name, F.col("row_index").alias(f"_drawn_{name}"))
        drawn = F.pmod(_hash(seed, name), F.greatest(F.lit(keys.count()), F.lit(1)).cast("bigint"))
        base = base.withColumn(f"_drawn_{name}", drawn).join(keys, f"_drawn_{name}", "left")
    return base.select(*made, *map(quoted, parents or {}))


def deal(tables: list[str], containers: int, seed: int = 42) -> list[tuple[int, int, list[str]]]:
    """Tables dealt round to containers: number, seed and tables of each."""
    return [(i, seed + i, tables[i::containers]) for i in range(containers)]
