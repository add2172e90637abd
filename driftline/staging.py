"""Tables written once into the folder that driver and executors share, and read again: lineage ends there, and what depended on chance is fixed."""

from __future__ import annotations

import math
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers of a session that was begun elsewhere import this package from where it lies; on a cluster it is shipped or installed."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(x for x in (ROOT, environment.get("PYTHONPATH")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a temporary folder only where it is unset and the session is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="driftline-")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has, as the session says; given as a number, they aren't coalesced."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that a task is dealt. Up to ``UNHELD`` partitions a shuffle's writers hold no rows in memory, so beyond that many a task first gets ``MOST`` rows.
ROWS, MOST, UNHELD = 500_000, 2_000_000, 200


def spread(rows: DataFrame, columns: list[str], count: int) -> DataFrame:
    """``rows``, about ``count`` of them, dealt by ``columns`` to as many partitions as they need, so that what a task holds doesn't grow with the table. What is
    grouped or joined by these columns then takes no other shuffle, and no task groups a whole split of a file beforehand."""
    spark = rows.sparkSession
    least = min(partitions(spark), spark.sparkContext.defaultParallelism)
    return rows.repartition(max(1, least, min(UNHELD, math.ceil(count / ROWS)), math.ceil(count / MOST)), *columns)
