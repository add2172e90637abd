"""What the operators of this subpackage share: tables, the shared folder, staging."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of a table that is broadcast; beyond that it is joined by a shuffle.
BROADCAST = 24 << 20


def importable(spark: SparkSession) -> None:
    """Python functions made from now on in this session import the package from where it is here."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(x for x in (ROOT, environment.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it; a temporary one only where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="driftline-")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stage(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it again: lineage ends there, and every executor sees the files."""
    spark = df.sparkSession
    importable(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Caches that tasks of one operator leave in a worker for each other.
KEPT: list = []


def released(batches: Iterable[pa.RecordBatch], keeps: bool = False) -> Iterator[pa.RecordBatch]:
    """The same batches; at their end the worker, which Spark keeps for other tasks, gives back the memory that it no longer uses. Tasks
    that don't need what others have kept drop it first."""
    if not keeps:
        for cache in KEPT:
            cache.cache_clear()
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
        if trim:
            trim(0)


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keeps: bool = False) -> DataFrame:
    """``mapInArrow``, with the memory given back after each task; ``keeps`` leaves caches for the next."""
    importable(df.sparkSession)  # an operator may be the first of its session, on rows that ``table`` didn't read
    return df.mapInArrow(lambda batches: released(function(batches), keeps), schema)


def few(rows: DataFrame) -> bool:
    """Whether ``rows`` (staged, of plain columns and short keys) take at most ``BROADCAST`` bytes: they are counted, and their width is known."""
    width = 16 + sum(32 if kind in ("string", "binary") else 8 for _, kind in rows.dtypes)
    return rows.count() * width <= BROADCAST


def small(rows: DataFrame) -> DataFrame:
    """``rows`` marked for a broadcast if they are few."""
    return F.broadcast(rows) if few(rows) else rows


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that one slice holds about ``most_bytes`` of text, or a single row."""
    for batch in batches:
        sizes = batch.column(column).nbytes
        rows = batch.num_rows
        if sizes <= most_bytes:
            if rows:
                yield batch
            continue
        import pyarrow.compute as pc

        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(n)
        yield batch.slice(begin)


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, whatever else the table has."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def free(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
