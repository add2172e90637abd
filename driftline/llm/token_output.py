"""Token-ID output: documents in ascending doc_id order, as segments of interleaved rANS blocks (see ``rans``).

Format, a Parquet table with a row for each segment: ``shard`` and ``segment`` (together in doc_id order), ``doc_ids`` and
``lengths`` of its whole documents, the packed frequency ``table`` and the ``blocks``. A shard is a range of (doc_id, hash of the text).

Defined cases: a null text is empty, and an empty text is its end id alone; rows with equal doc_id follow one another,
ordered by hash of the text and text, so many of them are several shards; a null doc_id comes first; a very long text is a segment of its own; an
empty table gives an empty output; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rans
from .common import mapped, plain, shared_dir, slices, stage
from .tokenizing import AT_ONCE, encoder, with_end

#: Bytes of text in a shard, on average; one task sorts and encodes a shard.
SHARD_BYTES = 16 << 20
#: Ids after which a segment ends with the document at hand.
SEGMENT_IDS = 3 << 20

POINT = pa.struct([("step", pa.int32()), ("word", pa.int64()), ("states", pa.binary())])
BLOCK = pa.struct([("n", pa.int32()), ("crcs", pa.list_(pa.int64())), ("states", pa.binary()), ("words", pa.binary()), ("points", pa.list_(POINT))])
FORMAT = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("table", pa.binary()), ("blocks", pa.list_(BLOCK))])
POINT_DDL = "struct<step:int,word:bigint,states:binary>"
FORMAT_DDL = f"shard int, segment int, doc_ids array<bigint>, lengths array<bigint>, table binary, blocks array<struct<n:int,crcs:array<bigint>,states:binary,words:binary,points:array<{POINT_DDL}>>>"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Tokenizes, orders and encodes ``docs(doc_id, text)`` into ``path``."""
    docs = plain(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text"))
    n = max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    ordered = docs.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        shard, segment = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        ids_of: list = []
        lengths: list[int] = []
        count = 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, held, ids_of, lengths, count
            table, blocks = rans.encode(np.concatenate(held))
            row = {"shard": shard, "segment": segment, "doc_ids": ids_of, "lengths": lengths, "table": table, "blocks": blocks}
            segment, held, ids_of, lengths, count = segment + 1, [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=FORMAT)

        for batch in slices(batches, "text", AT_ONCE):
            ids, bounds = with_end(*enc.encode(batch.column("text")), end_id)
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = ids[bounds[i] : bounds[i + 1]]
                held.append(own)
                ids_of.append(doc)
                lengths.append(len(own))
                count += len(own)
                if count >= SEGMENT_IDS:
                    yield flush()
        if ids_of:
            yield flush()

    mapped(ordered, encode, FORMAT_DDL, keeps=True).write.option("compression", "none").parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``base``, the ids of all segments before."""
    segments = spark.read.schema(FORMAT_DDL).parquet(path)
    totals = segments.select("shard", "segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))
    before = lambda w: F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each shard in one order, then the segments of each shard
    shards = totals.groupBy("shard").agg(F.sum("total").alias("total")).select("shard", before(Window.orderBy("shard")).alias("of_shards"))
    own = totals.withColumn("in_shard", before(Window.partitionBy("shard").orderBy("segment")))
    # written, so that the join knows its size and broadcasts it only below Spark's threshold
    base = stage(own.join(shards, "shard").select("shard", "segment", (F.col("of_shards") + F.col("in_shard")).alias("base")), "token-ids-base")
    return segments.join(base, ["shard", "segment"])


DECODED = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def _decoded(doc_ids: list, begins: np.ndarray, ends: np.ndarray, base: int, parts: list[np.ndarray]) -> pa.RecordBatch:
    raw = [np.ascontiguousarray(p, "<u4").tobytes() for p in parts]
    columns = [pa.array(doc_ids, pa.int64()), pa.array(begins + base, pa.int64()), pa.array(ends - begins, pa.int64()), pa.array(list(map(zlib.crc32, raw)), pa.int64()), pa.array(raw, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decodes ``path``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids as little-endian unsigned 32-bit bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = rans.decode(row["table"], row["blocks"])
                ends = np.cumsum(np.asarray(row["lengths"], np.int64))
                begins = ends - np.asarray(row["lengths"], np.int64)
                yield _decoded(row["doc_ids"], begins, ends, row["base"], [ids[a:b] for a, b in zip(begins, ends)])

    return mapped(_segments(spark, path), decode, DECODED)


def find(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """What ``read`` gives for the documents of ``wanted(doc_id)`` alone, decoded from the checkpoints before them."""
    segments = _segments(spark, path)
    held = segments.select("shard", "segment", F.posexplode("doc_ids").alias("at", "doc_id"))
    chosen = held.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("shard", "segment").agg(F.sort_array(F.collect_list("at")).alias("chosen"))  # places in one segment

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                reader = rans.Reader(row["table"], row["blocks"])
                ends = np.cumsum(np.asarray(row["lengths"], np.int64))[row["chosen"]]
                begins = ends - np.asarray(row["lengths"], np.int64)[row["chosen"]]
                yield _decoded([row["doc_ids"][k] for k in row["chosen"]], begins, ends, row["base"], [reader.ids(a, b) for a, b in zip(begins.tolist(), ends.tolist())])

    return mapped(segments.join(chosen, ["shard", "segment"]), decode, DECODED)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, path, tokenizer, end_id, shard_bytes)
    return read(spark, path)
