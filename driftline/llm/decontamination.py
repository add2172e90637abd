"""Benchmark decontamination with an FM-index for each training shard.

A shard is a slice of a task's documents. Its words that occur in the benchmark become symbols; runs of such words that are long
enough to hold a window are indexed (a window has no other words, so none is lost), with a separator after each run. Windows are
searched backwards through wavelet-tree ranks, all of them at each step, their occurrences located by sampled suffix
positions, and hit words merged into spans. Documents aren't shuffled, and a shard's memory follows its slice.

The benchmark's windows are made and broadcast in blocks of about ``BLOCK_BYTES`` of text; a shard is searched for every block, and the hits of all
are merged. A worker holds all blocks, some 60 bytes for each word of the benchmark.

Defined cases: a null text has no words; an item without words or with a null id has no windows; items that share an id are one item; ids of
items that aren't whole numbers are texts; an empty table of either kind gives no hits; repeated rows are scanned one by one; a document longer than a
slice is a shard of its own; other columns are not read by ``scan`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, plain, slices
from .fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 4 << 20

HITS = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "stop", "begin", "end")]))

# byte classes of words: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[0x00:0x30] = IS_WORD[0x3A:0x61] = IS_WORD[0x7B:0x80] = False


@dataclass
class Words:
    """Words of several texts: as an Arrow array, the byte each begins at and ends before in its text, and the words before each text."""

    values: pa.Array
    begin: np.ndarray
    end: np.ndarray
    of: np.ndarray


def words(texts: pa.Array) -> Words:
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if n else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    low = LOWER[data]
    inside = IS_WORD[low]
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    begin = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    ends = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(low[inside]))])
    of = np.searchsorted(begin, offsets)
    base = np.repeat(offsets[:-1], np.diff(of)) if n else np.empty(0, np.int64)
    return Words(values, begin - base, end - base, of)


@dataclass
class Block:
    """Distinct windows of some items, over a vocabulary whose words are numbered from 1."""

    vocabulary: pa.Array
    windows: np.ndarray
    lengths: np.ndarray
    begin: np.ndarray  # where each window's items begin, with the end last
    items: list

    @classmethod
    def of(cls, rows: list[tuple[int | str, str | None]], window: int) -> Block:
        found = words(pa.array([t for _, t in rows], pa.string()))
        coded = found.values.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
        by: dict[bytes, set] = {}
        for (item, _), a, b in zip(rows, found.of[:-1], found.of[1:]):
            size = min(window, b - a)
            for i in range(a, b - size + 1) if size and item is not None else ():
                by.setdefault(codes[i : i + size].tobytes(), set()).add(item)
        made = np.zeros((len(by), window), np.int32)
        lengths = np.zeros(len(by), np.int64)
        for k, key in enumerate(by):
            own = np.frombuffer(key, np.int32)
            made[k, : len(own)] = own
            lengths[k] = len(own)
        return cls(coded.dictionary, made, lengths, np.cumsum([0, *map(len, by.values())]), [x for v in by.values() for x in sorted(v)])


def search(found: Words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of a block's windows in a shard: the word each begins at, and its window."""
    none = np.empty(0, np.int64)
    if not len(block.lengths) or not len(found.values):
        return none, none
    codes = pc.fill_null(pc.index_in(found.values, value_set=block.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    known = codes > 0
    opens = known & ~np.concatenate([[False], known[:-1]])
    text_starts = found.of[:-1][found.of[:-1] < len(codes)]
    opens[text_starts] = known[text_starts]
    run = np.cumsum(opens) - 1
    where = np.flatnonzero(known)
    if not len(where):
        return none, none
    size = np.bincount(run[where])
    where = where[size[run[where]] >= block.lengths.min()]
    if not len(where):
        return none, none
    last = np.append(run[where][1:] != run[where][:-1], True)
    at = np.arange(len(where)) + np.concatenate([[0], np.cumsum(last)[:-1]])
    separator = len(block.vocabulary) + 1
    text = np.full(len(where) + int(last.sum()), separator, np.int64)
    word = np.full(len(text), -1, np.int64)
    text[at], word[at] = codes[where], where
    here = np.zeros(separator + 1, bool)
    here[text] = True
    here[0] = True  # what fills up short windows
    live = np.flatnonzero(here[block.windows].all(axis=1))
    if not len(live):
        return none, none
    index = FMIndex(text, separator)
    low, high = index.search(block.windows[live], block.lengths[live])
    count = high - low
    rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return word[index.locate(rows)], np.repeat(live, count)


def spans(found: Words, begin: np.ndarray, size: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """By text, the merged hits (first word, word after the last, first byte, byte after the last) of occurrences of so many words."""
    n = len(found.begin)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + size, -1)
    hit = np.cumsum(change[:-1]) > 0
    first = hit & ~np.concatenate([[False], hit[:-1]]) if n else hit
    stop = hit & ~np.concatenate([hit[1:], [False]]) if n else hit
    starts = found.of[:-1][found.of[:-1] < n]
    first[starts] = hit[starts]
    ends = found.of[1:][found.of[1:] > 0] - 1
    stop[ends] = hit[ends]
    firsts, stops = np.flatnonzero(first), np.flatnonzero(stop)
    doc_of_hit = np.searchsorted(found.of, firsts, side="right") - 1
    out: dict[int, list] = {}
    for d, a, b in zip(doc_of_hit.tolist(), firsts.tolist(), stops.tolist()):
        base = int(found.of[d])
        out.setdefault(d, []).append((a - base, b + 1 - base, int(found.begin[a]), int(found.end[b])))
    return out


def scan_shard(texts: pa.Array, blocks: list[Block]) -> list[tuple[int, list[tuple[int, int, int, int]], list]]:
    """For each text: number of words, merged hits (first word, word after the last, first byte, byte after the last) and items."""
    found = words(texts)
    begins, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    items: dict[int, set] = {}
    for block in blocks:
        begin, window = search(found, block)
        begins.append(begin)
        sizes.append(block.lengths[window])
        if len(begin):
            both = np.unique(np.stack([np.searchsorted(found.of, begin, side="right") - 1, window]), axis=1)
            for d, w in both.T.tolist():
                items.setdefault(d, set()).update(block.items[block.begin[w] : block.begin[w + 1]])
    hits = spans(found, np.concatenate(begins), np.concatenate(sizes))
    return [(int(b - a), hits.get(d, []), sorted(items.get(d, ()))) for d, (a, b) in enumerate(zip(found.of[:-1], found.of[1:]))]


def item_type(benchmark: DataFrame) -> str:
    return "bigint" if dict(benchmark.dtypes)["item_id"] in ("tinyint", "smallint", "int", "bigint") else "string"


def blocks(benchmark: DataFrame, window: int) -> Iterator[Block]:
    """The benchmark's windows, block by block; never more than one block's text is with the driver."""
    items = plain(benchmark, "item_id", "text").withColumn("item_id", F.col("item_id").cast(item_type(benchmark)))
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Block.of([(r["item_id"], r["text"]) for r in own.collect()], window)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (array of item_id, ascending) and hits, for every document."""
    sent = [docs.sparkSession.sparkContext.broadcast(block) for block in blocks(benchmark, window)]
    kind = item_type(benchmark)
    item = pa.int64() if kind == "bigint" else pa.string()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            out = scan_shard(batch.column("text"), [x.value for x in sent])
            hits = pa.array([[dict(zip(("first", "stop", "begin", "end"), h)) for h in x[1]] for x in out], HITS)
            n_hit = pa.array([sum(h[1] - h[0] for h in x[1]) for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), n_hit, pa.array([x[2] for x in out], pa.list_(item)), hits], ["doc_id", "n_words", "n_hit", "items", "hits"])

    return mapped(plain(docs, "doc_id", "text"), find, f"doc_id bigint, n_words bigint, n_hit bigint, items array<{kind}>, hits array<struct<first:bigint,stop:bigint,begin:bigint,end:bigint>>")


def digest(scanned: DataFrame) -> DataFrame:
    listed = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return scanned.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with hit words, and what stands between them in a span, cut from ``text``; all columns are kept, and a document of which
    nothing but white space remains goes. The windows of all blocks are searched in the text as it was, and their spans merged, before it
    is cut, so the result doesn't depend on ``BLOCK_BYTES``. A worker holds the windows of every block, without their items."""
    sent = [docs.sparkSession.sparkContext.broadcast(replace(block, begin=np.empty(0, np.int64), items=[])) for block in blocks(benchmark, window)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            keep = np.ones(len(texts), bool)
            found = words(batch.column(at))
            begin, size = [], []
            for block in sent:
                where, which = search(found, block.value)
                begin.append(where)
                size.append(block.value.lengths[which])
            for i, hits in spans(found, np.concatenate(begin), np.concatenate(size)).items():
                raw, parts, done = texts[i].encode(), [], 0
                for _, _, a, b in hits:
                    parts.append(raw[done:a])
                    done = b
                texts[i] = b"".join([*parts, raw[done:]]).decode()
                keep[i] = bool(texts[i].strip())
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).filter(pa.array(keep))

    return mapped(docs, cut, docs.schema)

