"""Near duplicates by min-max hashing: of every permutation of the shingles both the smallest and the largest of a set are kept.

Each agrees between two sets with the probability of their Jaccard similarity, so that half as many permutations fill a signature; and as the two ends of one
permutation are never the same shingle in sets of two or more, they are met without putting back, and the share of agreeing values varies less than
that of as many independent minima. A band takes ``ROWS`` values, both ends of three permutations; two sets of a similarity of 0.85 agree in none of the 32
bands with a probability of 3e-7.

Documents with equal shingle sets form a class. Classes that share a band are candidates. In each bucket all are verified on whole sets against one of them, which
connects most; members of buckets that the components found so far leave apart are then compared in bounded blocks. So a bucket of any size is taken
whole, and no pairs are made of what is connected anyway.

Defined cases: null and empty texts, and texts without words, have no shingles and link with nothing; so does a null doc_id, whose component is null
and which isn't kept; rows with one doc_id are one node; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, plain, slices, stage
from .jaccard_join import SIGNATURES, _digest, across, by_class, verify
from .shingling import shingle_sets

#: Permutations, and values in a band.
PERMUTATIONS, ROWS = 96, 6
C, S31 = np.uint64(0xD6E8FEB86659FD93), np.uint64(31)


def permutations(count: int = PERMUTATIONS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands: x -> a * x + b permutes the 64-bit numbers if a is odd."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 64, (2, count), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def ends(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each set (none is empty) the smallest and largest value under each permutation, side by side."""
    flat = np.concatenate(sets).view(np.uint64)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * len(a)), np.uint64)
    for i in range(len(a)):
        values = flat * a[i] + b[i]
        out[:, 2 * i] = np.minimum.reduceat(values, begin)
        out[:, 2 * i + 1] = np.maximum.reduceat(values, begin)
    return out


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """An unbiased estimate of two sets' Jaccard similarity from their ends."""
    return float(np.mean(x == y))


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of each ``rows`` neighbouring values and of the band's number."""
    parts = values.reshape(len(values), -1, rows)
    out = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        out = (out ^ parts[:, :, i]) * C
        out ^= out >> S31
    return out.view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """For each document its set's size and digest, and ``low``, its bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations()
        per = 2 * PERMUTATIONS // ROWS
        for batch in slices(batches, "text"):
            sets = list(shingle_sets(batch.column("text"), k))
            sizes = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            flat = bands(ends(full, a, b)).ravel() if full else np.empty(0, np.int64)
            low = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((sizes > 0) * per)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array([_digest(s) for s in sets], pa.binary()), low], ["doc_id", "n", "set_key", "low"])

    return mapped(docs, sign, SIGNATURES)


def linked(classes: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between classes that share a band, enough of them to connect every component."""
    posts = classes.select("cid", "n", F.explode("low").alias("token"))
    # combined in each task, so that a bucket of most classes is no hot key
    buckets = posts.groupBy("token").agg(F.min("cid").alias("centre"), F.max("cid").alias("other")).where("centre < other").select("token", "centre")
    shared = stage(posts.join(buckets, "token"), "buckets")
    star = shared.where("cid > centre").select(F.col("centre").alias("a"), F.col("cid").alias("b")).distinct()
    first = stage(verify(star, docs, k, num, den), "links")
    lists = shared.groupBy("cid", "n").agg(F.collect_set("token").alias("hot"))  # at most one for each band
    return first.union(across(shared.select("token", "cid", "n"), lists, first, docs, k, num, den))


def near_copies(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document; two link when den * intersection >= num * union."""
    docs = plain(docs, "doc_id", "text")
    found = by_class(stage(signatures(docs, k), "signatures"), lambda classes: linked(classes, docs, k, num, den))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def sql(k: int, num: int, den: int, kept: bool) -> str:
    """Components of all links, by comparing all pairs that share a shingle."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    with recursive words as (select doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') as w from documents),
    sets as (select doc_id, case when len(w) = 0 then [] when len(w) < {k} then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) end as s from words),
    sized as (select doc_id, len(s) as n from sets),
    held as (select doc_id, n, unnest(s) as t from sets join sized using (doc_id)),
    links as (select a.doc_id as x, b.doc_id as y from held a join held b on a.t = b.t and a.doc_id < b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n having {den} * count(*) >= {num} * (a.n + b.n - count(*))),
    both_ways as (select x, y from links union all select y, x from links),
    reached(doc_id, label) as (select doc_id, doc_id from sized union select e.y, r.label from reached r join both_ways e on e.x = r.doc_id)
    select s.doc_id, s.n::bigint as n_shingles, min(r.label) as component_id{", s.doc_id = min(r.label) as kept" if kept else ""}
    from sized s join reached r on r.doc_id = s.doc_id group by s.doc_id, s.n"""
