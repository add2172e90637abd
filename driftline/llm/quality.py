"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are a text's words, hashed, and what its shape shows in any language: n-grams of byte classes (capitals, small letters, other letters,
digits, each white space and punctuation mark by itself), and how words repeat and how long they are. Weighted by log frequency and inverse
document frequency and reduced by a truncated singular value decomposition, a bounded sample of labelled documents becomes latent vectors,
which are broadcast. Every document's vector is compared with all of them by exact cosine products, a block at a time, and its nearest
``NEIGHBOURS`` vote for their labels, weighted by similarity and by how many labelled documents one of the sample stands for.

Defined cases: null and empty texts have no terms and get the share of label 1 among all labelled; a text counts whole, however long; without labelled
documents of both kinds, as with an empty table, all scores are 0.5; a document that is labelled both 0 and 1 counts as 1; rows are scored one by one, so
repeated rows score alike; ties between neighbours go to the smaller id hash; other columns are not read by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, plain, slices
from .toxicity import sample

#: Labelled documents that are learned from, at most, for each label: those of the smallest id hashes.
SAMPLE = 3000
SHAPES = 4096
#: Hashed words, and what all of a text's words weigh beside its shape.
WORDS, WORD_SHARE = 1024, 0.3
DIMENSIONS = 64
NEIGHBOURS = 21
#: Cosine products made at once.
DOCS = 256

# byte classes: 0 ends a document; letters by case, bytes of other scripts, digits; then each white space and mark by itself
CLASS = np.full(256, 3, np.uint32)
CLASS[ord("a") : ord("z") + 1], CLASS[ord("A") : ord("Z") + 1], CLASS[ord("0") : ord("9") + 1] = 1, 2, 4
for _i, _b in enumerate(b for b in range(128) if not chr(b).isalnum()):
    CLASS[_b] = 5 + _i
REPEATS, SPREAD, LENGTHS = 16, 16, 32
FORMS = SHAPES + REPEATS + SPREAD + LENGTHS
TERMS = FORMS + WORDS


def counts(text: bytes) -> np.ndarray:
    """How often each term occurs in a whole text; of words, how many distinct ones."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    c = CLASS[np.frombuffer(text, np.uint8)]
    # runs of one class count as one or as many, so long words don't hide marks
    new = np.concatenate([[True], c[1:] != c[:-1]])
    at = np.flatnonzero(new)
    size = np.minimum(3, np.diff(np.append(at, len(c)))).astype(np.uint32)
    r = c[at] * 4 + size
    h = r * np.uint32(2654435761)
    for n in (1, 2, 3):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(2246822519) + r[n - 1 :] * np.uint32(3266489917)
        if len(h):
            mixed = (h ^ (h >> np.uint32(16))) * np.uint32(668265263) + np.uint32(n)
            out[:SHAPES] += np.bincount((mixed >> np.uint32(12)) % np.uint32(SHAPES), minlength=SHAPES).astype(np.float32)
    words = text.split()
    if words:
        n = len(words)
        same = sum(map(eq, words, islice(words, 1, None)))
        known = set(words)
        distinct = len(known)
        # the share of words like the one before, and of distinct words among all, each as one of a few terms that long texts count more often
        out[SHAPES + min(REPEATS - 1, same * REPEATS // n)] += n
        out[SHAPES + REPEATS + min(SPREAD - 1, distinct * SPREAD // n)] += n
        out[SHAPES + REPEATS + SPREAD : FORMS] += np.bincount(np.minimum(LENGTHS - 1, np.fromiter(map(len, words), np.int64, n)), minlength=LENGTHS)
        out[FORMS:] += np.bincount(np.fromiter(map(crc32, known), np.int64, distinct) % WORDS, minlength=WORDS)
    return out


def rows_of(texts: pa.Array) -> np.ndarray:
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    return np.stack([counts(t) for t in texts.to_pylist()]) if len(texts) else np.empty((0, TERMS), np.float32)


@dataclass
class Space:
    """The labelled vectors, and how a document's term counts become a vector."""

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    each: np.ndarray
    prior: float

    @classmethod
    def fit(cls, rows: np.ndarray, labels: np.ndarray, each: np.ndarray) -> Space:
        """From term counts, which are weighted in place: there is one dense matrix of the sample."""
        known = np.count_nonzero(rows, axis=0)
        weight = (np.log((1 + len(rows)) / (1 + known)) + 1).astype(np.float32)
        x = rows
        for a in range(0, len(x), DOCS):
            x[a : a + DOCS] = cls.weighted(x[a : a + DOCS], weight)
        # randomized range finder: a few products with the sample, no square matrix of terms
        k = min(DIMENSIONS, *x.shape)
        y = x @ np.random.default_rng(0).standard_normal((x.shape[1], k + 16)).astype(np.float32)
        for _ in range(3):
            q, _ = np.linalg.qr(y)
            y = x @ (x.T @ q)
        q, _ = np.linalg.qr(y)
        _, _, v = np.linalg.svd(q.T @ x, full_matrices=False)
        basis = np.ascontiguousarray(v[:k].T)
        return cls(weight, basis, _unit(x @ basis), labels.astype(np.float32), each.astype(np.float32), float((labels * each).sum() / each.sum()))

    @staticmethod
    def weighted(rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        forms, words = rows[:, :FORMS], rows[:, FORMS:]
        forms = _unit(np.log1p(forms * (1000 / np.maximum(forms.sum(axis=1, keepdims=True), 1))) * weight[:FORMS])
        return _unit(np.concatenate([forms, WORD_SHARE * _unit(np.log1p(words) * weight[FORMS:])], axis=1))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.prior)
        for a in range(0, len(rows), DOCS):
            part = rows[a : a + DOCS]
            latent = _unit(self.weighted(part, self.weight) @ self.basis)
            cosine = latent @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = nearest(cosine, k)
            own = np.take_along_axis(cosine, near, axis=1)
            vote = np.maximum(own, 0) ** 8 * self.each[near]  # near neighbours count most
            sums = vote.sum(axis=1)
            got = np.where(sums > 0, (vote * self.labels[near]).sum(axis=1) / np.maximum(sums, 1e-12), self.prior)
            has = part.any(axis=1)
            out[a : a + DOCS][has] = got[has]
        return np.clip(out, 0, 1)


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """The columns of the ``k`` largest values of each row; of equal ones the first."""
    if k == cosine.shape[1]:
        return np.argsort(-cosine, axis=1, kind="stable")
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(cosine, near, axis=1).min(axis=1, keepdims=True)
    for i in np.flatnonzero((cosine >= least).sum(axis=1) > k):
        near[i] = np.argsort(-cosine[i], kind="stable")[:k]
    return near


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def learn(docs: DataFrame, labels: DataFrame, chosen: Column, most: int = SAMPLE, label: str = "quality") -> Space | None:
    """Fits the space on the labelled documents that ``chosen`` (a condition on doc_id) allows; the driver gets at most 2 * ``most`` sparse rows."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = rows_of(batch.column("text"))
            held = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("y"), pa.array(held, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(rows, held)], pa.list_(pa.float32()))], ["place", "y", "at", "n"])

    known, stands = sample(docs, labels, label, chosen, most)
    got = mapped(known, terms, "place bigint, y int, at array<int>, n array<float>").toArrow().sort_by("place")
    y = got.column("y").to_numpy()
    if len(y) < 2 or not 0 < y.sum() < len(y):
        return None
    rows = np.zeros((len(y), TERMS), np.float32)
    for i, (at, n) in enumerate(zip(got.column("at"), got.column("n"))):
        rows[i, at.values.to_numpy()] = n.values.to_numpy()
    del got
    return Space.fit(rows, y, np.where(y == 1, stands[1], stands[0]))


def _scores(space: Space | None, texts: pa.Array) -> np.ndarray:
    if not space:
        return np.full(len(texts), 0.5)
    # dense rows of few documents at a time
    return np.concatenate([space.scores(rows_of(texts.slice(a, DOCS))) for a in range(0, len(texts), DOCS)] or [np.empty(0)])


def score(docs: DataFrame, space: Space | None) -> DataFrame:
    """doc_id and score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(space)  # 2 * SAMPLE vectors and the basis

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(sent.value, batch.column("text")).astype(np.float64))], ["doc_id", "score"])

    return mapped(plain(docs, "doc_id", "text"), run, "doc_id bigint, score double")


def keep(docs: DataFrame, space: Space | None) -> DataFrame:
    """``docs``, all columns, of those that score 0.5 or more."""
    sent = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            yield batch.filter(pa.array(_scores(sent.value, batch.column("text")) >= 0.5))

    return mapped(docs, run, docs.schema)
