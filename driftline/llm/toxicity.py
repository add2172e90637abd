"""Toxicity by a lexicon trie that Levenshtein automata walk, with context windows.

The lexicon is learned from labelled documents: words, and stems (beginnings of words), that toxic documents hold far more often than
others, each with its log-odds as weight. Walking the trie with all its entries' automata at once is a deterministic automaton, whose states
are sets of (trie node, edits); states are made when first reached, and a word costs one step a letter until no entry is near.

Words are runs of letters and digits with signs inside; signs and digits that stand for letters are folded to them, characters that don't show are
passed over, letters spelled out one by one (with signs or single blanks between) are a word, and a word with hyphens is looked up joined and by
its parts. A document's evidence is the sum over its matches of weight, times a discount for each edit, times a context factor: less where
the match stands in quotation marks, double or single, that open and close in one paragraph, or behind a word of reporting in its line, more where
other matches are near. Factors and threshold are those of a small grid that part the labelled documents with fewest errors, each label counting for
as many documents as have it; the score is evidence / (evidence + threshold).

What is learned from is bounded: at most ``SAMPLE`` documents of each label, and of those with the same three smallest word hashes (copies, near
copies) one counts for the lexicon, while all of them count for factors and threshold.

Defined cases: null and empty texts, and texts without matches, score 0; a text is scored whole, however long; without labelled documents of both kinds, as with an
empty table, the lexicon is empty and all scores are 0; a document that is labelled both 0 and 1 counts as 1; rows are scored one by one, so repeated
rows score alike; other columns are not read by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import nsmallest
from itertools import product
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import mapped, plain, slices, stage

#: Labelled documents that are learned from, at most, for each label: those of the smallest id hashes.
SAMPLE = 4_000
#: A word or stem is an entry if so many toxic documents hold it and this share of the documents that hold it are toxic.
HELD, SHARE = 3, 0.8
#: By how much, as a logarithm, an entry must be unlikelier than one chance hit among all candidates.
CHANCE = 1.0
STEMS = (4, 5, 6, 7, 8)
#: Words and stems that a task counts before it hands their sums on.
FORMS = 150_000
#: Letters from which a word may differ by one edit, and by two.
ONE, TWO = 5, 10
#: What a match with so many edits counts where the labelled documents hold none like it.
DISCOUNT = (1.0, 0.6, 0.3)
WINDOW = 8
#: Context factors to choose from, for a match that is quoted, that is reported, and that has another near; the first where all do alike.
QUOTED, REPORTED, NEAR = (0.35, 0.2, 0.6, 1.0), (0.6, 0.4, 0.8, 1.0), (1.25, 1.0, 1.5)
PLAIN, IN_REPORT, IN_QUOTE = 0, 1, 2
#: Letters one by one with signs or blanks between, or letters and digits with signs inside.
WORD = re.compile(r"(?<![^\W_])[^\W\d_](?:[.\-_* ][^\W\d_]){2,}(?![^\W_])|[^\W_]+(?:[@$_*\-]+[^\W_]+)*")
LETTERS = str.maketrans("013457@$", "oieastas", ".-_* ")
#: Soft hyphens, joiners, marks of direction and blanks of no width.
HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]+")
#: Quotation marks, those that can only begin or end a quotation told by what is beside them, and the end of a paragraph.
MARK = re.compile(r"""["“”„«»]|(?P<begins>(?<!\w)['‘](?=\w))|(?P<ends>(?<=\S)['’](?!\w))|(?P<gap>\n[^\S\n]*\n)""")
CLOSING = {"“": "”", "„": "“", "«": "»", '"': '"', "'": "'", "‘": "’"}
SINGLE = ("'", "’")
#: Words that introduce a quotation, in the languages of the documents.
REPORTING = frozenset("said says wrote called quoted quote quotes term word phrase dit écrit mot terme sagte schrieb wort begriff dijo escribió palabra término".split())


@dataclass
class Lexicon:
    words: dict[str, tuple[float, float, float]] = field(default_factory=dict)  # weights by edits
    stems: dict[str, float] = field(default_factory=dict)
    threshold: float = 1.0
    factors: tuple[float, float, float] = (QUOTED[0], REPORTED[0], NEAR[0])


class Automaton:
    """The Levenshtein automata of all entries over their trie, as one automaton made as it is walked."""

    def __init__(self, lexicon: Lexicon):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[tuple[float, ...]] = [()]
        self.entry: list[str] = [""]
        self.stem: list[float] = [0.0]
        self.depth: list[int] = [0]
        self.longest: list[int] = [0]  # of the words below a node
        for entries, values in ((lexicon.words, self.word), (lexicon.stems, self.stem)):
            for entry, weight in entries.items():
                node = 0
                for c in entry:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.word.append(())
                        self.entry.append("")
                        self.stem.append(0.0)
                        self.depth.append(self.depth[node] + 1)
                        self.longest.append(0)
                    if values is self.word:
                        self.longest[node] = max(self.longest[node], len(entry))
                    node = self.children[node][c]
                if values is self.word:
                    self.longest[node] = max(self.longest[node], len(entry))
                values[node] = weight
                self.entry[node] = entry
        self.clear()

    def clear(self) -> None:
        self.steps: list[dict[str, int]] = []
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.start = self._state(self._closed({(0, "", 0): 0}))

    @staticmethod
    def allowed(length: int) -> int:
        return 2 if length >= TWO else 1 if length >= ONE else 0

    def _state(self, positions: dict) -> int:
        key = tuple(sorted((n, w, s, e) for (n, w, s), e in positions.items()))
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return self.known[key]

    def _closed(self, positions: dict) -> dict:
        """With the positions that leaving out letters of the entry reaches."""
        todo = list(positions.items())
        while todo:
            (node, wait, stem), e = todo.pop()
            if wait or stem or positions[node, wait, stem] < e:
                continue
            for child in self.children[node].values():
                if self._may(child, e + 1) and positions.get((child, "", 0), 9) > e + 1:
                    positions[child, "", 0] = e + 1
                    todo.append(((child, "", 0), e + 1))
        return positions

    def _may(self, node: int, edits: int) -> bool:
        return edits == 0 or edits <= self.allowed(self.longest[node])

    def step(self, state: int, c: str) -> int:
        """From a state by a letter of the text. ``wait`` holds the letter that a transposition still needs; ``stem`` marks a stem already read."""
        out: dict[tuple, int] = {}

        def reach(node: int, wait: str, stem: int, e: int) -> None:
            if out.get((node, wait, stem), 9) > e:
                out[node, wait, stem] = e

        for node, wait, stem, e in self.states[state]:
            if stem:
                reach(node, "", stem, e)
                continue
            if wait:
                if c == wait:
                    reach(node, "", 0, e)
                continue
            for letter, child in self.children[node].items():
                if letter == c:
                    reach(child, "", 0, e)
                    if e == 0 and self.stem[child]:
                        reach(child, "", 1, 0)
                elif self._may(child, e + 1):
                    reach(child, "", 0, e + 1)  # another letter
                    grand = self.children[child].get(c)
                    if grand is not None and self._may(grand, e + 1):
                        reach(grand, letter, 0, e + 1)  # two letters in the other order
            if self._may(node, e + 1):
                reach(node, "", 0, e + 1)  # a letter too many
        return self._state(self._closed(out)) if out else -1

    def match(self, word: str) -> tuple[float, int, str] | None:
        """Weight, edits and entry of the weightiest entry near the word."""
        state = self.start
        for c in word:
            to = self.steps[state].get(c)
            if to is None:
                to = self.steps[state][c] = self.step(state, c)
            if to < 0:
                return None
            state = to
        best = None
        for node, wait, stem, e in self.states[state]:
            if stem:
                weight = self.stem[node]
            else:
                weight = self.word[node][e] if self.word[node] and not wait and e <= self.allowed(self.depth[node]) else 0.0
            if weight > 0 and (best is None or weight > best[0]):
                best = (weight, e, self.entry[node])
        return best


class Scorer:
    #: Words whose matches one worker remembers, and states after which its automaton begins anew; only speed depends on them.
    REMEMBERED, STATES, LONGEST = 150_000, 50_000, 64

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, Automaton(lexicon)
        self.seen: dict[str, tuple[float, int, str] | None] = {}

    def look(self, word: str) -> tuple[float, int, str] | None:
        if word not in self.seen:
            if len(self.seen) >= self.REMEMBERED:
                self.seen.clear()
            if len(self.automaton.states) > self.STATES:
                self.automaton.clear()
            found = max(filter(None, map(self.automaton.match, forms(word))), default=None)
            if len(word) > self.LONGEST:
                return found
            self.seen[word] = found
        return self.seen[word]

    def matches(self, text: str) -> list[tuple[int, int, int, float, int, str, bool]]:
        """(place among the words, begin, end, weight, edits, entry, whether a word of reporting is among the few before it in its line) of every
        match in the whole text, as ``visible`` gives it."""
        low = visible(text)
        seen, look = self.seen, self.look
        words = WORD.findall(low)
        near = {w for w in set(words) if (seen[w] if w in seen else look(w))}
        if not near:
            return []
        out, before = [], deque(maxlen=WINDOW // 2)
        for i, m in enumerate(WORD.finditer(low)):
            if m[0] in near:
                told = any(w[0] in REPORTING and low.find("\n", w.end(), m.start()) < 0 for w in before)
                out.append((i, m.start(), m.end(), *self.look(m[0]), told))
            before.append(m)
        return out

    def sums(self, text: str | None) -> np.ndarray:
        """Weights of the matches, summed by context (plain, reported, quoted) and by whether another match is near."""
        out = np.zeros((3, 2))
        found = self.matches(text) if text else []
        if found:
            quotes = quotations(visible(text))
            opens = [q[0] for q in quotes]
            places = np.array([f[0] for f in found])
            close = np.searchsorted(places, places + WINDOW, "right") - np.searchsorted(places, places - WINDOW) - 1
            for (_, begin, end, weight, _, _, told), others in zip(found, close):
                at = bisect_right(opens, begin) - 1
                quoted = at >= 0 and quotes[at][1] >= end
                out[IN_QUOTE if quoted else IN_REPORT if told else PLAIN, int(others > 0)] += weight
        return out

    def evidence(self, text: str | None) -> float:
        return float(weighed(self.sums(text), self.lexicon.factors))

    def score(self, text: str | None) -> float:
        e = self.evidence(text)
        return e / (e + self.lexicon.threshold)


def weighed(sums: np.ndarray, factors: tuple[float, float, float]) -> np.ndarray:
    """Evidence of sums by context and nearness (the last two axes)."""
    quoted, told, near = factors
    return (sums * np.array([1.0, told, quoted])[:, None] * np.array([1.0, near])).sum(axis=(-1, -2))


def quotations(text: str) -> list[tuple[int, int]]:
    """Spans between quotation marks that open and close in one paragraph, in order. A double mark ends a single one that is still open."""
    out, begin, closing = [], 0, None
    for m in MARK.finditer(text):
        mark, kind = m[0], m.lastgroup
        if kind == "gap":
            closing = None
        elif mark == closing and kind != "begins":
            out.append((begin, m.start()))
            closing = None
        elif mark in CLOSING and kind != "ends" and (closing is None or closing in SINGLE and kind is None):
            begin, closing = m.end(), CLOSING[mark]
    return out


def visible(text: str) -> str:
    """A text in small letters, without characters that don't show."""
    low = text.lower()
    return low if low.isascii() else HIDDEN.sub("", low)


def forms(word: str) -> list[str]:
    """As what a word is looked up: its letters alone; one with hyphens also by its parts."""
    return [w if w.isalpha() else w.translate(LETTERS) for w in ([word, *filter(None, word.split("-"))] if "-" in word else [word])]


def known_words(text: str | None) -> set[str]:
    """The distinct words of a whole text, as they are looked up."""
    return {f for w in set(WORD.findall(visible(text or ""))) for f in forms(w)}


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> tuple[DataFrame, dict[int, float]]:
    """Texts and labels (0 or 1) of at most ``most`` labelled documents of each label, those of the smallest id hashes; and for how many
    labelled documents one of the sample stands, by label. ``place`` orders the sample."""
    own = plain(labels, "doc_id", label).where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y")).where(learn)
    parts = [own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)]
    chosen = stage(parts[0].union(parts[1]), "labelled")
    stands = {r["y"]: max(1.0, r["count"] / most) for r in own.groupBy("y").count().collect()}
    rows = plain(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * most rows of 12 bytes
    return rows.select("text", "y", F.xxhash64("doc_id").alias("place")), stands


def learn(docs: DataFrame, labels: DataFrame, chosen: Column, most: int = SAMPLE, label: str = "toxic") -> Lexicon:
    """Fits lexicon and threshold on the labelled documents that ``chosen`` (a condition on doc_id) allows."""
    rows, stands = sample(docs, labels, label, chosen, most)
    rows = stage(rows, "labelled-texts")

    def witness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [crc32(b"".join(b"%016x" % h for h in nsmallest(3, map(xxh3_64_intdigest, known_words(t))))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("y"), batch.column("place")], ["witness", "y", "place"])

    # copies and near copies are one witness: of documents whose words have the same three smallest hashes one counts, a toxic one if there is any
    seen = mapped(rows, witness, "witness bigint, y int, place bigint").groupBy("witness").agg(F.min(F.struct(-F.col("y"), "place")).alias("d"))
    seen = stage(seen.select((-F.col("d.col1")).alias("y"), F.col("d.place").alias("place")).distinct(), "witnesses")
    total = {r["y"]: r["count"] for r in seen.groupBy("y").count().collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[int]] = {}
        for batch in slices(batches, "text", 1 << 20):
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                words = known_words(text)
                for form in {(w, 0) for w in words if len(w) > 2}.union(*({(w[:k], k) for w in words if len(w) >= k} for k in STEMS)):
                    held.setdefault(form, [0, 0])[y] += 1
            if len(held) > FORMS:
                yield rows_of(held)
                held = {}
        yield rows_of(held)

    def rows_of(held: dict[tuple[str, int], list[int]]) -> pa.RecordBatch:
        parts = ([w for w, _ in held], [k for _, k in held], [n[1] for n in held.values()], [n[0] for n in held.values()])
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(parts, (pa.string(), pa.int32(), pa.int64(), pa.int64()))], ["w", "k", "pos", "neg"])

    texts = rows.join(F.broadcast(seen.select("place")), "place").select("text", "y")  # at most 2 * most rows
    held = mapped(texts, count, "w string, k int, pos bigint, neg bigint").groupBy("w", "k").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    held = stage(held.where(f"pos + neg >= {HELD}"), "held")
    rows = rows.select("text", "y")
    if not total.get(0) or not total.get(1):
        return Lexicon()
    # chance: how likely so many of the documents that hold it are toxic, if it said nothing; all candidates together must be unlikely
    n, rate = F.col("pos") + F.col("neg"), total[1] / (total[0] + total[1])
    share = F.col("pos") / n
    none = F.lit(0.0)
    surprise = F.when(F.col("pos") > 0, F.col("pos") * F.log(share / rate)).otherwise(none) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / (1 - rate))).otherwise(none)
    least = math.log(max(1, held.count())) + CHANCE
    found = held.where((F.col("pos") >= HELD) & (share >= SHARE) & (surprise >= least)).collect()  # of the words of the bounded sample
    odds = lambda pos, neg: math.log((pos + 0.5) / (total[1] + 1)) - math.log((neg + 0.5) / (total[0] + 1))
    made = Lexicon()
    for r in found:
        weight = odds(r["pos"], r["neg"])
        if weight > 0 and r["k"]:
            made.stems[r["w"]] = weight
        elif weight > 0:
            made.words[r["w"]] = tuple(weight * d for d in DISCOUNT)
    # near forms of an entry weigh what the labelled documents that hold them say, where there are any
    draft = docs.sparkSession.sparkContext.broadcast(made)

    def near_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(draft.value)
        for batch in batches:
            out = [(y, entry, e) for y, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()) for entry, e in {(m[5], m[4]) for m in scorer.matches(t or "")} if e]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int32(), pa.string(), pa.int32()))], ["y", "entry", "e"])

    near = mapped(rows, near_forms, "y int, entry string, e int").groupBy("entry", "e").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).collect()  # at most two for each entry
    for r in near:
        own = list(made.words[r["entry"]])
        own[r["e"]] = min(own[r["e"]], odds(r["pos"], r["neg"]))
        made.words[r["entry"]] = tuple(own)
    sent = docs.sparkSession.sparkContext.broadcast(made)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([scorer.sums(t).ravel() for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))], ["y", "e"])

    seen = mapped(rows, weigh, "y int, e array<double>").toArrow()  # seven numbers for each document of the bounded sample
    sums, y = seen.column("e").combine_chunks().flatten().to_numpy().reshape(-1, 3, 2), seen.column("y").to_numpy()
    each = np.where(y == 1, stands[1], stands[0])
    grid = list(product(QUOTED, REPORTED, NEAR))
    cuts = [cut(weighed(sums, f), y, each) for f in grid]
    best = min(range(len(grid)), key=lambda i: (cuts[i][1], i))
    made.factors, made.threshold = grid[best], cuts[best][0]
    return made


def cut(evidence: np.ndarray, y: np.ndarray, each: np.ndarray) -> tuple[float, float]:
    """The evidence that separates the labels with fewest errors, in the middle between the two values beside it, and those errors.
    ``each`` is what a document counts."""
    order = np.argsort(evidence, kind="stable")
    e, good, bad = evidence[order], (each * (y == 0))[order], (each * (y == 1))[order]
    errors = np.round(np.concatenate([[0], np.cumsum(bad)]) + (good.sum() - np.concatenate([[0], np.cumsum(good)])), 6)
    valid = np.concatenate([[True], e[1:] != e[:-1], [True]])
    best = np.flatnonzero(valid & (errors == errors[valid].min()))[-1]
    low = e[best - 1] if best else 0.0
    high = e[best] if best < len(e) else 2 * max(low, 1.0)
    return max(float(low + high) / 2, 1e-6), float(errors[best])


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # words of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([scorer.score(t) for t in batch.column("text").to_pylist()], pa.float64())], ["doc_id", "score"])

    return mapped(plain(docs, "doc_id", "text"), run, "doc_id bigint, score double")


def keep(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs``, all columns, without those that score 0.5 or more."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in batch.column("text").to_pylist()], pa.bool_()))

    return mapped(docs, run, docs.schema)
