"""Phrase collocations by contiguous pattern growth in the manner of PrefixSpan.

Texts with A-Z lower-cased are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. A phrase is two to four words next to each other in a
piece; all counts are by language. Only what follows a frequent prefix is projected: every place where a pair that may be frequent begins gives the
window of up to four words that can still be grown there, equal windows of a task are one row with a count, and the rows of one prefix, sorted, are that
prefix's projected database. One task holds it and grows to the right depth first; a projection is a pair of pointers into the sorted rows.

A prefix with more than ``MOST`` different windows is not one task's work: its two-word prefixes are, and if one of those has as many, its three-word
ones are summed where they lie. So no task holds more than ``MOST`` windows of a prefix, whatever the share of the commonest word.

What may be frequent is told by two bitmaps of hashes, of words and of pairs, that are sent to every task. They only ever say yes too often, so that nothing is
lost; their size grows with the frequent pairs up to ``BITS``, and from there on more rows are projected, not fewer found.

Defined cases: a null or empty text has no words; a null language is ``und``; a null doc_id makes no difference, and rows that repeat a text count each; an
empty table gives no rows; columns other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, slices, small, stage

WORDS = 4
#: Different windows of a prefix that one task grows.
MOST = 200_000
#: Bits of a bitmap at most.
BITS = 1 << 28
#: Bytes of text that are counted together in a task.
SLICE = 8 << 20
#: Parts of a language that are ranked by themselves first.
PARTS = 64
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
S29, S32 = np.uint64(29), np.uint64(32)

_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[ord("A") : ord("Z") + 1] += 32
_BYTES[list(b".,;:!?\n\x0b\x0c\r")] = ord(".")
_BYTES[ord("\t")] = ord(" ")


class Tokens:
    """The words of a slice of documents as codes, -1 where a piece or a text ends, with the language of each."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        _, offsets, data = texts.buffers()
        plain = pa.py_buffer(_BYTES[np.frombuffer(data, np.uint8)] if data else b"")
        texts = pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, plain], offset=texts.offset)
        # a dot on its own ends a piece, and another the text
        lists = pc.ascii_split_whitespace(pc.binary_join_element_wise(pc.replace_substring(texts, ".", " . "), pa.scalar("."), pa.scalar(" ")))
        at = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        codes, self.words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        known = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
        self.langs, lang = known.dictionary, known.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.lang = np.repeat(lang, np.diff(at))
        no_word, full = (np.flatnonzero(pc.is_in(self.words, pa.array(x, self.words.type)).to_numpy(zero_copy_only=False)) for x in (["", "."], [""]))
        as_word = np.arange(len(self.words))
        as_word[no_word] = -1
        self.codes = as_word[codes]
        if len(full):
            keep = codes != full[0]
            self.codes, self.lang = self.codes[keep], self.lang[keep]

    def hashes(self) -> np.ndarray:
        """A hash of each word in its language."""
        import xxhash

        words, langs = (np.fromiter(map(xxhash.xxh3_64_intdigest, x.to_numpy(zero_copy_only=False)), np.uint64, len(x)) for x in (self.words, self.langs))
        mixed = (words[self.codes] ^ (langs[self.lang] * B)) * A
        return mixed ^ (mixed >> S32)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """Of each word and the next."""
    mixed = ((words[:-1] ^ (words[:-1] >> S29)) * A + words[1:]) * B
    return mixed ^ (mixed >> S32)


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(frequent: DataFrame) -> np.ndarray:
    """Bits of the column ``h``: sixteen for each row, ``BITS`` at most. They are set by the executors; words of 64 bits come to the driver."""
    bits = min(BITS, max(1 << 16, 1 << (16 * max(1, frequent.count()) - 1).bit_length()))
    at = F.col("h").bitwiseAND(bits - 1)
    set_ = frequent.groupBy(F.shiftright(at, 6).alias("i")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(h & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[set_["i"].to_numpy()] = set_["b"].to_numpy().view(np.uint64)
    return out


def _sliced(docs: DataFrame, work: Callable[[Tokens], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            yield work(Tokens(batch.column("text"), batch.column("lang")))

    return mapped(docs.select("`text`", "`lang`"), run, schema)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, f"""

    def count(t: Tokens) -> pa.RecordBatch:
        is_word = t.codes >= 0
        keys, n = np.unique(t.lang[is_word] * len(t.words) + t.codes[is_word], return_counts=True)
        return pa.RecordBatch.from_arrays([t.langs.take(pa.array(keys // max(1, len(t.words)))), t.words.take(pa.array(keys % max(1, len(t.words)))), pa.array(n.astype(np.int64))], ["lang", "word", "n"])

    return _sliced(docs, count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("f"))


def _alive(t: Tokens, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair of frequent words begins, and the hashes of all pairs."""
    h = t.hashes()
    frequent = (t.codes >= 0) & _held(words, h)
    return frequent[:-1] & frequent[1:], pair_hashes(h)


def maybe_frequent(docs: DataFrame, words, least: int) -> DataFrame:
    """Hashes ``h`` of pairs of frequent words that are met ``least`` times or more, with others of the same hash."""

    def count(t: Tokens) -> pa.RecordBatch:
        pairs, h = _alive(t, words.value)
        keys, n = np.unique(h[pairs].view(np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["h", "n"])

    return _sliced(docs, count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


WINDOW = [f"w{i}" for i in range(1, WORDS + 1)]


def windows(docs: DataFrame, words, pairs) -> DataFrame:
    """lang, w1 to w4 and how often: from each place where a pair begins that may be frequent, up to the first that isn't."""

    def project(t: Tokens) -> pa.RecordBatch:
        both, h = _alive(t, words.value)
        both &= _held(pairs.value, h)
        both = np.concatenate([both, np.zeros(WORDS, bool)])
        codes = np.concatenate([t.codes, np.full(WORDS, -1)])
        at = np.flatnonzero(both)
        grows, cells = np.ones(len(at), bool), [codes[at]]
        for i in range(1, WORDS):
            grows = grows & both[at + i - 1]
            cells.append(np.where(grows, codes[at + i], -1))
        size = len(t.words) + 1
        high, low = (t.lang[at] * size + cells[0]) * size + cells[1], cells[2] * size + cells[3]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(order) else order
        n = np.diff(np.append(first, len(order)))
        of = order[first]
        taken = [t.words.take(pa.array(c[of], mask=c[of] < 0)) for c in cells]
        return pa.RecordBatch.from_arrays([t.langs.take(pa.array(t.lang[at[of]])), *taken, pa.array(n.astype(np.int64))], ["lang", *WINDOW, "n"])

    schema = ", ".join(f"{c} string" for c in ["lang", *WINDOW])
    return _sliced(docs, project, f"{schema}, n bigint").groupBy("lang", *WINDOW).agg(F.sum("n").alias("n"))


class Grown:
    """The frequent phrases of sorted windows. Rows that share a prefix lie together, so a projected database is a range of rows."""

    def __init__(self, rows: pa.Table, least: int):
        self.least, self.out = least, ([], [], [])
        cells = [_codes(rows[c]) for c in ["lang", *WINDOW]]
        self.words = cells[1:]
        self.sums = np.concatenate([[0], np.cumsum(rows["n"].to_numpy())])
        new, self.starts = np.zeros(rows.num_rows, bool), []
        new[:1] = True
        new[1:] |= cells[0][1:] != cells[0][:-1]
        for c in self.words:  # where the first words, so many, are others than in the row before
            new = new.copy()
            new[1:] |= c[1:] != c[:-1]
            self.starts.append(np.flatnonzero(new))
        self.grow(0, rows.num_rows, 0)

    def grow(self, lo: int, hi: int, depth: int) -> None:
        if depth >= 2:
            for x, y in zip(self.out, (lo, depth, int(self.sums[hi] - self.sums[lo]))):
                x.append(y)
        if depth == WORDS:
            return
        starts = self.starts[depth]
        starts = starts[np.searchsorted(starts, lo) : np.searchsorted(starts, hi)]
        ends = np.append(starts[1:], hi)
        frequent = (self.sums[ends] - self.sums[starts] >= self.least) & (self.words[depth][starts] >= 0)
        for a, b in zip(starts[frequent].tolist(), ends[frequent].tolist()):
            self.grow(a, b, depth + 1)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    coded = column.combine_chunks().dictionary_encode()
    return pc.fill_null((coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).indices, -1).to_numpy(zero_copy_only=False)


PHRASES = "lang string, w1 string, w2 string, w3 string, w4 string, a bigint"


PREFIX = ["lang", "w1", "p2"]


def _last_prefix(batch: pa.RecordBatch) -> int:
    """The row with which the last prefix of sorted rows begins."""
    new = np.zeros(batch.num_rows, bool)
    for c in PREFIX:
        cells = pc.fill_null(batch.column(c), "")  # no word is empty, and no language null
        new[1:] |= pc.not_equal(cells.slice(1), cells.slice(0, len(cells) - 1)).to_numpy(zero_copy_only=False)
    return int(np.flatnonzero(new)[-1]) if new.any() else 0


def _grow(least: int):
    def grown(rows: pa.Table) -> pa.RecordBatch:
        at, depth, a = (np.array(x, np.int64) for x in Grown(rows, least).out)
        taken = rows.select(["lang", *WINDOW]).take(pa.array(at)).combine_chunks()
        cells = [pc.if_else(pa.array(depth > i), taken[w].combine_chunks(), None) for i, w in enumerate(WINDOW)] if len(at) else [pa.array([], pa.string())] * WORDS
        return pa.RecordBatch.from_arrays([taken["lang"].combine_chunks().cast(pa.string()) if len(at) else pa.array([], pa.string()), *cells, pa.array(a)], ["lang", *WINDOW, "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # the last prefix of what has come may go on in the next batch
            last = _last_prefix(batch)
            if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in PREFIX) and not last:
                yield grown(pa.Table.from_batches(held))
                held = [batch]
            elif last:
                yield grown(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield grown(pa.Table.from_batches(held))

    return run


def phrases(projected: DataFrame, least: int) -> DataFrame:
    """lang, w1 to w4 (null where a phrase is shorter) and a, for every phrase that occurs ``least`` times or more. ``projected`` is staged."""
    crowded = lambda rows, by: stage(rows.groupBy("lang", *by).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > MOST).select("lang", *by), "crowded")
    by_word = crowded(projected, ["w1"])
    by_pair = crowded(projected.join(small(by_word), ["lang", "w1"], "left_semi"), ["w1", "w2"])
    keyed = projected.join(small(by_word.withColumn("split", F.lit(True))), ["lang", "w1"], "left").withColumn("p2", F.when(F.col("split"), F.col("w2"))).drop("split")
    mine = keyed.join(small(by_pair), ["lang", "w1", "w2"], "left_anti").select("lang", *WINDOW, "p2", "n")
    dealt = mine.repartition(*PREFIX).sortWithinPartitions(*PREFIX, *WINDOW[1:])
    found = mapped(dealt, _grow(least), PHRASES)
    if by_pair.isEmpty():
        return _whole(found, by_word, least, projected)
    rest = projected.join(small(by_pair), ["lang", "w1", "w2"], "left_semi")
    for size in range(2, WORDS + 1):
        own = rest.where(F.col(WINDOW[size - 1]).isNotNull()).groupBy("lang", *WINDOW[:size]).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
        found = found.unionByName(own.withColumns({w: F.lit(None).cast("string") for w in WINDOW[size:]}))
    return _whole(found, by_word, least, projected)


def _whole(found: DataFrame, by_word: DataFrame, least: int, projected: DataFrame) -> DataFrame:
    words = F.array_compact(F.array(*WINDOW))
    return found.select("lang", words.alias("words"), F.array_join(words, " ").alias("phrase"), "a")


def _part(words: str, begin, size):
    return F.array_join(F.slice(words, begin, size), " ")


def mine(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases.

    A phrase cut after its first k words has l and r, the counts of both parts, and score 2,000,000 * a / (l + r), rounded down; the cut of the lowest
    score counts, of equal ones the first. A phrase goes if some longer one that is frequent holds it and occurs 80 % as often or more.
    """
    spark = docs.sparkSession
    counts = stage(word_counts(docs), "words")
    frequent = counts.where(F.col("f") >= least)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = Tokens(batch.column("word"), batch.column("lang"))
            yield pa.RecordBatch.from_arrays([pa.array(t.hashes()[t.codes >= 0].view(np.int64))], ["h"])

    words = spark.sparkContext.broadcast(bitmap(stage(mapped(frequent, hashed, "h bigint"), "word-hashes")))
    pairs = spark.sparkContext.broadcast(bitmap(stage(maybe_frequent(docs, words, least), "pair-hashes")))
    found = stage(phrases(stage(windows(docs, words, pairs), "windows"), least), "phrases")

    known = stage(frequent.select("lang", F.col("word").alias("part"), "f").unionByName(found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))), "parts")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("words", F.lit(1), F.col("k")).alias("left"), _part("words", F.col("k") + 1, F.size("words")).alias("right"))
    side = lambda name, count: known.select("lang", F.col("part").alias(name), F.col("f").alias(count))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    # exact: the product is a decimal of 38 digits
    scored = cuts.withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div cast(l + r as decimal(20,0))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("words") - m + 1), lambda b: _part("words", b, m))))
    longer = found.where(F.size("words") > 2).select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("most is null or 100 * most < 80 * a")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def sql(least: int, top: int) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grams = " union all ".join(f"select lang, list_aggregate(w[i : i + {m - 1}], 'string_agg', ' ') as phrase, {m} as m from (select lang, w, unnest(range(1, len(w) - {m - 2})) as i from pieces where len(w) >= {m})" for m in range(1, WORDS + 1))
    return f"""
    with cut as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
    pieces as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from cut),
    counted as (select lang, phrase, m, count(*) as f from ({grams}) group by all),
    found as (select lang, phrase, m, f as a, string_split(phrase, ' ') as w from counted where m > 1 and f >= {least}),
    cuts as (select lang, phrase, a, k, array_to_string(w[1 : k], ' ') as x, array_to_string(w[k + 1 : m], ' ') as y from (select *, unnest(range(1, m)) as k from found)),
    scored as (select c.lang, c.phrase, c.a, c.k, l.f as l, r.f as r, (2000000::hugeint * c.a) // (l.f + r.f) as score from cuts c
        join counted l on l.lang = c.lang and l.phrase = c.x join counted r on r.lang = c.lang and r.phrase = c.y),
    best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    kept as (select * from best b where not exists (select 1 from found g where g.lang = b.lang and g.m > len(string_split(b.phrase, ' '))
        and contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ') and 100 * g.a >= 80 * b.a)),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select r.lang, r.rank::bigint as rank, r.phrase, r.a::bigint as a, r.l::bigint as l, r.r::bigint as r, t.n::bigint as n, r.score::bigint as score
    from ranked r join (select lang, sum(f) as n from counted where m = 1 group by lang) t on t.lang = r.lang where rank <= {top}"""
