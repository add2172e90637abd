"""Each operator against brute force, an exact round trip or held-out accuracy, and the cases its docstring defines."""

import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import chat_format, common, components, decontamination, fm_index, jaccard_join, packing, permutation_index, quality, rans, sharding, token_output, token_rollup, tokenizing, toxicity
from driftline.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
WORDS = [f"w{i}" for i in range(30)]


@pytest.fixture(autouse=True, scope="module")
def ready(spark):
    common.table(spark, "/root/testdata/sf0.001", "documents")


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, None, "x") for i, t in zip(ids, texts)], DOCS)


ODD = ["", None, " ", "a", "a  b", "a\n b", " \n x", "tail ", "<|endoftext|>", "ñ é  ß", "\x00\x01", "same", "same", "long " * 9000]


@functools.cache
def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def tokens(text):
    return plain_tokenizer().encode(text or "", add_special_tokens=False).ids


# tokens


def test_encoder_is_exact():
    import pyarrow as pa

    random.seed(3)
    more = ["".join(random.choice("ab \n\t.'é1") for _ in range(40)) for _ in range(300)]
    texts = pa.array(ODD + more)
    ids, at = tokenizing.Encoder(tokenizer_path()).encode(texts)
    for i, t in enumerate(ODD + more):
        assert ids[at[i] : at[i + 1]].tolist() == tokens(t), t


def test_letters_are_encoded_once(monkeypatch):
    """A word that comes with different marks goes to the library once, and the ids are still the library's."""
    import pyarrow as pa

    encoder, sent = tokenizing.Encoder(tokenizer_path()), []
    monkeypatch.setattr(encoder, "whole", lambda texts, whole=encoder.whole: (sent.extend(texts), whole(texts))[1])
    marks = ["", ",", ".", "...", "'s", "'tis", "\n", ".\nAnd", "\n\nAnd", "-", "7", "\u0301", "ｅ"]
    texts = ["x " + " ".join(w + m for w in ("quixotry", "éáß") for m in marks), *(f"a quixotry{m}" for m in marks), *(f"{m}quixotry b" for m in marks), "a éáß×é quixotry÷ ẞẞ."]
    ids, at = encoder.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == tokens(t), t
    joined = next(x for x in sent if x.startswith(" quixotry"))
    assert len(re.findall("quixotry(?![^\x00-\x7f])", joined)) == 1


def test_kept_parts_are_small_and_forgotten(monkeypatch):
    """Parts are kept at some 80 bytes each, so 8000 go into a cache of 1 MB and aren't encoded again; with any smaller one the ids are still the library's."""
    import pyarrow as pa

    random.seed(5)
    words = ["".join(random.choices("aeinrst", k=8)) + m for m in ("", ".\nB") for _ in range(4000)]
    texts = [f"x {' '.join(words[i : i + 400])}" for i in range(0, len(words), 400)]
    want = [t for text in texts for t in tokens(text)]
    for size in (1 << 20, 200_000, 4096):
        monkeypatch.setattr(tokenizing, "CACHE_BYTES", size)
        encoder, sent = tokenizing.Encoder(tokenizer_path()), []
        monkeypatch.setattr(encoder, "whole", lambda texts, whole=encoder.whole: (sent.extend(texts), whole(texts))[1])
        assert encoder.encode(pa.array(texts))[0].tolist() == want
        sent.clear()
        for part in (texts, texts[:3], texts):
            assert encoder.encode(pa.array(part))[0].tolist() == want[: sum(len(tokens(t)) for t in part)]
        if size == 1 << 20:
            assert set(sent) == {"x"}  # the first pieces of the texts alone


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 300_000])
def test_rans_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50257).astype(np.int32)
    table, blocks = rans.encode(ids)
    assert (rans.decode(table, blocks) == ids).all()
    reader = rans.Reader(table, blocks)
    for first, stop in [(0, 5), (n // 2, n // 2 + 7), (n - 3, n), (131_000, 132_000), (n - 1, n + 9), (5, 5)]:
        assert (reader.ids(max(0, first), stop) == ids[max(0, first) : stop]).all()


def test_rans_notices_damage():
    table, blocks = rans.encode(np.arange(5000))
    blocks[0]["words"] = blocks[0]["words"][:-4] + b"\1\2\3\4"
    with pytest.raises(rans.Corrupt):
        rans.decode(table, blocks)
    table, blocks = rans.encode(np.arange(200_000) % 5000)
    blocks[0]["points"][0]["states"] = blocks[0]["points"][0]["states"][::-1]
    assert (rans.decode(table, blocks) == np.arange(200_000) % 5000).all()
    with pytest.raises(rans.Corrupt):  # who begins at the checkpoint notices too
        rans.Reader(table, blocks).ids(150_000, 150_001)


@pytest.mark.parametrize("shard_bytes", [1 << 24, 6000])
def test_token_output(spark, shard_bytes):
    texts = ODD + ["same", "no id"]
    ids = [*range(len(ODD) - 1, -1, -1), len(ODD) - 1 - ODD.index("same"), None]
    want, start = [], 0
    for i, t in sorted(zip(ids, texts), key=lambda x: -1 if x[0] is None else x[0]):
        own = np.array(tokens(t) + [0], "<u4")
        want.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    path = f"{common.shared_dir(spark)}/out-{shard_bytes}-{random.random()}"
    token_output.write(docs(spark, texts, ids), path, tokenizer_path(), 0, shard_bytes)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    key = lambda r: [-1 if x is None else x for x in r]
    assert sorted(map(tuple, token_output.read(spark, path).select(columns).collect()), key=key) == sorted(want, key=key)
    some = spark.createDataFrame([(2,), (2,), (len(ODD) - 2,), (999,)], "doc_id long")
    assert sorted(map(tuple, token_output.find(spark, path, some).select(columns).collect())) == sorted(w for w in want if w[0] in (2, len(ODD) - 2))
    assert token_output.round_trip(docs(spark, []), tokenizer_path(), 0).count() == 0


# packing


def check_packing(rows, lengths, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r.length for r in rows) == sum(lengths)
    return len(by)


def test_packing(spark):
    random.seed(1)
    texts = ODD + [" ".join(random.choices(WORDS, k=random.randint(0, 60))) for _ in range(200)] + ["same size"] * 50
    got = packing.pack(docs(spark, texts), tokenizer_path(), 2, 64).collect()
    lengths = [len(tokens(t)) + 1 for t in texts]
    used = check_packing(got, lengths, 64)
    assert used <= math.ceil(sum(lengths) / 64) * 1.005 + 1
    by = {(r.doc_id, r.piece): r for r in got}
    for i, t in enumerate(texts):
        ids = tokens(t) + [2]
        n = math.ceil(len(ids) / 64)
        at = 0
        for k in range(n):
            size = len(ids) - (n - 1) * 64 if k == 0 else 64
            r = by.pop((i, k))
            assert (r.start, r.length, r.ids_crc32) == (at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes()))
            at += size
    assert not by and packing.pack(docs(spark, []), tokenizer_path(), 2, 64).count() == 0
    whole = {r.sequence_id: r.ids for r in packing.sequences(packing.pack(docs(spark, texts), tokenizer_path(), 2, 64), docs(spark, texts), tokenizer_path(), 2).collect()}
    assert sorted(itertools.chain.from_iterable(whole.values())) == sorted(x for t in texts for x in tokens(t) + [2])


@pytest.mark.parametrize("n", [1, 30, 5000])
def test_patterns_use_every_length_once(n):
    lengths = np.minimum(1024, np.random.default_rng(n).lognormal(5.5, 1.2, n).astype(int) + 1)
    counts = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True))}
    made = packing.patterns(counts, 1024)
    used = {}
    for pattern, times in made:
        assert sum(pattern) <= 1024
        for k in pattern:
            used[k] = used.get(k, 0) + times
    assert used == counts and sum(t for _, t in made) <= math.ceil(lengths.sum() / 1024) * 1.03 + 1


def test_two_replace_the_smallest():
    assert packing.patterns({6: 1, 3: 1, 2: 2}, 10) == [([6, 2, 2], 1), ([3], 1)]


# FM-index


@pytest.mark.parametrize("n, symbols", [(1, 1), (50, 2), (400, 4), (600, 200)])
def test_fm_index(n, symbols):
    rng = np.random.default_rng(n)
    text = rng.integers(1, symbols + 1, n)
    if n == 400:
        text = np.tile(text[:80], 5)
    whole = np.append(text, 0)
    assert fm_index.suffix_array(whole).tolist() == sorted(range(n + 1), key=lambda i: whole[i:].tolist())
    index = fm_index.FMIndex(text, symbols)
    for size in (1, 2, 5):
        patterns = np.array([rng.integers(1, symbols + 1, size) for _ in range(20)] + [text[i : i + size] for i in range(max(0, n - size + 1))][:20])
        low, high = index.search(patterns, np.full(len(patterns), size))
        for p, a, b in zip(patterns, low, high):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(n - size + 1) if (text[i : i + size] == p).all()]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def windows(items, window=10):
    found = {}
    for item, t in items:
        w = WORD.findall(lower(t))
        for k in range(len(w) - min(window, len(w)) + 1 if w else 0):
            found.setdefault(tuple(w[k : k + window]), set()).add(item)
    return found


def without_hits(text, found):
    """The text without its runs of hit words, plainly."""
    marks = list(WORD.finditer(lower(text)))
    w = [m[0] for m in marks]
    hit = {j for size in {len(x) for x in found} for k in range(len(w) - size + 1) if tuple(w[k : k + size]) in found for j in range(k, k + size)}
    gone = [(marks[j].start(), marks[j + 1].start() if j + 1 in hit else marks[j].end()) for j in sorted(hit)]
    for a, b in reversed(gone):
        text = text[:a] + text[b:]
    return text


def hits(texts, items, window=10):
    found = windows(items, window)
    for t in texts:
        w = WORD.findall(lower(t))
        hit, own = set(), set()
        for size in {len(x) for x in found}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in found:
                    hit.update(range(k, k + size))
                    own |= found[tuple(w[k : k + size])]
        yield len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(map(str, own))).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    random.seed(5)
    phrase = lambda n: " ".join(random.choices(WORDS[:6], k=n))
    items = [(10, phrase(14)), (9, phrase(12)), (2, "w1 w2 w3"), (11, None), (12, "..."), (9, phrase(11)), (13, "É ñandú")]
    texts = ODD + [f"{phrase(40)} {items[k % 2][1].upper()}, {phrase(20)}" for k in range(30)] + ["w1-w2 W3", "É ñandú!", "w1", items[0][1] + "w9"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {r.doc_id: tuple(r)[1:] for r in decontamination.digest(decontamination.scan(docs(spark, texts), bench)).collect()}
    assert got == dict(enumerate(hits(texts, items)))
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.digest(decontamination.scan(docs(spark, texts), empty)).where("contaminated").count() == 0


def test_items_with_text_ids(spark):
    bench = spark.createDataFrame([("b", "w1 w2 w3"), ("a", "w2 w3 w4"), ("a", "zz")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.items) for r in decontamination.scan(docs(spark, ["w1 w2 w3 w4 w5", "w3", None, "zz w2 zz", "zz w2 zz"]), bench).collect()}
    assert got == {0: (4, ["a", "b"]), 1: (0, []), 2: (0, []), 3: (2, ["a"]), 4: (2, ["a"])}


def test_removal(spark):
    item = " ".join(WORDS[:12])
    texts = ["clean text", f"before {item.upper()}; after", item, None, ""]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontamination.remove(docs(spark, texts), bench)
    assert got.columns == docs(spark, texts).columns
    assert {r.doc_id: r.text for r in got.collect()} == {0: "clean text", 1: "before ; after", 3: None, 4: ""}


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_removal_of_overlapping_items(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    w, apart = [f"u{i}" for i in range(40)], [f"z{i}" for i in range(10)]
    items = [(k, " ".join(x)) for k in range(6) for x in [(w[5:20], w[12:25], apart)[k % 3]]]
    seam = [*apart[:5], *w[5:20], *apart[5:]]  # what is left beside the cut reads like an item
    texts = [" ".join(w), " ".join(seam), " ".join(w[5:25]), "clean text"]
    want = {0: " ".join(w[:5]) + "  " + " ".join(w[25:]), 1: " ".join(apart[:5]) + "  " + " ".join(apart[5:]), 3: "clean text"}
    for chosen in itertools.combinations(items, 3):
        if len({t for _, t in chosen}) == 3:
            bench = spark.createDataFrame(chosen, "item_id long, text string").coalesce(1)
            assert {r.doc_id: r.text for r in decontamination.remove(docs(spark, texts), bench).collect()} == want


# Jaccard join


def brute_components(texts, k, num, den):
    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(t)) if x]
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * len(sets[i] | sets[j]):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    return [(len(s), x) for s, x in zip(sets, label)]


def mutated(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.random()}"
    return " ".join(w)


@pytest.mark.parametrize("k, num, heavy, block", [(3, 90, 5, 500), (5, 80, 2, 7), (3, 90, 1, 3)])
def test_jaccard_join(spark, monkeypatch, k, num, heavy, block):
    monkeypatch.setattr(jaccard_join, "HEAVY", heavy)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "WEIGHT", 60 * block)
    monkeypatch.setattr(jaccard_join, "STAR", 3)
    rng = random.Random(num + heavy)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(20, 120))) for _ in range(8)]
    passage = " ".join(rng.choices(vocabulary, k=50))
    texts = ODD + [mutated(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(110)] + [f"{passage} {t}" for t in base] + [base[0].upper(), base[0].replace(" ", "\n\t")] * 2
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs(spark, texts), k, num, 100).collect()}
    assert got == dict(enumerate(brute_components(texts, k, num, 100)))


def test_jaccard_join_odd_rows(spark):
    got = jaccard_join.join(docs(spark, ["a b c", "a b c", "x y z", None, "q r s", "a b c"], [5, 3, 3, 7, None, None]), 3, 90, 100).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.doc_id) == [(3, 1, 3), (3, 1, 3), (5, 1, 3), (7, 0, 7)]
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert jaccard_join.join(docs(spark, []), 3, 90, 100).count() == 0


def test_jaccard_join_of_a_doc_id_with_two_texts(spark):
    words = [f"r{i}" for i in range(200)]
    rng = random.Random(8)
    b, c = rng.sample(words, 60), rng.sample(words, 60)
    # some differ from b in no shingle of the prefix, so doc_id 3 is in b's group and not its first
    near = [[*b[:i], "other", *b[i + 1 :]] for i in (16, 28, 41, 51)]
    rows = [(1, b), *((3, x) for x in near), (3, c), (5, [*c, "tail"])]
    got = {r.doc_id: r.component_id for r in jaccard_join.join(docs(spark, [" ".join(t) for _, t in rows], [i for i, _ in rows]), 3, 90, 100).collect()}
    assert got == {1: 1, 3: 1, 5: 1}


def test_pairs_are_made_once(spark, monkeypatch):
    """The plan that made the pairs is in no other plan and there but once, so the driver's memory doesn't grow with how often they are read."""
    plans = {}

    def staged(df, label, *rest):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString().count("Range (")
        return common.stage(df, label, *rest)

    monkeypatch.setattr(jaccard_join, "stage", staged)
    texts = docs(spark, ["a b c d", "a b c d e", "x y z"])
    pairs = spark.range(1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert jaccard_join.verify(pairs, texts, 2, 50, 100).collect() == [(0, 1)]
    assert max(plans.values()) == sum(plans.values()) == 1


def test_many_heavy_shingles_are_joined(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PICKED", 0)
    monkeypatch.setattr(common, "BROADCAST", 0)
    monkeypatch.setattr(jaccard_join, "HEAVY", 1)
    texts = [f"a b c d e f g h i j k l m n o p q r s t u v w{i % 3}" for i in range(6)]
    got = [(r.n_shingles, r.component_id) for r in jaccard_join.join(docs(spark, texts), 3, 90, 100).orderBy("doc_id").collect()]
    assert got == brute_components(texts, 3, 90, 100)


def test_sizes_that_can_link_are_in_bands_side_by_side(spark):
    sizes = [(n, m) for n in (1, 7, 9, 10, 90, 81, 100, 900, 12345) for m in (n, -(-n * 9 // 10), n * 10 // 9)]
    rows = spark.createDataFrame(sizes, "n long, m long").select(F.abs(jaccard_join.bands(F.col("n"), 90, 100) - jaccard_join.bands(F.col("m"), 90, 100)).alias("d"))
    assert rows.where("d > 1").count() == 0


def test_every_fitting_pair_meets_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng = random.Random(2)
    rows = [(0, i, i, rng.choice([50, 52, 55, 60, 70, 200])) for i in range(60)]
    size = {r[1]: r[3] for r in rows}
    met = {}
    for r in jaccard_join.meetings(spark.createDataFrame(rows, "token long, cid long, label long, n long"), 90, 100).collect():
        met.setdefault((r.i, r.j), []).append((r.cid, r.own))
    pairs = [frozenset((a, b)) for (i, j), m in met.items() for (a, x), (b, y) in itertools.combinations(m, 2) if i == j or x != y]
    assert len(pairs) == len(set(pairs))
    assert all(frozenset((a, b)) in set(pairs) for a, b in itertools.combinations(size, 2) if min(size[a], size[b]) * 100 >= 90 * max(size[a], size[b]))


def test_a_shingle_that_thousands_hold(spark):
    """A passage in all of 2,000 texts, with near copies among them: as many links as components need, without every pair."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    own = [" ".join(rng.choices([f"q{i}" for i in range(50)], k=4)) for _ in range(40)]
    texts = [f"{passage} {own[i % 40]} {rng.choice(own[:3])}" for i in range(2000)]
    got = {r.doc_id: r.component_id for r in jaccard_join.join(docs(spark, texts), 3, 90, 100).collect()}
    distinct = sorted(set(texts), key=texts.index)
    label = {t: texts.index(distinct[c]) for t, (_, c) in zip(distinct, brute_components(distinct, 3, 90, 100))}
    assert got == {i: label[t] for i, t in enumerate(texts)}


def test_a_shingle_of_twenty_thousand_distinct_texts(spark):
    """A passage in 20,000 texts, all different: too few words of their own to keep it out of their prefixes, too many to be alike by it alone; each has one near copy."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} {' '.join(f'q{i // 2}x{k}' for k in range(4))} {'last' if i % 2 else 'end'}{i}" for i in range(20_000)]
    assert len(set(texts)) == len(texts) and brute_components(texts[:40], 3, 90, 100) == [(63, i - i % 2) for i in range(40)]
    got = jaccard_join.join(docs(spark, texts), 3, 90, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(i, 63, i - i % 2) for i in range(20_000)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 20)] + [(30, 31), (32, 31), (40, 40)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 31: 30, 32: 30}


# nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_permutation_index(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(2000, None, 0), (2020, [0.0] * 24, 0), (2040, [float("nan")] * 24, 0), (2060, [1.0, None], 0), (2080, [1.0] * 3, 0), (None, x[0].tolist(), 0)]
    got = permutation_index.search(vectors(spark, rows + bad), F.col("vec_id") % 20 == 0, 20).collect()
    scores = x.astype(np.float64) @ x.astype(np.float64).T
    right = 0
    for q in range(0, 1500, 20):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        order = [i for i in np.lexsort((np.arange(1500), -scores[q])) if i != q][:20]
        right += len({r.vec_id for r in own} & set(order))
        assert [r["rank"] for r in own] == list(range(1, 21)) and all(abs(r.score - scores[q, r.vec_id]) < 1e-9 for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
    assert right >= 0.9 * 20 * 75
    assert permutation_index.search(vectors(spark, []), F.col("vec_id") % 20 == 0, 20).count() == 0
    few = permutation_index.search(vectors(spark, rows[:5]), F.col("vec_id") % 20 == 0, 20).collect()
    assert len(few) == 4


@pytest.mark.parametrize("lot", [8192, 1])
def test_permutation_index_with_repeated_ids(spark, monkeypatch, lot):
    monkeypatch.setattr(permutation_index, "QUERIES", lot)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((460, 8))
    ids = [20] * 400 + [*range(21, 80), 0]  # most rows are the one query's own
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, x)] + [(25, x[404].tolist(), 0)] * 3 + [(20, x[0].tolist(), 0)]
    got = {}
    for r in permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 20 == 0, 20, least=30).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in (0, 20, 40, 60):
        best = {}
        for i, v, _ in rows:
            for j, w, _ in rows:
                if i == q != j:
                    best[j] = max(best.get(j, -1e9), float(np.dot(v, w)))
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21)) and len({v for _, v, _ in own}) == 20
        assert all(abs(s - best[v]) < 1e-9 for _, v, s in own)
        assert len({v for _, v, _ in own} & set(sorted(best, key=lambda j: (-best[j], j))[:20])) >= 18


# shards


def test_sharding(spark):
    texts = ["x" * (i % 50) for i in range(400)] + [None, "y" * 5000]
    limit = 700
    got = sharding.shards(docs(spark, texts), limit).collect()
    assert sorted(r.doc_id for r in got) == list(range(402))
    sizes, count = {}, {}
    for r in got:
        sizes[r.shard_id, r.page] = sizes.get((r.shard_id, r.page), 0) + r.n_bytes
        count[r.shard_id, r.page] = count.get((r.shard_id, r.page), 0) + 1
    assert all(s <= limit or count[k] == 1 for k, s in sizes.items()) and sum(r.oversized for r in got) == 1
    assert sharding.shards(docs(spark, []), limit).count() == 0


def test_shards_of_one_key_overflow(spark):
    got = sharding.shards(docs(spark, ["z" * 90] * 40 + ["a"], [7] * 40 + [None]), 500).collect()
    sizes = {}
    for r in got:
        sizes[r.shard_id, r.page] = sizes.get((r.shard_id, r.page), 0) + r.n_bytes
    assert len(got) == 41 and max(sizes.values()) <= 500


def test_shards_are_written_whole(spark, tmp_path):
    rows = [(i % 30, "t" * (i % 40), i, i) for i in range(90)] + [(None, "n", 1, 1), (None, None, 2, 2), (7, "t", None, None)]
    given = spark.createDataFrame(rows, "doc_id long, text string, page long, shard_id long")
    sharding.write(given, str(tmp_path / "out"), 100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*given.columns, "_shard_id", "_page"}
    assert sorted(map(str, back.select(given.columns).collect())) == sorted(map(str, given.collect()))
    assert back.groupBy("_shard_id", "_page").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b"), F.count("*").alias("n")).where("b > 100 and n > 1").count() == 0


def test_shards_deeper_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEP", 3)
    texts = ["x" * (i % 9) for i in range(300)]
    got = {r.doc_id: (r.shard_id, r.depth) for r in sharding.shards(docs(spark, texts), 40).collect()}
    monkeypatch.setattr(sharding, "STEP", 20)
    assert got == {r.doc_id: (r.shard_id, r.depth) for r in sharding.shards(docs(spark, texts), 40).collect()} and len(got) == 300


def test_shards_split_only_where_full(spark):
    made = sharding.directory(spark.createDataFrame([(0, 10), (1 << 58, 10), (1 << 59, 10)], "h long, bytes long"), 10).collect()
    assert sorted((r.depth, r.prefix) for r in made) == [(1, 1), (2, 0), (2, 1)]


# chats


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "[\\INST]", "\\\\n", "", None, "<<SYS>>\\<</SYS>>", "<<s>>"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(itertools.cycle(["user", "assistant"]), nasty))]
    rows += [(2, 0, "tool\n\\n", "x"), (2, 0, None, "y"), (3, 1, "user", "a"), (3, 0, "system", "s"), (3, 1, "user", "a"), (None, 0, "user", "n"), (None, 0, "user", "n")]
    talks = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    template = chat_format.Template()
    made = chat_format.render(chat_format.segments(talks, template))
    assert made.where("conv_id is null").count() == 2  # each a conversation of its own
    back = {r.conv_id: r for r in chat_format.read(made, template).collect()}
    rows = rows[:-1]
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        own = sorted(((t, r or "", x or "") for _, t, r, x in own))
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, x) for _, r, x in own]
        assert back[conv].trained == [x for _, r, x in own if r == "assistant"]
    assert {c: (r.valid, r.first_bad) for c, r in back.items()} == {1: (True, None), 2: (False, 1), 3: (False, 3), None: (True, None)}
    digests = {r.conv_id: r for r in chat_format.digest(chat_format.read(made, template)).collect()}
    said = "".join(f"{r}\n{t or ''}\n" for c, _, r, t in rows if c == 1)
    assert digests[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and digests[1].n_turns == len(nasty)
    assert digests[1].loss_chars == sum(len(t or "") for c, _, r, t in rows if c == 1 and r == "assistant")
    assert chat_format.digest(chat_format.read(made.limit(0), template)).count() == 0


# rollups


def test_rollup(spark, tmp_path):
    texts = ["a b", "a b", None, "c " * 50]
    counted = token_rollup.counts(docs(spark, texts), tokenizer_path()).cache()
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {i: len(tokens(t)) for i, t in enumerate(texts)}
    store = token_rollup.Rollup(spark, str(tmp_path / "r"))
    assert store.totals().count() == 0
    n = sum(len(tokens(t)) for t in texts)
    assert store.commit("b1", token_rollup.inserts(counted, "v1")) and not store.commit("b1", token_rollup.inserts(counted, "v1"))
    assert [tuple(r) for r in store.totals().collect()] == [(None, "en", "v1", 4, n)]
    store.commit("b2", token_rollup.revisions(counted, "v1", F.col("tokens_after") + 1))
    store.compact()
    assert not store.commit("b2", token_rollup.revisions(counted, "v1", F.col("tokens_after") + 1))
    store.commit("b3", token_rollup.deletes(counted.withColumn("n_tokens", F.col("n_tokens") + 1).where("doc_id < 2"), "v1"))
    assert [tuple(r) for r in store.totals().collect()] == [(None, "en", "v1", 2, n + 4 - 2 * (len(tokens("a b")) + 1))]
    (tmp_path / "r/deltas/batch=b4").mkdir()  # what a failed attempt left
    assert store.commit("b4", token_rollup.deltas(token_rollup.inserts(counted, "v1")).limit(0).selectExpr("'insert' kind", "source", "lang", "tokenizer", "tokens tokens_before", "tokens tokens_after"))
    store.compact()
    assert store.totals().count() == 1
    with pytest.raises(Exception):
        store.commit("b5", token_rollup.inserts(counted, "v1").withColumn("kind", F.lit("merge")))


def test_revisions_that_move(spark, tmp_path):
    made = spark.createDataFrame([("insert", "web", "en", "v1", None, 5, None), ("insert", None, "en", "v1", None, 3, None)], f"{token_rollup.CHANGES}, before struct<source:string,lang:string,tokenizer:string>")
    store = token_rollup.Rollup(spark, str(tmp_path / "r"))
    store.commit("a", made)
    web = spark.createDataFrame([(1, "web", "en", 5)], "doc_id long, source string, lang string, n_tokens long")
    store.commit("b", token_rollup.moves(web, "v1", source=F.lit("book"), after=F.lit(7).cast("long")))
    assert sorted(map(tuple, store.totals().collect()), key=str) == [("book", "en", "v1", 1, 7), (None, "en", "v1", 1, 3)]
    null = spark.createDataFrame([(2, None, "en", 3)], "doc_id long, source string, lang string, n_tokens long")
    store.commit("c", token_rollup.moves(null, "v1", lang=F.lit("de")).unionByName(token_rollup.deletes(null, "v1").withColumn("before", F.lit(None).cast("struct<source:string,lang:string,tokenizer:string>")).limit(0)))
    assert sorted(map(tuple, store.totals().collect()), key=str) == [("book", "en", "v1", 1, 7), (None, "de", "v1", 1, 3)]


def test_rollup_query(spark):
    from driftline.llm import queries

    sf = "/root/testdata/sf0.001"
    gone = {r.doc_id for r in common.table(spark, sf, "labels").where("toxic = 1").collect()}
    want = {}
    for r in common.table(spark, sf, "documents").collect():
        if r.doc_id not in gone:
            n, t = want.get((r.source, r.lang), (0, 0))
            want[r.source, r.lang] = (n + 1, t + len(tokens(r.text)) + 1)
    got = {(r.source, r.lang): (r.docs, r.tokens) for r in queries.op10_token_rollup(spark, sf).collect()}
    assert got == want


# toxicity


@functools.cache
def distance(x, y):
    d = [[max(i, j) if not i or not j else 0 for j in range(len(y) + 1)] for i in range(len(x) + 1)]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (x[i - 1] != y[j - 1]))
            if i > 1 and j > 1 and x[i - 1] == y[j - 2] and x[i - 2] == y[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton():
    lexicon = toxicity.Lexicon({w: tuple(v * x for x in toxicity.DISCOUNT) for w, v in {"stupid": 3.0, "worthless": 4.0, "scum": 2.0, "disgusting": 2.5}.items()}, {"lowei": 5.0})
    automaton = toxicity.Automaton(lexicon)
    rng = random.Random(1)
    for _ in range(3000):
        w = list(rng.choice([*lexicon.words, "lowei", "loweixyz"]))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            w[i : i + rng.randint(0, 2)] = rng.choices("abstu", k=rng.randint(0, 2)) or w[i : i + 2][::-1]
            w = w or ["a"]
        w = "".join(w)
        near = [(v[distance(w, e)], distance(w, e), e) for e, v in lexicon.words.items() if distance(w, e) <= toxicity.Automaton.allowed(len(e))]
        near += [(v, 0, e) for e, v in lexicon.stems.items() if w.startswith(e)]
        got = automaton.match(w)
        assert (got and got[0]) == (max(near)[0] if near else None), w


def brute_sums(lexicon, text):
    """Plainly: every word against every entry by edit distance, every quotation mark by hand."""
    low = "".join(c for c in (text or "").lower() if c not in "\u00ad\u200b\u2060\ufeff")
    words = list(re.finditer(toxicity.WORD, low))
    fold = lambda w: w if w.isalpha() else "".join({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}.get(c, c) for c in w if c not in ".-_* ")
    found = {}
    for i, m in enumerate(words):
        near = []
        for w in [fold(m[0])] + ([fold(p) for p in m[0].split("-") if p] if "-" in m[0] else []):
            for e, v in lexicon.words.items():
                most = toxicity.Automaton.allowed(len(e))
                # an edit changes the length by one at most, and the set of letters by two
                if abs(len(w) - len(e)) <= most and len(set(w) ^ set(e)) <= 2 * most and distance(w, e) <= most:
                    near.append(v[distance(w, e)])
            near += [v for e, v in lexicon.stems.items() if w.startswith(e)]
        if near and max(near) > 0:
            found[i] = max(near)
    spans, opened = [], None
    letter = lambda k: 0 <= k < len(low) and (low[k].isalnum() or low[k] == "_")
    for k, c in enumerate(low):
        if c == "\n" and re.match(r"\n[^\S\n]*\n", low[k:]):
            opened = None
        begins, ends = not letter(k - 1) and letter(k + 1), k > 0 and not low[k - 1].isspace() and not letter(k + 1)
        can_close, can_open = c not in "'’" or (ends and not begins), c not in "'‘" or begins
        if opened and c == opened[1] and can_close:
            spans.append((opened[0], k))
            opened = None
        elif c in toxicity.CLOSING and can_open and (opened is None or (opened[1] in "'’" and c not in "'‘")):
            opened = (k, toxicity.CLOSING[c])
    out = np.zeros((3, 2))
    for i, v in found.items():
        m = words[i]
        begin = low.rfind("\n", 0, m.start()) + 1
        inside = any(a < m.start() and m.end() <= b for a, b in spans)
        before = [w[0] for w in words if begin <= w.start() and w.end() <= m.start()][-4:]
        told = any(w in toxicity.REPORTING for w in before)
        out[2 if inside else 1 if told else 0, int(any(j != i and abs(i - j) <= toxicity.WINDOW for j in found))] += v
    return out


def test_scores_against_brute_force():
    lexicon = toxicity.Lexicon({w: tuple(v * x for x in toxicity.DISCOUNT) for w, v in {"stupid": 3.0, "worthless": 4.0, "scum": 2.0, "idiots": 2.5}.items()}, {"lowei": 5.0})
    scorer, rng = toxicity.Scorer(lexicon), random.Random(6)
    bits = ["stupid", "stup1d", "s.t.u.p.i.d", "w_orthless", "id1ots", "scum", "loweix", "said", "word", '"', "“", "”", "„", "«", "»", "\n", "clean", "words", "a.b", "x-y-z", "don't", "2nd", "@", "l'idiots", "stpuid!!!", "s t u p i d", "stu-pid", "scum-like", "stu\u200bpid", "w\u00adorthless", "'", "‘", "’", "'scum", "scum'", "\n\n", "\n \n", "a--b"]
    for _ in range(1500):
        text = rng.choice([" ", ""]).join(rng.choices(bits, k=rng.randint(0, 30))) if rng.random() < 0.2 else " ".join(rng.choices(bits, k=rng.randint(0, 30)))
        assert np.allclose(scorer.sums(text), brute_sums(lexicon, text)), text
    assert scorer.score(None) == scorer.score("") == 0


def test_quotations():
    factors = toxicity.Lexicon().factors
    scorer = toxicity.Scorer(toxicity.Lexicon({"stupid": (3.0, 0.0, 0.0)}))
    for gap in (1, 5, 40, 400):  # however far the marks are
        assert scorer.evidence('"' + "w " * gap + "stupid " + "w " * gap + '"') == pytest.approx(3 * factors[0])
    for quoted in ('"w\nstupid w"', "he: 'w stupid'", "‘don't be stupid’, w", "'tis \"w stupid w\""):  # over lines, in single marks, in double ones behind an apostrophe
        assert scorer.evidence(quoted) == pytest.approx(3 * factors[0]), quoted
    for plain in ('"w\n\nstupid w"', '"w" stupid "w"', "you stupid", "don't, stupid, don't", "the boys' stupid dogs'"):
        assert scorer.evidence(plain) == 3.0, plain
    for hidden in ("s t u p i d", "stu-pid", "stu\u200bpid", "s-t-u-p-i-d", "you s.t.u.p.i.d"):
        assert scorer.evidence(hidden) == 3.0, hidden
    assert scorer.evidence("said " + "x" * 5000 + " stupid") == pytest.approx(3 * factors[1])  # however long the words between
    assert scorer.evidence("the word stupid is rude") == pytest.approx(3 * factors[1])


def test_labels_count_for_all_that_have_them(spark):
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(100)] + [(3, 0)], "doc_id long, toxic int")
    rows, stands = toxicity.sample(docs(spark, ["x"] * 100), labels, "toxic", F.lit(True), 20)
    assert stands == {1: 1.0, 0: 4.5} and {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()} == {1: 10, 0: 20}
    e, y = np.array([0.0, 1, 2, 3]), np.array([0, 1, 0, 1])
    assert toxicity.cut(e, y, np.ones(4)) == (2.5, 1.0) and toxicity.cut(e, y, np.array([1, 5, 1, 1])) == (0.5, 1.0)


def test_toxicity(spark):
    rng = random.Random(7)
    texts, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(30)]
        if bad:
            words[rng.randrange(30)] = rng.choice(["terrible", "rotten", "vilesome"])
        texts.append(" ".join(words))
        marks.append(int(bad))
    texts += ["you are terible", 'they called it "terrible" once', "", None, "clean words"]
    d = docs(spark, texts)
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int")
    lexicon = toxicity.learn(d, labels, F.col("doc_id") % 5 != 0)
    assert set(lexicon.words) == {"terrible", "rotten", "vilesome"}
    got = {r.doc_id: r.score for r in toxicity.score(d, lexicon).collect()}
    assert all((got[i] >= 0.5) == bool(m) for i, m in enumerate(marks))
    assert 0 < got[401] < got[0] and 0 < got[400] and got[402] == got[403] == got[404] == 0
    kept = toxicity.keep(d, lexicon)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}
    assert {r.score for r in toxicity.score(d, toxicity.learn(d, labels.limit(0), F.lit(True))).collect()} == {0.0}
    long = docs(spark, ["clean " * 200_000 + "terrible", "clean " * 200_000], [1, 1])
    assert sorted(r.score >= 0.5 for r in toxicity.score(long, lexicon).collect()) == [False, True]
    none = docs(spark, [])
    assert toxicity.score(none, toxicity.learn(none, labels, F.lit(True))).count() == 0


@pytest.mark.parametrize("sf, least", [("sf0.01", 0.66), ("sf0.1", 0.92)])
def test_toxicity_on_held_out_rows(spark, sf, least):
    """Six of the 97 toxic documents at sf0.1, and two of the six at sf0.01, hold nothing that others of their label do."""
    from driftline.llm import queries

    got = queries.op1_toxicity(spark, f"/root/testdata/{sf}").join(common.table(spark, f"/root/testdata/{sf}", "labels"), "doc_id").where("held_out").collect()
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) >= least * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)


# quality


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    held = common.fold(F.col("doc_id"), 3) == 1
    space = quality.learn(d, labels, ~held)
    got = quality.score(d, space).join(labels, "doc_id").where(held).collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in got) >= 0.97 * len(got)
    odd = quality.score(docs(spark, ODD), space).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.score(docs(spark, ODD), None).collect()} == {0.5}
    assert quality.keep(docs(spark, ODD), None).columns == docs(spark, ODD).columns
    none = docs(spark, [])
    assert quality.learn(none, labels, F.lit(True)) is None and quality.score(none, space).count() == 0


def test_votes_against_brute_force():
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(80)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) + "!" * int(rng.integers(0, 4)) for _ in range(120)] + ["same text"] * 40
    rows = np.stack([quality.counts(t.encode()) for t in texts])
    y = np.arange(len(texts)) % 3 == 0
    each = np.where(y, 1.0, 2.5)
    space = quality.Space.fit(rows.copy(), y.astype(int), each)
    got = space.scores(rows)
    for i in range(0, len(texts), 7):
        mine = quality._unit(space.weighted(rows[i : i + 1], space.weight) @ space.basis)[0]
        cosine = np.array([float(np.float32(mine @ v)) for v in space.vectors])
        order = sorted(range(len(texts)), key=lambda j: (-cosine[j], j))[: quality.NEIGHBOURS]
        vote = [max(cosine[j], 0) ** 8 * each[j] for j in order]
        if np.sort(-cosine)[quality.NEIGHBOURS] - np.sort(-cosine)[quality.NEIGHBOURS - 1] > 1e-6:  # no tie that rounding decides
            assert got[i] == pytest.approx(sum(v for v, j in zip(vote, order) if y[j]) / sum(vote), abs=1e-4)
    assert space.prior == pytest.approx((y * each).sum() / each.sum())
    assert quality.nearest(np.array([[1.0, 3, 2, 3, 3], [5, 5, 5, 5, 5]]), 2).tolist() == [[1, 3], [0, 1]]


def test_an_operator_may_be_the_first_of_its_session(spark, monkeypatch):
    """It makes the package importable for its Python workers itself, though nothing before it has read a table in this session."""
    plain = {k: v for k, v in spark.sparkContext.environment.items() if k != "PYTHONPATH"}
    rows = docs(spark, ["one two three four five six"] * 3)
    first = {
        "near-duplicate join": lambda: jaccard_join.signatures(rows, 5, 80, 100),
        "stage": lambda: common.stage(rows, "test"),
        "packing": lambda: packing.pack(rows, tokenizer_path(), end_id=2, capacity=1024),
    }
    for name, step in first.items():
        monkeypatch.setattr(spark.sparkContext, "environment", dict(plain))
        step()
        assert common.ROOT in spark.sparkContext.environment.get("PYTHONPATH", ""), name


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    d = common.table(spark, sf, "documents")
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, d, sf)
        assert kept.columns == d.columns, name
        d = common.stage(kept, "test")
    assert 0 < d.count() < 200
    assert d.where(F.length("text") != F.col("n_chars")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, d, sf).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in d.select("doc_id").collect()}


def plain_votes(space, row):
    """The share of near neighbours' votes for 1, one document at a time."""
    mine = quality._unit(space.weighted(row[None].copy(), space.weight) @ space.basis)[0]
    cosine = space.vectors @ mine
    order = sorted(range(len(cosine)), key=lambda j: (-cosine[j], j))[: quality.NEIGHBOURS]
    votes = [(max(float(cosine[j]), 0) ** 8 * space.each[j], space.labels[j]) for j in order]
    total = sum(v for v, _ in votes)
    return sum(v for v, label in votes if label) / total if row.any() and total > 0 else space.prior


def test_pipeline_against_brute_force(spark):
    """All five stages on whole documents, each worked out plainly from what the plain one before it kept; only the learned models are shared."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    d, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    want = {r.doc_id: r.text for r in d.collect()}
    assert len(want) == d.count() >= 200

    lexicon = toxicity.learn(d, labels, common.fold(F.col("doc_id"), 5) != 0)
    evidence = {i: float(toxicity.weighed(brute_sums(lexicon, t), lexicon.factors)) for i, t in want.items()}
    want = {i: t for i, t in want.items() if evidence[i] < lexicon.threshold}

    space = quality.learn(d, labels, common.fold(F.col("doc_id"), 3) != 1)
    votes = {i: plain_votes(space, quality.counts((t or "").encode())) for i, t in want.items()}
    assert all(abs(v - 0.5) > 1e-3 for v in votes.values())  # none that rounding decides
    want = {i: t for i, t in want.items() if votes[i] >= 0.5}

    ids = sorted(want)
    want = {i: want[i] for i, (n, c) in zip(ids, brute_components([want[i] for i in ids], 5, 80, 100)) if not n or ids[c] == i}

    found = windows([(r.item_id, r.text) for r in common.table(spark, sf, "benchmark").collect()])
    cut = {i: without_hits(t, found) for i, t in want.items()}
    want = {i: t for i, t in cut.items() if t.strip() or not want[i].strip()}
    assert 0 < len(want) < 200

    rows = corpus_pipeline.run(spark, sf).collect()
    lengths = {i: len(tokens(t)) + 1 for i, t in want.items()}
    check_packing(rows, list(lengths.values()), 1024)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(want)
    for i, parts in by.items():
        own = np.array(tokens(want[i]) + [2], "<u4")
        assert [(r.piece, r.start) for r in sorted(parts, key=lambda r: r.piece)] == list(zip(range(len(parts)), np.cumsum([0] + [r.length for r in sorted(parts, key=lambda r: r.piece)])[:-1].tolist()))
        assert all(r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes()) for r in parts) and sum(r.length for r in parts) == len(own)


def test_pipeline_on_odd_rows(spark):
    """Every stage keeps rows with null and empty texts, null and repeated ids, ties and very long texts, and columns that are named like those within."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    clean = [r.text for r in common.table(spark, sf, "documents").join(common.table(spark, sf, "labels").where("quality = 1 and toxic = 0"), "doc_id").limit(6).collect()]
    texts = [None, "", " ", *clean, clean[0], " ".join(clean * 40)]
    ids = [None, None, 5, 5, *range(10, 10 + len(texts) - 5), 10]
    names = ["n", "row", "part", "turn", "label", "y", "place", "token", "cid", "hits", "length", "page", "shard_id"]
    rows = [(i, t, *[k] * len(names)) for k, (i, t) in enumerate(zip(ids, texts))]
    schema = "doc_id long, text string, " + ", ".join(f"{n} long" for n in names)
    d = spark.createDataFrame(rows, schema).coalesce(2)
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = common.stage(step(spark, d, sf), "odd")
        assert kept.columns == d.columns and {r.n for r in kept.collect()} <= {r.n for r in d.collect()}, name
        if name == "n-gram Jaccard join":
            assert {r.n for r in kept.collect()} == {r.n for r in d.collect()} - {len(clean) + 3}  # the copy of the first
        else:
            assert kept.where("n in (0, 1)").count() == 2, name
        d = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, d, sf).collect()
    assert len({(r.doc_id, r.piece) for r in packed if r.doc_id is not None}) <= len(packed) and len([r for r in packed if r.piece == 0]) == d.count()
    none = spark.createDataFrame([], schema)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, none, sf).count() == 0, name


def test_near_copies_carry_any_column(spark):
    import corpus_pipeline

    text = "a b c d e f g h i j"
    rows = spark.createDataFrame([(2, text, 77, 1), (1, text, 78, 2), (3, "other words", 79, 3)], "doc_id long, text string, __row long, `a.b` int")
    kept = corpus_pipeline.drop_near_copies(spark, rows, None)
    assert kept.columns == rows.columns
    assert sorted(map(tuple, kept.collect())) == [(1, text, 78, 2), (3, "other words", 79, 3)]


def test_near_copies_go_by_row(spark):
    import corpus_pipeline

    rng = random.Random(4)
    a, b, c, d, e = (" ".join(rng.choices(WORDS, k=60)) for _ in range(5))
    rows = [(7, a), (7, a), (3, b), (9, b + " more"), (9, c), (None, d), (None, d), (None, e), (1, e), (5, None), (5, None), (None, ""), (2, "x")]
    own = docs(spark, [t for _, t in rows], [i for i, _ in rows]).coalesce(1)
    kept = corpus_pipeline.drop_near_copies(spark, own, "")
    assert kept.columns == own.columns
    want = [(7, a), (3, b), (9, c), (None, d), (1, e), (5, None), (5, None), (None, ""), (2, "x")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
