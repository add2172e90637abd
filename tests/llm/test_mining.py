"""Min-max hashing, the conversation trie and collocations against brute force, with the cases their docstrings define."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from driftline.llm import collocations, common, conversation_trie, min_max

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string, `a.b` int"


@pytest.fixture(autouse=True, scope="module")
def ready(spark):
    common.table(spark, "/root/testdata/sf0.001", "documents")


def docs(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    return spark.createDataFrame([(i, t, g, None, None, "x", 1) for i, t, g in zip(ids, texts, langs)], DOCS)


# min-max hashing


def shingles(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def components(sets, num, den):
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in sets:
        for y in sets:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if den * both >= num * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((find(x), find(y)))
                    label[b] = a
    return {x: find(x) for x in sets}


def test_ends_estimate_without_bias_and_vary_less():
    rng = np.random.default_rng(5)
    a, b = min_max.permutations(32, 9)
    seen, single = [], []
    for _ in range(400):
        both, x, y = (np.unique(rng.integers(-(1 << 63), 1 << 63, n)) for n in (12, 3, 3))
        ends = min_max.ends([np.concatenate([both, x]), np.concatenate([both, y])], a, b)
        seen.append(min_max.similarity(*ends))
        c, d = min_max.permutations(64, int(rng.integers(1 << 30)))
        low = min_max.ends([np.concatenate([both, x]), np.concatenate([both, y])], c, d)[:, ::2]
        single.append(min_max.similarity(*low))
    assert abs(np.mean(seen) - 12 / 18) < 0.01 and abs(np.mean(single) - 12 / 18) < 0.01
    assert np.var(seen) < np.var(single)  # as many values, from half as many permutations


@pytest.mark.parametrize("k,num,block", [(3, 85, 500), (5, 80, 3)])
def test_near_copies(spark, monkeypatch, k, num, block):
    from driftline.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    random.seed(k)
    texts = ["", None, " \t", "one", "One", "one two", "a b c"]
    for group in range(12):
        base = [f"w{random.randrange(40)}" for _ in range(random.randrange(20, 60))]
        for _ in range(random.randrange(1, 14)):
            copy = list(base)
            for _ in range(random.randrange(4)):
                copy[random.randrange(len(copy))] = f"x{random.randrange(9)}"
            texts += [" ".join(copy)] * random.choice([1, 1, 3])
            base = copy if random.random() < 0.5 else base
    texts.append("long " * 3 + " ".join(map(str, range(90_000))))
    got = {r["doc_id"]: r for r in min_max.near_copies(docs(spark, texts), k, num, 100).collect()}
    sets = {i: shingles(t, k) for i, t in enumerate(texts)}
    want = components(sets, num, 100)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_copies_of_odd_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (7, text), (7, "q r s t"), (3, "q r s t"), (None, None), (9, text)]
    got = min_max.near_copies(docs(spark, [t for _, t in rows], [i for i, _ in rows]), 3, 85, 100)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 6, None, False), (7, 6, 3, False), (7, 2, 3, False), (3, 2, 3, True), (None, 0, None, False), (9, 6, 3, False)], key=str)
    assert min_max.near_copies(docs(spark, texts=[]), 3, 85, 100).count() == 0


def test_thousands_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(3000):  # all differ, each links with most others
        copy = list(base)
        copy[rng.randrange(80)] = f"own{i}"
        texts.append(" ".join(copy))
    got = min_max.near_copies(docs(spark, texts), 3, 85, 100)
    assert got.agg(F.max("component_id"), F.count_if("kept")).first()[:] == (0, 1)


# conversation trie


def trie(talks):
    """talks: conv_id -> list of (role, text)"""
    members, out = defaultdict(list), []
    for c, t in talks.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    for p, of in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        here = ",".join(str(c) for c in sorted(of) if len(talks[c]) == len(p))
        out.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), kids[p], sum(not kids[q] for q in below), saved, hashlib.sha256(here.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(spark, talks):
    return spark.createDataFrame([(c, i, r, t, 1) for c, s in talks.items() for i, (r, t) in enumerate(s)], "conv_id long, turn long, role string, text string, `key` int")


@pytest.mark.parametrize("rows,seed", [(20_000, 0), (1, 1), (2, 2), (3, 3), (7, 4)])
def test_trie(spark, monkeypatch, rows, seed):
    monkeypatch.setattr(conversation_trie, "ROWS", rows)
    monkeypatch.setattr(conversation_trie, "IDS", 2)
    rng = random.Random(seed)
    talks = {}
    for c in range(60):
        of = talks[rng.choice(list(talks))] if talks and rng.random() < 0.7 else []
        talks[c * 3 + 1] = of[: rng.randrange(len(of) + 1)] + [(rng.choice("ua"), rng.choice(["x", "yé", ""])) for _ in range(rng.randrange(1, 5))]
    talks[500] = talks[1]
    got = conversation_trie.nodes(conversation_trie.turns(rows_of(spark, talks)))
    assert sorted(map(tuple, got.collect()), key=str) == trie(talks)


def test_trie_of_rebuilt_and_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(5, 0, "u", "a"), (5, 1, None, None), (5, None, "first", "z"), (6, 0, "u", "a"), (6, 1, "u", "b"), (6, 2, "u", "c"), (12, 0, "u", "gone"), (None, 0, "u", "a"), (7, 0, "u", "a"), (7, 0, "u", "a")]
    own = conversation_trie.turns(spark.createDataFrame(rows, schema))
    base = [("first", "z"), ("u", "a"), ("", "")]
    assert {r["conv_id"]: len(r["turns"]) for r in own.collect()} == {5: 3, 6: 3, 12: 1, 7: 2}
    again = conversation_trie.rebuilt(own, F.col("conv_id") - F.col("conv_id") % 5, F.lit(2))
    # 12's base is not there, so it has no turns; 7 keeps nothing after its first two
    want = {5: base, 6: [*base[:2], ("u", "c")], 12: [], 7: base[:2]}
    assert sorted(map(tuple, conversation_trie.nodes(again).collect()), key=str) == trie(want)
    assert conversation_trie.nodes(own.limit(0)).count() == 0
    nothing = own.select("conv_id", F.slice("turns", 1, 0).alias("turns"))
    assert [r[:7] for r in map(tuple, conversation_trie.nodes(nothing).collect())] == [(5, 0, None, 4, 0, 1, 0)]


def test_lcp():
    m = [bytes([i]) * 16 for i in range(5)]
    for x, y, n in [([], [1], 0), ([1], [1], 1), ([1, 2], [1, 3], 1), ([1, 2, 3, 4], [1, 2, 3, 0], 3), ([0], [1], 0), ([1, 2], [1, 2, 3], 2)]:
        assert conversation_trie.lcp(b"".join(m[i] for i in x), b"".join(m[i] for i in y)) == n


# collocations


def mined(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("most", [200_000, 40, 1])
def test_collocations(spark, monkeypatch, most):
    monkeypatch.setattr(collocations, "MOST", most)
    rng = random.Random(most)
    words = ["the", "The", "of", "cat", "dog", "ñandú", "x\x00y", "sat on", "mat", "-"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, [30, 5, 20, 5, 5, 3, 2, 3, 4, 2], k=rng.randrange(40)))
        rows.append((rng.choice(["en", "de", None, "und"]), text.replace(" mat ", rng.choice([". ", ",\t", " \n", "\r", " mat "]))))
    rows += [("en", "of the cat sat and so")] * 50 + [("xx", None), ("xx", ""), ("en", " .;"), ("de", "the cat " * 30_000)]
    got = collocations.mine(docs(spark, [t for _, t in rows], langs=[g for g, _ in rows]), 10, 25)
    assert sorted(map(tuple, got.collect())) == mined(rows, 10, 25)


def test_collocations_of_nothing(spark):
    assert collocations.mine(docs(spark, []), 2, 5).count() == 0
    assert collocations.mine(docs(spark, ["a b a b", None]), 30, 5).count() == 0


def test_products_beyond_64_bits(spark):
    many = 3 * 10**18
    rows = spark.createDataFrame([("en", "a b", many)], "lang string, phrase string, a long")
    got = rows.select(F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div cast(a + a as decimal(20,0))")).first()[0]
    assert got == 1_000_000


def test_a_bitmap_says_yes_to_all_its_rows(spark):
    h = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    made = collocations.bitmap(spark.createDataFrame([(int(x),) for x in h], "h long"))
    assert collocations._held(made, h.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, 5000, np.uint64)
    assert collocations._held(made, other).mean() < 0.1


def cpu(work):
    def once():
        begun = time.process_time()
        work()
        return time.process_time() - begun

    return min(once() for _ in range(3))


def test_words_are_coded_and_hashed_at_little_more_than_splitting():
    rng = random.Random(3)
    texts = pa.array([" ".join(f"w{rng.randrange(10**9)}" for _ in range(500)) for _ in range(200)])
    langs = pa.array(["en"] * len(texts))
    split = cpu(lambda: pc.ascii_split_whitespace(texts).values.dictionary_encode())
    assert cpu(lambda: collocations.Tokens(texts, langs).hashes()) < 10 * split


def test_prefixes_are_cut_from_batches_at_little_cost():
    rows = pa.table({"lang": ["en"] * 100_000, "w1": [f"w{i // 9:06}" for i in range(100_000)], "w2": [f"x{i % 9}" for i in range(100_000)]} | {c: pa.nulls(100_000, pa.string()) for c in ("w3", "w4", "p2")} | {"n": [1] * 100_000})
    whole = cpu(lambda: collocations.Grown(rows, 30))
    assert cpu(lambda: list(collocations._grow(30)(iter(rows.to_batches(10_000))))) < 5 * whole


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_prefixes_that_go_on_in_other_batches(size):
    rng = random.Random(size)
    cells = sorted({(rng.choice(["de", "en"]), rng.choice("ab"), rng.choice("cde"), *rng.choice([(None, None), ("f", None), ("f", "g"), ("h", "g")])) for _ in range(60)}, key=str)
    split = [c[2] if c[:2] == ("en", "a") else None for c in cells]
    rows = pa.table({c: pa.array(x, pa.string()) for c, x in zip(["lang", *collocations.WINDOW, "p2"], [*zip(*cells), split])} | {"n": [rng.randrange(1, 9) for _ in cells]})
    want = Counter()
    for c, n in zip(cells, rows["n"].to_pylist()):
        for m in range(2, 5):
            if c[m]:
                want[(c[0], *c[1 : m + 1], *[None] * (4 - m))] += n
    got = [tuple(r.values()) for b in collocations._grow(6)(iter(rows.to_batches(size))) for r in b.to_pylist()]
    assert sorted(got, key=str) == sorted([(*p, n) for p, n in want.items() if n >= 6], key=str)
