"""N-gram Jaccard join by grouped prefixes, and the components of its links.

Documents with equal shingle sets form a class, represented by its smallest doc_id. Under one order of all shingles two sets
that link share a shingle in their prefixes (size - ceil(t * size) + 1 shingles). Classes with the same prefix and size form a
group; the join posts groups, not members, under their prefix shingles, and then expands groups and verifies members on whole sets.

The order is (heavy, hash): a shingle that more than ``HEAVY`` classes hold, among their smallest hashes or in sets of which too few
of the smallest are not heavy, comes last. So a passage that many documents share is in few prefixes, and under a shingle that
isn't heavy there are at most a few times ``HEAVY`` classes, whose pairs are made at once. Any fixed order gives all links.

Under a heavy shingle no pairs are made. Members are first verified against one centre, and the components of all links so far
labelled; then only shingles whose members differ in label are taken up again, their members compared in blocks on whole sets, and
of the links found as many kept as connect the labels. A link inside a component cannot change the components.

Defined cases: null and empty texts, and texts without words, have no shingles and link with nothing; so does a null doc_id, whose
component is null; rows with one doc_id are one node; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few, mapped, plain, slices, small, stage
from .components import components
from .shingling import shingle_sets

#: A shingle that more classes hold is heavy.
HEAVY = 5
#: Members of a heavy shingle, and shingles that their sets hold together, in one of the two blocks that a task compares with each other.
#: A larger set is a block of its own, about.
BLOCK, WEIGHT = 500, 200_000
#: Documents that one task verifies against another.
STAR = 200
#: Heavy shingles, of eight bytes each, that are sent to every task; beyond that they are joined.
PICKED = 1_000_000

SIGNATURES = "doc_id bigint, n bigint, set_key binary, low array<bigint>"


def _prefix(n: Column, num: int, den: int) -> Column:
    """size - ceil(num / den * size) + 1"""
    return n - F.floor((n * num + (den - 1)) / F.lit(den)).cast("long") + 1


def _size_fits(a: Column, b: Column, num: int, den: int) -> Column:
    return (a * num <= b * den) & (b * num <= a * den)


def signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """For each document its set's size, digest and smallest hashes: a prefix, a quarter more, and eight."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, keys, low = [], [], []
            for s in shingle_sets(batch.column("text"), k):
                n = len(s)
                p = n - (n * num + den - 1) // den + 1
                sizes.append(n)
                keys.append(_digest(s))
                low.append(s[: p + p // 4 + 8] if n else s)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(low)], ["doc_id", "n", "set_key", "low"])

    return mapped(docs, sign, SIGNATURES)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64)))


def pick(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` joined with ``wanted`` on doc_id. Few wanted rows are broadcast, so that documents are not shuffled for them."""
    return docs.join(small(wanted), "doc_id")


def whole_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """cid, set_key, n and the whole set of each of ``classes(cid, set_key)``, as ``low``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            own = list(shingle_sets(batch.column("text"), k))
            keys = pa.array([_digest(x) for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), keys, pa.array([len(x) for x in own], pa.int64()), _lists(own)], ["cid", "set_key", "n", "low"])

    rows = pick(docs, classes.select(F.col("cid").alias("doc_id")).distinct()).select("doc_id", "text")
    rows = mapped(rows, unpack, "cid bigint, set_key binary, n bigint, low array<bigint>")
    return rows.join(small(classes.select("cid", "set_key")), ["cid", "set_key"], "left_semi")


def divide(classes: DataFrame, heavy: DataFrame) -> DataFrame:
    """``classes`` with ``low`` in two parts, ``cool`` and ``hot``. So few heavy shingles that ``PICKED`` bounds them are sent to the tasks; more are joined."""
    if heavy.count() > PICKED:
        hot = classes.select("cid", "set_key", F.explode("low").alias("token")).join(heavy, "token").groupBy("cid", "set_key").agg(F.array_sort(F.collect_set("token")).alias("hot"))
        known = classes.join(hot, ["cid", "set_key"], "left").withColumn("hot", F.coalesce("hot", F.array().cast("array<bigint>")))
        return known.withColumn("cool", F.array_except("low", "hot"))
    sent = classes.sparkSession.sparkContext.broadcast(np.sort(heavy.toArrow().column("token").to_numpy()))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            low = batch.column("low")
            flat = low.flatten().to_numpy(zero_copy_only=False)
            is_hot = np.isin(flat, table, kind="sort") if len(table) else np.zeros(len(flat), bool)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(low).to_numpy(zero_copy_only=False))]).astype(np.int64)
            hots = np.concatenate([[0], np.cumsum(is_hot)])[ends]
            parts = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat[keep])) for at, keep in ((ends - hots, ~is_hot), (hots, is_hot))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *parts], [*batch.schema.names, "cool", "hot"])

    classes = classes.select("cid", "set_key", "n", "low")
    return mapped(classes, split, "cid bigint, set_key binary, n bigint, low array<bigint>, cool array<bigint>, hot array<bigint>")


def verify(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link.

    The texts of a pair meet under its ``a``; an ``a`` with many pairs is dealt to several tasks. A task holds one such document at
    a time, and the texts that come after it are compared with it one by one.
    """
    # written, as it is read three times here: else one plan holds all that made the pairs four times over, and the driver with it
    pairs = stage(pairs, "candidates")
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("parts"))
    # so small a table that its join is broadcast below Spark's threshold and else splits by ``a``
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("doc_id"), F.lit(1).alias("turn"))
    homes = dealt.select("a", "part", F.col("a").alias("doc_id"), F.lit(0).alias("turn")).distinct()
    wanted = stage(dealt.union(homes), "pairs")
    met = pick(docs, wanted).repartition("a", "part").sortWithinPartitions("a", "part", "turn").select("a", "part", "turn", "doc_id", "text")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, home = None, []
        for batch in slices(batches, "text"):
            a, part, turn, b = (batch.column(c).to_pylist() for c in ("a", "part", "turn", "doc_id"))
            left, right = [], []
            for i, s in enumerate(shingle_sets(batch.column("text"), k)):
                if (a[i], part[i]) != at:
                    at, home = (a[i], part[i]), []
                if not turn[i]:
                    home.append(s)
                elif any(_links(s, x, num, den) for x in home):
                    left.append(a[i])
                    right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return mapped(met, links, "a bigint, b bigint").distinct()


def _links(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    if not len(x) or not len(y) or len(x) * num > len(y) * den or len(y) * num > len(x) * den:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


def prefixes(classes: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """cid, n, ``cool`` and ``hot``: the prefix of each class under (heavy, hash), in its two parts.

    A class is short if the smallest hashes hold too few shingles that aren't heavy; then its whole set counts. That can make more
    shingles heavy and more classes short, so it is done again until no class is new; each round reads the new short classes alone.
    So a shingle that isn't heavy is held by ``HEAVY`` classes at most among the smallest hashes, and as many more for each round.
    """
    p = _prefix(F.col("n"), num, den)
    tokens = lambda rows: rows.select(F.explode("low").alias("token"))
    frequent = lambda rows: tokens(rows).groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > HEAVY).select("token")
    heavy = stage(frequent(classes), "heavy")
    short = None
    while True:
        known = divide(classes, heavy)
        lacking = known.where((F.size("cool") < p) & (F.size("low") < F.col("n"))).select("cid", "set_key")
        new = stage(lacking if short is None else lacking.join(small(short), ["cid", "set_key"], "left_anti"), "short")
        if new.isEmpty():
            break
        short = new if short is None else short.union(new)
        heavy = stage(heavy.union(frequent(whole_sets(docs, new, k))).distinct(), "heavy")
    usual = known if short is None else known.join(small(short), ["cid", "set_key"], "left_anti")
    both = usual if short is None else usual.unionByName(divide(whole_sets(docs, short, k), heavy))
    return both.select("cid", "n", F.slice("cool", 1, p.cast("int")).alias("cool"), F.slice("hot", 1, F.greatest(F.lit(0), p - F.size("cool")).cast("int")).alias("hot"))


def _fits(n: Column, i: Column, m: Column, j: Column, num: int, den: int) -> Column:
    """Sizes that can link, if the shingle at places i and j (from 0) is the first that both have."""
    need = F.ceil((n + m) * num / F.lit(num + den))
    return _size_fits(n, m, num, den) & (1 + F.least(n - i - 1, m - j - 1) >= need - 1e-6)


def near_pairs(posts: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of groups under shingles that aren't heavy; such a shingle's list is bounded by a few times ``HEAVY``."""
    rows = posts.select("gid", "n", F.posexplode("cool").alias("at", "token"))
    lists = rows.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("gid", "n", "at"))).alias("m")).where(F.size("m") > 1)
    first = lists.select("m", F.explode("m").alias("x"))
    pair = first.select("x", F.explode(F.filter("m", lambda y: (y["gid"] > F.col("x")["gid"]) & _size_fits(y["n"], F.col("x")["n"], num, den))).alias("y"))
    rows = pair.select(F.col("x.gid").alias("a"), F.col("x.n").alias("n"), F.col("x.at").alias("i"), F.col("y.gid").alias("b"), F.col("y.n").alias("m"), F.col("y.at").alias("j"))
    # the first common shingle decides
    seen = rows.groupBy("a", "b", "n", "m").agg(F.min("i").alias("i"), F.min("j").alias("j"))
    return seen.where(_fits(F.col("n"), F.col("i"), F.col("m"), F.col("j"), num, den)).select("a", "b")


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections. Shingles of few sets are counted pair by pair, the others by products of slices of the incidence matrix."""
    m = len(sets)
    out = np.zeros((m, m), np.float32)
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(m), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    of = of[order]
    begin = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0]))
    held = np.diff(np.append(begin, len(flat)))
    for size in range(2, 9):
        at = begin[held == size]
        for x in range(size):
            for y in range(x):
                np.add.at(out, (of[at + y], of[at + x]), 1)
    out += out.T
    large, sizes = begin[held > 8], held[held > 8]
    for c in range(0, len(large), 2048):
        b, n = large[c : c + 2048], sizes[c : c + 2048]
        column = np.repeat(np.arange(len(b)), n)
        x = np.zeros((m, len(b)), np.float32)
        x[of[np.repeat(b - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], column] = 1
        out += x @ x.T
    return out


def bands(n: Column, num: int, den: int) -> Column:
    """Sizes that can link are in one band or in two that are next to each other."""
    width = max(math.log(den / num) * 1.001, 1e-6)
    return F.floor(F.log(n) / width)


def meetings(members: DataFrame, num: int, den: int) -> DataFrame:
    """``members(token, cid, label, n)`` dealt to pairs of blocks (``i``, ``j``) of their token, ``own`` being the one a member is from.

    A token's members are dealt by band of sizes and, within a band, by hash into blocks that are bounded in members and in
    weight; blocks of one band meet each other and those of the next.
    """
    banded = members.withColumn("band", bands(F.col("n"), num, den))
    sizes = banded.groupBy("token", "band").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / WEIGHT)).alias("blocks"))
    name = lambda band, block: F.shiftleft(band, 32) + block
    dealt = banded.join(sizes, ["token", "band"]).withColumn("own", name(F.col("band"), F.pmod(F.xxhash64("cid"), F.col("blocks")))).drop("blocks")
    ways = dealt.withColumn("other", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1))))).drop("band")
    met = ways.join(sizes.withColumnRenamed("band", "other"), ["token", "other"])
    met = met.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("to", name(F.col("other"), F.col("block")))
    return met.select("token", "cid", "label", "own", F.least("own", "to").alias("i"), F.greatest("own", "to").alias("j"))


def _apart(block: pa.Table) -> np.ndarray:
    """Members that these two blocks bring together: of different labels, and not of one block unless it meets itself."""
    label, own = block["label"].to_numpy(), block["own"].to_numpy()
    apart = label[:, None] != label[None, :]
    return apart if block["i"][0] == block["j"][0] else apart & (own[:, None] != own[None, :])


def _needed(num: int, den: int):
    """Of two blocks of one shingle's members those that must be compared under it: some other of a different label has a size
    that fits, and no smaller heavy shingle in its prefix too, under which the two meet anyway."""

    def needed(block: pa.Table) -> pa.Table:
        wanted = ["token", "cid", "label", "own", "i", "j"]
        apart = _apart(block)
        if not apart.any():
            return block.select(wanted).slice(0, 0)
        n = block["n"].to_numpy()
        token = block["token"][0].as_py()
        hot = block["hot"].combine_chunks()
        flat, ends = hot.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(pc.list_value_length(hot).to_numpy(zero_copy_only=False))])
        less = [h[h < token] for h in (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))]
        fits = apart & (n[:, None] * num <= n[None, :] * den) & (n[None, :] * num <= n[:, None] * den)
        if sum(map(len, less)):
            fits &= common(less) == 0
        return block.select(wanted).filter(pa.array(fits.any(axis=1)))

    return needed


def _compare(k: int, num: int, den: int):
    """Links between different labels in two blocks of one shingle's members, as few as connect what they connect."""

    def compare(block: pa.Table) -> pa.Table:
        apart = _apart(block)
        cid, label = block["cid"].to_numpy(), block["label"].to_numpy()
        out: tuple[list[int], list[int]] = ([], [])
        if apart.any():
            sets = [s for part in block["text"].chunks for s in shingle_sets(part, k)]
            n = np.array([len(s) for s in sets], np.float64)
            both = common(sets).astype(np.float64)
            linked = (den * both >= num * (n[:, None] + n[None, :] - both)) & apart & (label[:, None] < label[None, :])
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x, y in zip(*np.nonzero(linked)):
                a, b = find(label[x]), find(label[y])
                if a != b:
                    root[b] = a
                    out[0].append(cid[x])
                    out[1].append(cid[y])
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return compare


def linked(classes: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between classes, enough of them to connect every component."""
    posts = prefixes(classes, docs, k, num, den)
    posts = stage(posts.withColumn("prefix", F.md5(F.concat_ws(",", F.concat("cool", "hot").cast("array<string>")))), "posts")
    grouped = posts.groupBy("n", "prefix").agg(F.min("cid").alias("gid"))
    member = stage(posts.select("cid", "n", "prefix").join(grouped, ["n", "prefix"]).select("gid", "cid", "n", "prefix"), "members")
    others = member.where("gid <> cid")  # a cid is in several groups if its doc_id has several texts
    lists = posts.join(small(others), ["cid", "n", "prefix"], "left_anti").select(F.col("cid").alias("gid"), "n", "cool", "hot")

    # groups that are near, each member of one with each of the other; and members with their own group's first
    near = near_pairs(lists, num, den)
    expand = near.join(member.select(F.col("gid").alias("a"), F.col("cid").alias("x")), "a").join(member.select(F.col("gid").alias("b"), F.col("cid").alias("y")), "b")
    near = expand.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    own = others.select(F.col("gid").alias("a"), F.col("cid").alias("b"))
    # a group that posts a shingle which isn't heavy is as small as that shingle's list
    bounded = posts.where(F.size("cool") > 0).select("cid", "n", "prefix").join(grouped, ["n", "prefix"]).where("gid <> cid").select("gid", "cid")
    own = own.union(bounded.join(bounded.withColumnRenamed("cid", "y"), "gid").where("cid < y").select("cid", "y"))
    heavy = stage(lists.select("gid", "n", F.explode("hot").alias("token")), "heavy-posts")
    centre = heavy.groupBy("token").agg(F.min(F.struct("gid", "n")).alias("c"))
    star = heavy.join(centre, "token").where((F.col("gid") != F.col("c.gid")) & _size_fits(F.col("n"), F.col("c.n"), num, den)).select("gid", F.col("c.gid").alias("centre")).distinct()
    star = member.select("gid", "cid").join(star, "gid").select(F.col("centre").alias("a"), F.col("cid").alias("b"))
    first = stage(verify(near.union(own).union(star).distinct(), docs, k, num, den), "links")

    posted = posts.select("cid", "n", F.explode("hot").alias("token"))
    return first.union(across(posted, posts.where(F.size("hot") > 0).select("cid", "n", "hot"), first, docs, k, num, den))


def across(posted: DataFrame, lists: DataFrame, links: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The links that ``links`` lacks to connect all components: of members of one token, ``posted(token, cid, n)``, those whose labels differ are compared
    in blocks. ``lists(cid, n, hot)`` has each member's tokens, so that two that share several meet under one."""
    label = components(links, "a", "b")
    posted = posted.join(label.withColumnRenamed("node", "cid"), "cid", "left")
    posted = stage(posted.select("token", "cid", "n", F.coalesce("label", "cid").alias("label")), "labelled")
    mixed = posted.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("token")
    placed = meetings(stage(posted.join(mixed, "token"), "mixed"), num, den)
    with_hot = placed.join(lists, "cid")
    wanted = "token bigint, cid bigint, label bigint, own bigint, i bigint, j bigint"
    placed = stage(with_hot.groupBy("token", "i", "j").applyInArrow(_needed(num, den), wanted), "placed")
    met = pick(docs, placed.withColumnRenamed("cid", "doc_id")).withColumnRenamed("doc_id", "cid").select("token", "cid", "label", "own", "i", "j", "text")
    return met.groupBy("token", "i", "j").applyInArrow(_compare(k, num, den), "a bigint, b bigint").distinct()


def join(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, component_id for every document; two link when den * intersection >= num * union."""
    docs = plain(docs, "doc_id", "text")
    return by_class(stage(signatures(docs, k, num, den), "signatures"), lambda classes: linked(classes, docs, k, num, den))


def by_class(signed: DataFrame, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components of documents with ``n``, ``set_key`` and ``low``, staged. Documents of one set are a class, and ``link`` gives the links (a, b) of classes
    (cid, set_key, n, low)."""
    sound = signed.where("n > 0 and doc_id is not null")
    copied = stage(sound.groupBy("set_key").agg(F.min("doc_id").alias("cid"), F.count(F.lit(1)).alias("c")).where("c > 1").select("set_key", "cid"), "copied")
    held = few(copied)
    keys = F.broadcast(copied) if held else copied
    # copies are combined in each task before they are shuffled
    of_copies = sound.join(keys, "set_key", "left_semi").groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "low")).alias("r"))
    classes = sound.join(keys, "set_key", "left_anti").select(F.col("doc_id").alias("cid"), "set_key", "n", "low").unionByName(of_copies.select(F.col("r.doc_id").alias("cid"), "set_key", "r.n", "r.low"))
    links = link(classes if held else stage(classes, "class-rows"))
    # equal sets, and sets of rows with one doc_id, meet in a node
    same = sound.select("doc_id", "set_key").join(keys, "set_key").where("doc_id <> cid").select(F.col("cid").alias("a"), F.col("doc_id").alias("b"))
    label = components(links.union(same), "a", "b")
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(label, signed["doc_id"] == label["node"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))
