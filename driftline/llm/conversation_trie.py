"""The trie of conversations' prefixes, from the longest common prefixes (LCPs) of neighbours in sorted order.

A conversation is the sequence of its turns (role, text) by turn, null first, of equal turns by role and then by a digest of the text; a turn is told by an md5 of
both, so that a conversation takes 24 bytes for each turn. Equal sequences are one, with a count. Sorted, they are cut into blocks of bounded rows, and a
block knows the LCP of each row with the one before. A value v of that array is a node of depth v: its members are the rows between the nearest smaller values
on both sides, which a stack finds in one pass, entries of equal value being one node. For values whose nearest smaller one is in no row of the block, the block
minima, one number for each block in every task, tell the block that has it; that one answers from the short list of its prefix or suffix minima, all blocks at
once. What a node has to count is sums over its interval, of rows in the first and last block and of whole blocks in between. Then the depths between a node and
the node above it, which branch nowhere, are filled in.

What a node's ends hash to is the digest of a list, and so one stream; the list's text is made by many tasks in chunks, and a single task only
hashes the chunks of one node in order, holding one at a time.

Defined cases: null roles and texts are empty; rows with a null conv_id take no part, and an empty table has no nodes; rows that repeat a turn are turns of
their own; columns other than conv_id, turn, role and text are not read. The turns of one conversation are one row in a task.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, plain, stage

#: Bytes that tell a turn.
MARK = 16
#: Rows and bytes of keys in a block.
ROWS, BYTES = 20_000, 8 << 20
#: conv_ids in a chunk of a list's text.
IDS = 50_000
EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns, in order, as structs of mark and size (bytes of the text)."""
    rows = plain(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").fillna("", ["role", "text"])
    mark = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    cells = F.struct("turn", "role", mark.alias("mark"), F.octet_length("text").cast("bigint").alias("size"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(cells)).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["mark"], t["size"])).alias("turns"))


def rebuilt(own: DataFrame, base: Column, shared: Column) -> DataFrame:
    """Every conversation with the first ``shared`` turns of conversation ``base`` in place of its own first ones."""
    none = F.array().cast(own.schema["turns"].dataType)
    bases = own.select(F.col("conv_id").alias("base"), F.col("turns").alias("theirs"))
    joined = own.withColumns({"base": base, "h": shared.cast("int")}).join(bases, "base", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("theirs", none), 1, F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def sequences(talks: DataFrame) -> DataFrame:
    """conv_id, ``key`` (the turns' marks on end, whose order of bytes is that of sequences) and ``sizes``."""
    return talks.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["mark"]), "")).alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def lcp(x: bytes, y: bytes) -> int:
    """Turns that both begin with."""
    most = min(len(x), len(y)) // MARK
    if x[: most * MARK] == y[: most * MARK]:
        return most
    lo, hi = 0, most  # the first lo are equal, the first hi are not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if x[lo * MARK : mid * MARK] == y[lo * MARK : mid * MARK] else (lo, mid)
    return lo


SORTED = "block int, pos bigint, is_last boolean, key binary, sizes array<bigint>, conv bigint, n bigint, lcp bigint"


def sorted_blocks(talks: DataFrame) -> DataFrame:
    """The distinct sequences in order, in blocks, with the LCP of each with the one before it in its block."""
    distinct = stage(talks.groupBy("key", "sizes").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n")), "sequences")
    rows, size = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    blocks = max(1, -(-rows // ROWS), -(-size // BYTES))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pos, before, held = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_pylist()
            own = [None if x is None else lcp(x, y) for x, y in zip([before, *keys[:-1]], keys)]
            n = batch.num_rows
            cells = [pa.array([block] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()), pa.array([False] * n), *[batch.column(c) for c in ("key", "sizes", "conv", "n")], pa.array(own, pa.int64())]
            if held:
                yield held
            held, before, pos = pa.RecordBatch.from_arrays(cells, ["block", "pos", "is_last", "key", "sizes", "conv", "n", "lcp"]), keys[-1], pos + n
        if held:
            last = pa.array([False] * (held.num_rows - 1) + [True])
            yield held.set_column(2, "is_last", last)

    return stage(mapped(distinct.repartitionByRange(blocks, "key").sortWithinPartitions("key"), measure, SORTED), "sorted")


class Blocks:
    """For each block that has rows: its number, its first LCP (with the last row of the block before it, -1 where there is none) and its least one."""

    def __init__(self, rows: DataFrame):
        def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before = None
            for batch in batches:
                block, first = [], []
                for b, pos, last, key in zip(*(batch.column(c).to_pylist() for c in ("block", "pos", "is_last", "key"))):
                    if pos == 0:
                        block.append(b)
                        first.append(-1 if before is None else lcp(before, key))
                    if last:
                        before = key
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(first, pa.int64())], ["block", "first"])

        # two rows a block, in one task
        ends = rows.where("pos = 0 or is_last").select("block", "pos", "is_last", "key").repartition(1).sortWithinPartitions("block", "pos")
        firsts = mapped(ends, link, "block int, first bigint")
        least = rows.groupBy("block").agg(F.min("lcp").alias("inner"))
        found = firsts.join(least, "block").orderBy("block").toArrow()
        self.numbers, self.first = found["block"].to_numpy(), found["first"].to_numpy()
        self.least = np.array([min(f, f if i is None else i) for f, i in zip(self.first.tolist(), found["inner"].to_pylist())], np.int64)

    def place(self, block: int) -> int:
        return bisect.bisect_left(self.numbers, block)

    def left(self, at: int, value: int) -> int:
        """The nearest block before ``at`` (a place) that holds a smaller value; the first block always does."""
        return int(np.flatnonzero(self.least[:at] < value)[-1])

    def right(self, at: int, value: int) -> int:
        """The nearest after it, or how many blocks there are."""
        found = np.flatnonzero(self.least[at + 1 :] < value)
        return at + 1 + int(found[0]) if len(found) else len(self.least)


#: kind: ``edge`` (whole), ``open`` (an interval that leaves the block), ``left`` and ``right`` (answers to other blocks), ``block`` (sums).
#: lo and hi are places of blocks, lo_pos the interval's first row, x and y the smaller values at its sides; l_ and r_ what is counted in the first and
#: the last block, where they are known.
_LEFT = "l_n bigint, l_leaves bigint, l_w bigint, l_conv bigint"
_RIGHT = "r_n bigint, r_leaves bigint, r_w bigint, r_conv bigint"
LOCAL = f"kind string, place int, v bigint, upper bigint, equals bigint, lo int, lo_pos bigint, x bigint, hi int, y bigint, {_LEFT}, {_RIGHT}, key binary, sizes array<bigint>"
NAMES = [x.split()[0] for x in LOCAL.split(", ")]
FAR = 1 << 60


def _local(blocks: Blocks):
    """What a block knows of nodes: those whose interval lies in it, and of the others its part."""

    def local(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        at = blocks.place(rows["block"][0].as_py())
        keys, sizes, conv, n = (rows[c].to_pylist() for c in ("key", "sizes", "conv", "n"))
        k = len(keys)
        e = rows["lcp"].to_pylist()
        e[0] = int(blocks.first[at])
        after = int(blocks.first[at + 1]) if at + 1 < len(blocks.first) else -1
        nexts = [*e[1:], after]
        total = [sum(s) for s in sizes]
        head = [sum(s[: max(0, v)]) for s, v in zip(sizes, e)]  # bytes of the turns that the row before has too
        sums = [[0], [0], [0]]  # members, leaves; members' bytes without those of new nodes
        for i in range(k):
            for s, v in zip(sums, (n[i], len(keys[i]) // MARK > nexts[i], n[i] * total[i] - total[i] + head[i])):
                s.append(s[-1] + int(v))
        over = lambda a, b: [s[b] - s[a] for s in sums]  # noqa: E731  rows a to b - 1
        out: list[dict] = []

        def emit(v: int, left: int | None, right: int | None, least: int, equals: int) -> None:
            """A node of depth v; rows left to right - 1, where they are known."""
            if v < 1:
                return
            row = {"kind": "open" if left is None or right is None else "edge", "place": at, "v": v, "equals": equals}
            row |= {"lo": at, "lo_pos": left, "x": e[left], "key": keys[left][: v * MARK], "sizes": sizes[left][:v]} if left is not None else {"lo": blocks.left(at, v)}
            row |= {"hi": at, "y": e[right]} if right is not None else {"hi": blocks.right(at, v)}
            if left is not None:
                a, b, c = over(left, k if right is None else right)
                row |= {"l_n": a, "l_leaves": b, "l_w": c - head[left], "l_conv": least}
            if left is None and right is not None:
                row |= dict(zip(("r_n", "r_leaves", "r_w"), over(0, right))) | {"r_conv": least}
            if row["hi"] == len(blocks.first):
                row |= {"y": -1, "r_n": 0, "r_leaves": 0, "r_w": 0, "r_conv": FAR}
            out.append(row)

        # entries of the stack: value, first row, least conv of its rows (those of entries above it not yet counted), how often the value is met
        stack: list[list] = []
        for i in range(k):
            left, least = (i - 1, conv[i - 1]) if i else (None, conv[0])
            while stack and stack[-1][0] > e[i]:
                v, left, own, equals = stack.pop()
                least = min(own, least)
                emit(v, left, i, least, equals)
            if stack and stack[-1][0] == e[i]:
                stack[-1][2], stack[-1][3] = min(stack[-1][2], least, conv[i]), stack[-1][3] + 1
            else:
                stack.append([e[i], left, min(least, conv[i]), 1])
        least = conv[-1]
        for v, left, own, equals in reversed(stack):
            least = min(own, least)
            emit(v, left, None, least, equals)

        for i in range(k):  # what no other sequence shares
            x = max(e[i], nexts[i], 0)
            if len(keys[i]) // MARK > x:
                a, b, c = over(i, i + 1)
                out.append({"kind": "edge", "place": at, "v": len(keys[i]) // MARK, "equals": 0, "lo": at, "lo_pos": i, "x": x, "hi": at, "y": x, "l_n": a, "l_leaves": b, "l_w": c - head[i], "l_conv": conv[i], "key": keys[i], "sizes": sizes[i]})

        # suffix and prefix minima: the rows that are the nearest smaller ones for values up to ``upper``
        upper, least = FAR, FAR
        for i in range(k - 1, -1, -1):
            least = min(least, conv[i])
            if e[i] < upper:
                a, b, c = over(i, k)
                out.append({"kind": "left", "place": at, "v": e[i], "upper": upper, "lo_pos": i, "l_n": a, "l_leaves": b, "l_w": c - head[i], "l_conv": least, "key": keys[i], "sizes": sizes[i]})
                upper = e[i]
        upper, least = FAR, FAR
        for i in range(k):
            if e[i] < upper:
                a, b, c = over(0, i)
                out.append({"kind": "right", "place": at, "v": e[i], "upper": upper, "r_n": a, "r_leaves": b, "r_w": c, "r_conv": least})
                upper = e[i]
            least = min(least, conv[i])
        a, b, c = over(0, k)
        first = at == 0 and len(keys[0]) > 0
        out.append({"kind": "block", "place": at, "equals": sum(v == 0 for v in e) + first, "l_n": a, "l_leaves": b, "l_w": c, "l_conv": min(conv)})
        return pa.Table.from_pylist(out, _SCHEMA)

    return local


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (x.split() for x in LOCAL.split(", "))])


def _bridged(sums: pa.Table):
    """Nodes over several blocks, with the blocks between their first and last added from the sums of each block."""
    cums = [np.concatenate([[0], np.cumsum(sums[c].to_numpy())]) for c in ("l_n", "l_leaves", "l_w")]
    convs = sums["l_conv"].to_numpy()

    def bridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = (batch.column(c).to_numpy() for c in ("lo", "hi"))
            out = {c: batch.column(c) for c in ("v", "equals", "lo", "lo_pos", "x", "y", "key", "sizes")}
            for c, s in zip(("n", "leaves", "w"), cums):
                out[c] = pa.array(batch.column(f"l_{c}").to_numpy() + batch.column(f"r_{c}").to_numpy() + s[hi] - s[lo + 1])
            ends = np.minimum(batch.column("l_conv").to_numpy(), batch.column("r_conv").to_numpy())
            out["conv"] = pa.array([int(min(c, convs[a + 1 : b].min(initial=FAR))) for c, a, b in zip(ends, lo, hi)], pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    return bridge


EDGES = "v bigint, equals bigint, lo int, lo_pos bigint, x bigint, y bigint, key binary, sizes array<bigint>, n bigint, leaves bigint, w bigint, conv bigint"


def intervals(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that branch or end, with what is counted over their intervals (``EDGES``), and the sums of blocks."""
    blocks = Blocks(rows)
    found = stage(rows.groupBy("block").applyInArrow(_local(blocks), LOCAL), "intervals")
    whole = found.where("kind = 'edge'").select("v", "equals", "lo", "lo_pos", "x", "y", "key", "sizes", *[F.col(f"l_{c}").alias(c) for c in ("n", "leaves", "w", "conv")])
    sums = found.where("kind = 'block'")
    unresolved = found.where("kind = 'open'")
    side = lambda kind, columns: found.where(F.col("kind") == kind).select(F.col("place").alias("at"), F.col("v").alias("found"), F.col("upper").alias("up"), *[F.col(c).alias(f"{c}_") for c in columns])
    for kind, block, value, columns in (("left", "lo", "x", ["lo_pos", "l_n", "l_leaves", "l_w", "l_conv", "key", "sizes"]), ("right", "hi", "y", ["r_n", "r_leaves", "r_w", "r_conv"])):
        asked = F.col(value).isNull()
        known = unresolved.where(~asked)
        answered = unresolved.where(asked).join(side(kind, columns), (F.col(block) == F.col("at")) & (F.col("found") < F.col("v")) & (F.col("v") <= F.col("up")))
        unresolved = known.unionByName(answered.withColumns({value: F.col("found"), **{c: F.col(f"{c}_") for c in columns}}).select(known.columns))
    # blocks that hold a node's value each know it; they agree in all but how often
    same = ["v", "lo", "lo_pos"]
    rest = [c for c in NAMES if c not in (*same, "kind", "place", "upper", "equals")]
    merged = unresolved.groupBy(*same).agg(F.sum("equals").alias("equals"), *[F.first(c).alias(c) for c in rest])
    merged = merged.withColumns({"key": F.expr(f"substring(key, 1, cast(v * {MARK} as int))"), "sizes": F.slice("sizes", 1, F.col("v").cast("int"))})
    wide = mapped(merged, _bridged(sums.orderBy("place").toArrow()), EDGES)
    return whole.unionByName(wide), sums


def ends(talks: DataFrame) -> DataFrame:
    """id (md5 of a sequence's key) and the hash of the conv_ids that are this sequence."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, convs = batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()
            cut = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]] + [len(ids)]
            cut = sorted({*cut, *(c for a, b in zip(cut, cut[1:]) for c in range(a, b, IDS))})
            yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a in cut[:-1]]), pa.array([convs[a] for a in cut[:-1]], pa.int64()), pa.array([",".join(map(str, convs[a:b])) for a, b in zip(cut, cut[1:])])], ["id", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = ([], [])
            for id_, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                if id_ == at:
                    state.update(b"," + ids.encode())
                else:
                    if at is not None:
                        out[0].append(at)
                        out[1].append(state.hexdigest())
                    at, state = id_, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["id", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    rows = talks.select(F.md5("key").alias("id"), "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    texts = mapped(rows, chunks, "id string, first bigint, ids string").repartition("id").sortWithinPartitions("id", "first")
    return mapped(texts, digest, "id string, ends_sha256 string")


def nodes(talks: DataFrame) -> DataFrame:
    """A row for each node of the trie over ``talks(conv_id, turns)``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    talks = stage(sequences(talks), "talks")
    rows = sorted_blocks(talks)
    found, sums = intervals(rows)
    longer = F.when(F.col("has_more"), 1).otherwise(0)
    upper = F.greatest("x", "y", F.lit(0)).cast("int")
    id_ = lambda depth: F.md5(F.expr(f"substring(key, 1, cast({depth} * {MARK} as int))"))
    edges = stage(found.withColumn("u", upper).withColumns({"id": F.md5("key"), "parent": id_("u")}), "edges")
    # the first row of an interval is longer than the node is deep unless it ends there; a sequence's own id is the md5 of its whole key
    ended = stage(ends(talks), "ends")
    with_ends = edges.join(ended, "id", "left").withColumn("has_more", (F.col("equals") > 0) & F.col("ends_sha256").isNull())
    above = edges.where("equals > 0").select(F.col("id").alias("parent"), F.col("conv").alias("above"))
    top = sums.agg(F.min("l_conv").alias("root"))
    placed = with_ends.join(above, "parent", "left").crossJoin(F.broadcast(top)).withColumn("above", F.when(F.col("u") == 0, F.col("root")).otherwise(F.col("above")))
    # bytes down to the depth above each of the filled depths
    so_far = F.aggregate("sizes", F.array(F.lit(0).cast("bigint")), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))
    filled = placed.withColumn("children", F.col("equals") + longer).withColumn("before", F.slice(so_far, F.col("u") + 1, (F.col("v") - F.col("u")).cast("int")))
    filled = filled.select("*", F.posexplode("before").alias("i", "b")).withColumn("depth", F.col("u") + 1 + F.col("i"))
    here = F.col("depth") == F.col("v")
    below = filled.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), F.when(F.col("i") == 0, F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(here, F.col("children")).otherwise(1).cast("bigint").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("w") - (F.col("n") - 1) * F.col("b")).alias("saved_tokens"),
        F.when(here, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(F.lit(EMPTY)).alias("ends_sha256"),
    )
    whole = sums.agg(F.min("l_conv").alias("conv_id"), F.sum("l_n").alias("n_convs"), F.sum("equals").alias("n_children"), F.sum("l_leaves").alias("n_leaves"), F.sum("l_w").alias("saved_tokens")).where("n_convs > 0")
    root = whole.withColumn("id", F.md5(F.lit(b""))).join(ended, "id", "left")
    root = root.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    return below.unionByName(root)


def sql() -> str:
    """The nodes of rebuilt conversations by listing every prefix; crc32 by its table."""
    bit = "list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)"
    return f"""
    with crc as (select list({bit} order by i) as k from (select i::bigint as i from range(256) t(i))),
    t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
    own as (select conv_id, list(struct_pack(role := role, text := text) order by turn nulls first, role, text) as s from t group by conv_id),
    h as (select conv_id, s, (xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda a, b: xor(a >> 8, k[(xor(a, b) & 255) + 1])), 4294967295) % 9)::bigint as h from own, crc),
    built as (select h.conv_id, list_concat(coalesce(b.s, [])[1 : h.h], h.s[h.h + 1 :]) as s from h left join own b on b.conv_id = h.conv_id - h.conv_id % 5),
    pre as (select conv_id, d, s[1 : d] as p, s[1 : d - 1] as up, len(s) as n, coalesce(octet_length(encode(s[d].text)), 0) as bytes from (select *, unnest(range(0, len(s) + 1)) as d from built)),
    node as (select p, d, any_value(case when d > 0 then up end) as up, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
        string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = d) as ends from pre group by p, d),
    kids as (select up as p, count(*) as c from node where d > 0 group by up),
    full_ as (select n.*, coalesce(k.c, 0) as c from node n left join kids k on k.p = n.p),
    sub as (select p[1 : a] as p, sum((c = 0)::int) as leaves, sum((n_convs - 1) * bytes) as saved from (select *, unnest(range(0, d + 1)) as a from full_) group by 1)
    select f.conv_id, f.d::bigint as depth, u.conv_id as parent_conv_id, f.n_convs::bigint as n_convs, f.c::bigint as n_children, s.leaves::bigint as n_leaves,
        s.saved::bigint as saved_tokens, sha256(coalesce(f.ends, '')) as ends_sha256
    from full_ f join sub s on s.p = f.p left join node u on f.d > 0 and u.p = f.up"""
