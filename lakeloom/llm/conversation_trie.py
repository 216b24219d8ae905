"""Prefix trie of conversations: double arrays per prefix shard, upper nodes merged globally.

A turn's key is a 128-bit hash of role and text, a node's key the exclusive or of the keys
of (depth, turn) down to it, so that a running aggregate yields all nodes of a conversation
without holding it. Conversations that are equal go down the trie once, with their number.

Nodes with more than ``SHARD_ROWS`` turns at or below them are upper nodes. Below each, every
child that is none roots a shard: its conversations are in no other. A task takes a portion
of whole shards, gives their turns dense ids, and packs one double array: the child of node
s by turn t is BASE[s] + t, and CHECK of it is s. It walks all conversations through the
arrays together, which yields the nodes with their members, and sums subtrees level by
level. What the shards' roots hold is merged into the upper nodes, whose own subtrees are
summed by doubling the distance to the ancestor that is added to.

Defined cases: turns come in order of ``turn``, nulls first, then role, then hash of the
text. Null roles and texts are empty. Rows without conv_id are in no conversation. A
conversation that is rebuilt without turns is a member of the root only. An empty table has
no root. Repeated rows are turns of their own. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import with_columns
from lakeloom.session import pinned

PARTS = 6  # a conversation takes crc32(id) modulo this many turns from another
GROUP = 100  # of the one whose id is the next lower multiple of this
SHARD_ROWS = 20_000  # turns of distinct conversations that a shard holds at most
PORTION = 100_000  # turns that a task holds at a time, and one shard more
PIECE = 1 << 16  # characters of joined ids in a row
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "k1 long, k2 long, up1 long, up2 long, depth long, conv_id long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"
)


PIECES = "k1 long, k2 long, depth long, first long, n long, ids string"
ENDS = "k1 long, k2 long, depth long, conv_id long, n long, ends binary"


def _column(batch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


# -- running aggregates in order -----------------------------------------------------


def _running(key: str, lanes: list[str]):
    """Place within the key, and lanes combined by exclusive or up to the row, of rows in order of the key."""

    def run(batches):
        part = TaskContext.get().partitionId()
        last, count, held = None, 0, [np.int64(0)] * len(lanes)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _column(batch, key)
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            at = np.arange(1, len(keys) + 1) - np.repeat(start, np.diff(np.append(start, len(keys))))
            goes_on = int(start[1]) if len(start) > 1 else len(keys)
            same = keys[0] == last
            if same:
                at[:goes_on] += count
            columns = []
            for i, lane in enumerate(lanes):
                total = np.bitwise_xor.accumulate(_column(batch, lane))
                before = np.where(start > 0, total[start - 1], 0)
                total = total ^ np.repeat(before, np.diff(np.append(start, len(keys))))
                if same:
                    total[:goes_on] ^= held[i]
                held[i] = total[-1]
                columns.append(pa.array(total))
            last, count = keys[-1], int(at[-1])
            names = [*batch.schema.names, "__part", "__at", *(f"__{lane}" for lane in lanes)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(at), *columns], names=names
            )

    return run


def in_order(rows: DataFrame, key: str, order: list, lanes: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` plus ``__at``, the place within ``key`` (from 1), and for each lane ``__lane``, combined up to the row.

    Rows are dealt into ranges of (key, order); a key with many rows fills several, and what
    the ranges before hold of it is added afterwards.
    """
    added = [("__part", "integer"), ("__at", "long"), *((f"__{lane}", "long") for lane in lanes)]
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    local = pinned(ranged.mapInArrow(_running(key, list(lanes)), with_columns(rows.schema, *added)))
    ends = local.groupBy(key, "__part").agg(
        F.max("__at").alias("n"), *[F.max_by(f"__{lane}", "__at").alias(lane) for lane in lanes]
    )
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        key, "__part", F.sum("n").over(before).alias("__n"), *[F.bit_xor(lane).over(before).alias(f"__of_{lane}") for lane in lanes]
    )
    offsets = pinned(offsets.filter("__n is not null"))  # of keys in several ranges only
    out = local.join(offsets, [key, "__part"], "left").withColumn("__at", F.col("__at") + F.coalesce("__n", F.lit(0)))
    for lane in lanes:
        out = out.withColumn(f"__{lane}", F.col(f"__{lane}").bitwiseXOR(F.coalesce(f"__of_{lane}", F.lit(0))))
    return out.drop("__part", "__n", *[f"__of_{lane}" for lane in lanes])


# -- conversations -------------------------------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, t1, t2 (hash of role and text), size (code points of the text), __at (place from 1)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.char_length(text).cast("long").alias("size"),
    ).filter("conv_id is not null")
    return in_order(rows, "conv_id", [F.asc_nulls_first("turn"), F.col("role"), F.col("t1"), F.col("t2")]).drop("turn", "role")


def rebuilt(turns: DataFrame, parts: int = PARTS, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every conversation as rebuilt, and its turns: conv_id, length, depth, t1, t2, size."""
    turns = turns.withColumnRenamed("__at", "at")
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("at") < parts)).groupBy(F.col("conv_id").alias("base"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("at", "t1", "t2", "size"))).alias("first"))  # parts - 1 at most
    taken = F.crc32(F.col("conv_id").cast("string")) % parts
    convs = turns.groupBy("conv_id").agg(F.max("at").alias("n")).withColumn("taken", taken)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")
    got = F.least(F.col("taken"), F.coalesce(F.size("first"), F.lit(0))).cast("long")
    got = F.when(F.col("first").isNull(), F.lit(0)).otherwise(got)
    convs = convs.withColumn("got", got).withColumn("length", F.col("got") + F.greatest(F.col("n") - F.col("taken"), F.lit(0)))
    convs = pinned(convs.select("conv_id", "length", "taken", "got", F.slice("first", F.lit(1), F.col("got").cast("int")).alias("first")))
    own = turns.join(convs.select("conv_id", "length", "taken", "got"), "conv_id").filter("at > taken")
    own = own.select("conv_id", "length", (F.col("at") - F.col("taken") + F.col("got")).alias("depth"), "t1", "t2", "size")
    lent = convs.filter("got > 0").select("conv_id", "length", F.explode("first").alias("f"))
    lent = lent.select("conv_id", "length", F.col("f.at").alias("depth"), "f.t1", "f.t2", "f.size")
    return convs.select("conv_id", "length"), own.unionByName(lent)


def with_nodes(rows: DataFrame) -> DataFrame:
    """Turns plus the key of their node (k1, k2) and of its parent (p1, p2); the root's is (0, 0)."""
    for lane in (1, 2):
        rows = rows.withColumn(f"r{lane}", F.xxhash64(F.lit(lane), "depth", "t1", "t2"))
    keyed = in_order(rows, "conv_id", [F.col("depth")], ("r1", "r2"))
    return keyed.select(
        "conv_id", "length", "depth", "t1", "t2", "size", F.col("__r1").alias("k1"), F.col("__r2").alias("k2"),
        F.col("__r1").bitwiseXOR(F.col("r1")).alias("p1"), F.col("__r2").bitwiseXOR(F.col("r2")).alias("p2"),
    )


# -- members that end at a node ------------------------------------------------------


def _pieces(batches):
    """Ids of one node in a row, joined by commas into pieces, from rows in order of node and id."""
    at, ids, held, n, first = None, [], 0, 0, None

    def row():
        return at[0], at[1], at[2], first, n, ",".join(ids)

    for batch in batches:
        out = []
        for key in zip(*(_column(batch, c).tolist() for c in ("k1", "k2", "depth", "conv_id")), strict=True):
            if key[:3] != at or held > PIECE:
                if at is not None:
                    out.append(row())
                at, ids, held, n, first = key[:3], [], 0, 0, key[3]
            ids.append(str(key[3]))
            held += len(ids[-1]) + 1
            n += 1
        yield _rows(out, PIECES)
    if at is not None:
        yield _rows([row()], PIECES)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )


def _digests(batches):
    """One row per node from its pieces in order; a digest takes them one after the other."""
    at, n, least, digest = None, 0, None, None
    for batch in batches:
        out = []
        for key in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if key[:3] != at:
                if at is not None:
                    out.append((*at, least, n, digest.digest()))
                at, n, least, digest = key[:3], 0, key[3], hashlib.sha256()
            elif n:
                digest.update(b",")
            digest.update(key[5].encode())
            n += key[4]
        yield _rows(out, ENDS)
    if at is not None:
        yield _rows([(*at, least, n, digest.digest())], ENDS)


def ends_of(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Per node at which conversations end: k1, k2, depth, conv_id (smallest), n, ends (digest of the ids)."""
    last = rows.filter("depth = length").select("conv_id", "depth", "k1", "k2")
    bare = convs.filter("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    order = ["k1", "k2", "depth", "conv_id"]
    ranged = last.unionByName(bare).select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_pieces, PIECES)
    node = ["k1", "k2", "depth"]
    dealt = pieces.repartition(*node).sortWithinPartitions(*node, "first")
    return pinned(dealt.mapInArrow(_digests, ENDS))


# -- double array --------------------------------------------------------------------


class DoubleArray:
    """BASE and CHECK over sequences of labels; the child of s by label t is BASE[s] + t if its CHECK is s.

    Nodes are placed level by level: those with one child in the first free slots, all at
    once; those with several at the first free slot from which on all of them are free.
    """

    TRIES = 1024  # free slots that are tried for several children before those beyond all others

    def __init__(self, labels: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.labels, self.starts, self.lengths = labels, starts, lengths
        n_labels = int(labels.max(initial=0)) + 1
        self.base, self.check = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.top = 1  # slots from here on are free
        state = np.zeros(len(starts), np.int64)
        for level in range(int(lengths.max(initial=0))):
            on = np.flatnonzero(lengths > level)
            pairs = state[on] * n_labels + labels[starts[on] + level]
            child, back = np.unique(pairs, return_inverse=True)
            above, label = child // n_labels, child % n_labels
            state[on] = self._place(above, label)[back]

    def _place(self, above: np.ndarray, label: np.ndarray) -> np.ndarray:
        slot = np.zeros(len(above), np.int64)
        start = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
        size = np.diff(np.append(start, len(above)))
        for a, n in zip(start[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            ahead = label[a : a + n] - label[a]
            free = np.flatnonzero(self.check[: self.top] < 0)[: self.TRIES]
            places = free[:, None] + ahead[None, :]
            fits = np.flatnonzero(((places >= self.top) | (self.check[np.minimum(places, self.top - 1)] < 0)).all(axis=1))
            at = int(free[fits[0]]) if len(fits) else self.top
            slot[a : a + n] = at + ahead
            self._take(slot[a : a + n], above[a : a + n])
        one = start[size == 1]
        free = np.flatnonzero(self.check[: self.top] < 0)[: len(one)]
        slot[one] = np.concatenate((free, np.arange(self.top, self.top + len(one) - len(free))))
        self._take(slot[one], above[one])
        self.base[above[start]] = slot[start] - label[start]
        return slot

    def _take(self, slots: np.ndarray, above: np.ndarray) -> None:
        self.top = max(self.top, int(slots.max(initial=0)) + 1)
        if self.top > len(self.check):
            more = max(self.top, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1)))
        self.check[slots] = above

    def child(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The children by these labels, -1 where there is none."""
        at = self.base[state] + label
        there = (at > 0) & (at < self.top)
        there[there] = self.check[at[there]] == state[there]
        return np.where(there, at, -1)

    def walk(self) -> tuple[np.ndarray, np.ndarray]:
        """The node of every label of every sequence, and the level of every node."""
        node, level_of = np.zeros(len(self.labels), np.int64), np.full(self.top, -1)
        state = np.zeros(len(self.starts), np.int64)
        level_of[0] = 0
        for level in range(int(self.lengths.max(initial=0))):
            on = np.flatnonzero(self.lengths > level)
            at = self.starts[on] + level
            state[on] = self.child(state[on], self.labels[at])
            node[at] = state[on]
            level_of[state[on]] = level + 1
        return node, level_of


def _dense(*columns: np.ndarray) -> np.ndarray:
    """A number from 0 for each distinct combination."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _shards(portion: int):
    """Nodes of whole shards, from rows in order of shard, conversation and depth."""

    def nodes(table: pa.Table) -> pa.RecordBatch:
        col = {n: table.column(n).to_numpy() for n in table.schema.names if n != "ends"}
        shard = _dense(col["g1"], col["g2"])
        new_shard = np.concatenate(([True], shard[1:] != shard[:-1]))
        new = new_shard | np.concatenate(([True], col["conv_id"][1:] != col["conv_id"][:-1]))
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(new)))
        labels = _dense(col["t1"], col["t2"])
        labels[starts] = labels.max() + 1 + shard[starts]  # all shards below one root: their own roots differ
        trie = DoubleArray(labels, starts, lengths)
        node, level_of = trie.walk()
        size = trie.top
        some = np.flatnonzero(trie.check[:size] >= 0)[1:]  # not the root above the shards
        above = trie.check[:size]
        row = np.zeros(size, np.int64)
        row[node[::-1]] = np.arange(len(node))[::-1]
        members, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
        np.add.at(members, node, col["n"])
        np.minimum.at(least, node, col["conv_id"])
        children = np.bincount(above[some], minlength=size)
        leaves = (children == 0).astype(np.int64)
        saved = np.zeros(size, np.int64)
        saved[some] = (members[some] - 1) * col["size"][row[some]]
        by_level = some[np.argsort(-level_of[some], kind="stable")]
        for part in np.split(by_level, np.flatnonzero(np.diff(level_of[by_level])) + 1):
            np.add.at(leaves, above[part], leaves[part])
            np.add.at(saved, above[part], saved[part])
        ends = table.column("ends")
        ending = np.flatnonzero(~ends.is_null().to_numpy())
        digest = np.full(size, -1)
        digest[node[ending]] = ending
        is_top = level_of[some] == 1
        taken = row[some]
        longs = [
            (col["k1"][taken], None), (col["k2"][taken], None), (col["up1"][taken], ~is_top), (col["up2"][taken], ~is_top),
            (col["depth"][taken], None), (least[some], None), (least[above[some]], is_top), (members[some], None),
            (children[some], None), (leaves[some], None), (saved[some], None),
        ]
        digests = ends.take(pa.array(digest[some], mask=digest[some] < 0)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [*(pa.array(v, pa.int64(), mask=m) for v, m in longs), digests],
            names=[part.split()[0] for part in NODE.split(",")],
        )

    def run(batches):
        kept, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            held += batch.num_rows
            if held < portion:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in ("g1", "g2")])
            other = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last shard may go on in the next batch
            if cut:
                yield nodes(table.slice(0, cut).combine_chunks())
            kept, held = table.slice(cut).to_batches(), table.num_rows - cut
        if held:
            yield nodes(pa.Table.from_batches(kept).combine_chunks())

    return run


# -- whole trie ----------------------------------------------------------------------


def _upper(big: DataFrame, nodes: DataFrame) -> DataFrame:
    """The upper nodes with what the shards below them hold, summed over their subtrees."""
    of_shards = nodes.filter("up1 is not null").groupBy(F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(
        F.count("*").alias("n_shards"), F.sum("n_leaves").alias("shard_leaves"), F.sum("saved_tokens").alias("shard_saved")
    )
    inner = big.filter("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_inner"))
    zero = F.lit(0)
    known = big.join(of_shards, ["k1", "k2"], "left").join(inner, ["k1", "k2"], "left")
    known = known.withColumn("n_children", F.coalesce("n_shards", zero) + F.coalesce("n_inner", zero))
    known = pinned(
        known.withColumn("n_leaves", F.coalesce("shard_leaves", zero) + F.when(F.col("n_children") == 0, 1).otherwise(0))
        .withColumn("saved_tokens", F.coalesce("shard_saved", zero) + (F.col("n_convs") - 1) * F.col("size"))
        .select("k1", "k2", "p1", "p2", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    )
    # a1, a2: the ancestor twice as far with each round, whose sums so far lack those of this one
    sums = known.select("k1", "k2", F.col("p1").alias("a1"), F.col("p2").alias("a2"), "n_leaves", "saved_tokens")
    while not sums.filter("a1 is not null").isEmpty():
        from_below = sums.filter("a1 is not null").groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2"))
        from_below = from_below.agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        far = sums.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        sums = pinned(
            sums.join(far, ["a1", "a2"], "left").join(from_below, ["k1", "k2"], "left")
            .select(
                "k1", "k2", F.col("b1").alias("a1"), F.col("b2").alias("a2"),
                (F.col("n_leaves") + F.coalesce("l", zero)).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("s", zero)).alias("saved_tokens"),
            )
        )
    return pinned(known.drop("n_leaves", "saved_tokens").join(sums.drop("a1", "a2"), ["k1", "k2"]))


def trie(
    conversations: DataFrame, parts: int = PARTS, group: int = GROUP, shard_rows: int = SHARD_ROWS, portion: int = PORTION
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(pinned(turn_rows(conversations)), parts, group)
    rows = pinned(with_nodes(turns))
    ends = ends_of(convs, rows)
    # of equal conversations the one with the smallest id goes on, with their number
    once = rows.join(ends.select("conv_id", "n", "ends"), "conv_id")
    once = pinned(once.withColumn("ends", F.when(F.col("depth") == F.col("length"), F.col("ends"))))
    weighed = once.groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_convs"), F.max("size").alias("size"), F.max("ends").alias("ends"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = ends.agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.max(F.when(F.col("depth") == 0, F.col("ends"))).alias("ends")
    ).filter("n_convs > 0")
    root = root.select(
        zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("size"), "ends"
    )
    big = pinned(weighed.filter(F.col("weight") > shard_rows).drop("weight").unionByName(root))
    low = once.join(big.select("k1", "k2"), ["k1", "k2"], "left_anti")
    tops = low.groupBy("conv_id").agg(F.min(F.struct("depth", "k1", "k2", "p1", "p2")).alias("top"))
    tops = pinned(tops.select("conv_id", F.col("top.k1").alias("g1"), F.col("top.k2").alias("g2"), F.col("top.p1").alias("up1"), F.col("top.p2").alias("up2")))
    dealt = low.select("conv_id", "depth", "t1", "t2", "size", "k1", "k2", "n", "ends").join(tops, "conv_id")
    dealt = dealt.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "conv_id", "depth")
    nodes = pinned(dealt.mapInArrow(_shards(portion), NODE))
    upper = _upper(big, nodes)
    name = upper.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = nodes.filter("up1 is null")
    tops = nodes.filter("up1 is not null").drop("parent_conv_id").join(name, ["up1", "up2"])
    above = upper.withColumnsRenamed({"p1": "up1", "p2": "up2"}).join(name, ["up1", "up2"], "left")
    every = [df.select(*shown, F.coalesce(F.lower(F.hex("ends")), F.lit(NO_ENDS)).alias("ends_sha256")) for df in (inner, tops, above)]
    return every[0].unionByName(every[1]).unionByName(every[2])
