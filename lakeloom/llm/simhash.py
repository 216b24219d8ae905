"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint has a bit set where more than half of the text's shingle hashes have it.
Texts whose fingerprints differ in few bits are linked; groups are connected components.

Search: fingerprints that may be linked meet in a block (equal bits at agreed places).
Within a block they are sorted by their rank in Gray order, which puts fingerprints with
long common bit patterns next to each other. Neighbours are joined to nodes, eight at a
time up to the root; a node keeps the bits that all below it share, and only those that
its parent does not have already. A search goes down from the root, adds up the bits that
differ, and leaves a whole node as soon as the sum is over the limit.

Defined cases: a text without words has fingerprint zero, linked like any other; so has a
null text. A text with fewer words than a shingle is one shingle. Equal fingerprints are
one node of the graph, whatever the number of documents. A null doc_id never names a group
that has another id. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import slices, strings, text_of
from lakeloom.session import pinned

SEED = 42
FAN = 8  # children of a node
BLOCK = 20_000  # fingerprints of one block that one task searches
PORTION = 100_000  # fingerprints of small blocks that a task holds at a time
SHINGLES = 1 << 21  # of the sets that a task holds at a time, or of a part of a route
ROOM = 64 << 20  # bytes that a search takes for the pairs it has open
BLOCK_KEY = ("route", "left", "right")
ROUTES, ROUTE_ROWS = 16, 4  # of the search by similarity
_SEEDS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, ROUTES * ROUTE_ROWS), dtype=np.uint64)
_TURN, _ODD = _SEEDS[0], _SEEDS[1] | np.uint64(1)
_BITS = np.array([[(v >> (7 - j)) & 1 for j in range(8)] for v in range(256)], np.int64)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, A-Z lower-cased, joined by blanks."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only ASCII letters and blanks
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends - 1).tolist()
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, stops[width - 1 :], strict=False)], np.uint64
    )


def fingerprint(text: str, width: int, n_words: int) -> bytes:
    """The fingerprint as ``8 * n_words`` bytes, most significant first; word 0 is made of the hashes themselves."""
    return fingerprint_of(shingle_hashes(text, width), n_words)


def fingerprint_of(hashes: np.ndarray, n_words: int) -> bytes:
    if not len(hashes):
        return bytes(8 * n_words)
    out = []
    for k in range(n_words):
        h = hashes
        if k:
            h = (h ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
        lanes = h.astype(">u8").view(np.uint8).reshape(-1, 8)
        counts = [np.bincount(lanes[:, b], minlength=256) @ _BITS for b in range(8)]
        out.append(np.packbits(2 * np.concatenate(counts) > len(h)).tobytes())
    return b"".join(out)


def with_fingerprints(docs: DataFrame, width: int = 3, n_words: int = 1) -> DataFrame:
    """doc_id, a hash of the whole row, and the fingerprint."""
    schema = "doc_id long, row_hash long, fp binary"

    def run(batches):
        for batch in slices(batches):
            found = [fingerprint(t, width, n_words) for t in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "row_hash", "fp"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_hash(docs).alias("row_hash"), text_of(docs).alias("text")
    )
    return rows.mapInArrow(run, schema)


def row_hash(docs: DataFrame):
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


# -- blocks ------------------------------------------------------------------------


def exact_routes(limit: int = 2, bits: int = 64) -> list[list[int]]:
    """Bit places such that fingerprints within ``limit`` agree on one whole list.

    Pigeonhole twice: of limit + 1 pieces one is equal, and of limit + 1 pieces of the
    other bits again one. No link is lost, and blocks stay small however many rows share
    one piece.
    """
    pieces = [list(p) for p in np.array_split(np.arange(bits), limit + 1)]
    out = []
    for piece in pieces:
        rest = [b for b in range(bits) if b not in piece]
        out += [piece + list(p) for p in np.array_split(rest, limit + 1)]
    return [[int(b) for b in r] for r in out]


def _routed(routes: list[list[int]]):
    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_pylist()
            if not fps:
                continue
            bits = np.unpackbits(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1), axis=1)
            for k, places in enumerate(routes):
                key = np.zeros(len(fps), np.uint64)
                for b in places:
                    key = (key << np.uint64(1)) | bits[:, b]
                key |= np.uint64(k) << np.uint64(56)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fps, pa.binary())], names=["route", "fp"]
                )

    return run


# -- index -------------------------------------------------------------------------


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Ranks in Gray order, one row of words each; ``fps`` has the words of each fingerprint in a row."""
    out = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    odd = np.zeros(len(fps), bool)
    for w in range(fps.shape[1]):
        parity = (out[:, w] & np.uint64(1)).astype(bool)  # of the word's own bits
        out[:, w] = np.where(odd, ~out[:, w], out[:, w])
        odd ^= parity
    return out


class GrayIndex:
    """Nodes over fingerprints that are sorted by block and Gray rank."""

    def __init__(self, fps: np.ndarray, blocks: np.ndarray):
        order = np.lexsort((*gray_rank(fps).T[::-1], blocks))
        self.order, self.fps, blocks = order, fps[order], blocks[order]
        low = high = self.fps  # bits set in all, bits set in any
        first, last = np.arange(len(fps)), np.arange(len(fps))
        self.levels = [(low, high, first, last)]
        self.blocks = blocks
        while len(np.unique(blocks)) < len(blocks):
            start = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
            size = np.diff(np.append(start, len(blocks)))
            at = np.arange(len(blocks)) - np.repeat(start, size)
            heads = np.flatnonzero(at % FAN == 0)
            low, high = np.bitwise_and.reduceat(low, heads), np.bitwise_or.reduceat(high, heads)
            ends = np.append(heads[1:], len(blocks)) - 1
            self.levels.append((low, high, heads, ends))
            blocks = blocks[heads]
        self.roots = blocks

    def pairs(self, limit: int, room: int = ROOM):
        """(i, j), i before j in the sorted order, of one block and within the limit; in portions.

        A portion takes ``room`` bytes, were no node left out: a pair has three numbers and,
        while bits are compared, five rows of words.
        """
        room = max(1, room // (24 + 40 * self.fps.shape[1]))
        spread = np.diff(np.append(np.flatnonzero(np.concatenate(([True], self.blocks[1:] != self.blocks[:-1]))), len(self.blocks)))
        each = np.repeat(spread, spread)
        upto, total = 0, np.cumsum(each)
        while upto < len(self.fps):
            stop = max(upto + 1, int(np.searchsorted(total, total[upto] + room)))
            yield self._search(np.arange(upto, min(stop, len(self.fps))), limit)
            upto = stop

    def _search(self, queries: np.ndarray, limit: int):
        q, node = queries, np.searchsorted(self.roots, self.blocks[queries])
        known = np.zeros((len(q), self.fps.shape[1]), np.uint64)  # bits that nodes above have in common
        total = np.zeros(len(q), np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            low, high, first, last = self.levels[level]
            shared = ~(low[node] ^ high[node])
            total = total + np.bitwise_count((self.fps[q] ^ low[node]) & shared & ~known).sum(axis=1)
            keep = total <= limit
            q, node, total, shared = q[keep], node[keep], total[keep], shared[keep]
            n = last[node] - first[node] + 1
            below = np.repeat(first[node] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            q, node, total = np.repeat(q, n), below, np.repeat(total, n)
            if level > 1:  # a fingerprint is compared whole
                known = np.repeat(shared, n, axis=0)
        keep = node > q
        q, node = q[keep], node[keep]
        near = np.bitwise_count(self.fps[q] ^ self.fps[node]).sum(axis=1) <= limit
        return q[near], node[near]


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: the smallest member of each one's group."""
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    while (label[label] != label).any():
        label = label[label]
    return label


def forest(n: int, portions) -> np.ndarray:
    """The smallest member of each one's group, from links in portions."""
    label = np.arange(n)
    for a, b in portions:
        label = united(label, a, b)
    return label


def _portions(batches, rows: int, shingles: int | None = None):
    """Tables of whole blocks from batches in block order; a table holds about so many rows or shingles, or one block."""
    kept, held, weight = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        held += batch.num_rows
        weight += len(batch.column("shingles").flatten()) if shingles else 0
        if held < rows and (not shingles or weight < shingles):
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        keys = np.stack([table.column(c).to_numpy() for c in BLOCK_KEY])
        other = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0  # the last block may go on in the next batch
        if cut:
            yield table.slice(0, cut)
        kept, held = table.slice(cut).to_batches(), table.num_rows - cut
        weight = sum(len(x.column("shingles").flatten()) for x in kept) if shingles else 0
    if held:
        yield pa.Table.from_batches(kept).combine_chunks()


def _linked(limit: int, rows: int = PORTION):
    def run(batches):
        for table in _portions(batches, rows):
            raw = np.frombuffer(b"".join(table.column("fp").to_pylist()), ">u8").astype(np.uint64)
            fps = raw.reshape(table.num_rows, -1)
            keys = np.stack([table.column(c).to_numpy() for c in BLOCK_KEY])
            blocks = np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))))
            index = GrayIndex(fps, blocks)
            label = forest(len(fps), index.pairs(limit))
            own = np.flatnonzero(label != np.arange(len(fps)))
            a, b = index.fps[own], index.fps[label[own]]
            differ = (a != b).any(axis=1)  # the same fingerprint may come twice to a block pair
            as_bytes = lambda x: [r.tobytes() for r in x[differ].astype(">u8")]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_bytes(a), pa.binary()), pa.array(as_bytes(b), pa.binary())], names=["a", "b"]
            )

    return run


def links(fps: DataFrame, routes: list[list[int]], limit: int, block: int = BLOCK, portion: int = PORTION) -> DataFrame:
    """Links (a, b) between distinct fingerprints: in each block a spanning forest of all its links.

    A block with more than ``block`` fingerprints is dealt into parts, and every two parts
    (and each with itself) meet in a task of their own, so that no task holds a whole one.
    """
    routed = pinned(fps.select("fp").mapInArrow(_routed(routes), "route long, fp binary"))
    size = routed.groupBy("route").agg(F.count("*").alias("n")).filter("n > 1")
    # written first: AQE splits a hot route in the join only where no grouping feeds it
    parts = pinned(size.select("route", F.ceil(F.col("n") / block).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = (
        routed.join(parts, "route")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("route", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "fp")
    )
    # sorted, so that a task holds a portion of its blocks at a time, whatever the partition's size
    dealt = met.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    return dealt.mapInArrow(_linked(limit, portion), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """a, b: each node of a group but the smallest, and the smallest.

    Large star and small star in turn until nothing changes; each round is written, so a
    lost executor costs no more than the round.
    """

    def oriented(df):
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = pinned(oriented(edges))
    was = None
    while (found := state(now)) != was:
        was = found
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = oriented(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = pinned(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = pinned(oriented(small.unionByName(least.select("a", F.col("m").alias("b")))))
    return now


def groups(prints: DataFrame, routes: list[list[int]], limit: int) -> DataFrame:
    """fp and root: the group of every distinct fingerprint."""
    distinct = pinned(prints.select("fp").distinct())
    star = components(links(distinct, routes, limit))
    return distinct.join(star.withColumnRenamed("a", "fp"), "fp", "left").select(
        "fp", F.coalesce("b", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, width: int = 3, limit: int = 2) -> DataFrame:
    """doc_id, fp (8 bytes), component_id; every link within the limit is found."""
    prints = pinned(with_fingerprints(docs, width, 1))
    member = pinned(groups(prints, exact_routes(limit), limit))
    # copies count once per fingerprint before groups are formed
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = least.join(member, "fp")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = pinned(named.join(smallest, "root").select("fp", "component_id"))
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


# -- near copies by similarity ------------------------------------------------------


def route_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each route: of ``ROUTE_ROWS`` smallest values under seeded orders of the shingles."""
    least = np.full(ROUTES * ROUTE_ROWS, np.iinfo(np.uint64).max)
    for s in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[s : s + 4096, None] ^ _TURN) * _ODD).min(axis=0))
    rows = np.ascontiguousarray(least.reshape(ROUTES, ROUTE_ROWS)).astype("<u8")
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64).view(np.int64)


def _set_of(text: str, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def _node_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


def with_sets(docs: DataFrame, width: int, n_words: int) -> DataFrame:
    """doc_id, row_hash, node (128-bit hash of the distinct shingles), their fingerprint, and route keys."""
    schema = "doc_id long, row_hash long, node binary, fp binary, routes array<long>"

    def run(batches):
        for batch in slices(batches):
            sets = [_set_of(t, width) for t in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([_node_of(h) for h in sets], pa.binary()),
                    pa.array([fingerprint_of(h, n_words) for h in sets], pa.binary()),
                    pa.array([route_keys(h) for h in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_hash", "node", "fp", "routes"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_hash(docs).alias("row_hash"), text_of(docs).alias("text")
    )
    return rows.mapInArrow(run, schema)


def _partnered(limit: int, rows: int = PORTION):
    """Of each block the rows that another one is near to."""

    def run(batches):
        for table in _portions(batches, rows):
            keys = np.stack([table.column(c).to_numpy() for c in BLOCK_KEY])
            blocks = np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))))
            fps = np.frombuffer(b"".join(table.column("fp").to_pylist()), ">u8").astype(np.uint64)
            index = GrayIndex(fps.reshape(table.num_rows, -1), blocks)
            near = np.zeros(table.num_rows, bool)
            for a, b in index.pairs(limit):
                near[index.order[a]] = near[index.order[b]] = True
            yield from table.select(["route", "node"]).filter(pa.array(near)).to_batches()

    return run


class _Shingles:
    """Sets of shingles, numbered, one after the other."""

    def __init__(self, lists: pa.ListArray, order: np.ndarray):
        ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        different, self.ids = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        self.start, self.size = ends[:-1][order], np.diff(ends)[order]
        self.held = np.zeros(len(different), bool)

    def similar(self, x: np.ndarray, y: np.ndarray, percent: int, room: int = 1 << 20) -> np.ndarray:
        """Whether the sets x and y are that similar, by exact Jaccard similarity; so many shingles at a time."""
        out = np.zeros(len(x), bool)
        order = np.argsort(x, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(x[order])) + 1) if len(x) else []:
            one = x[places[0]]
            own = self.ids[self.start[one] : self.start[one] + self.size[one]]
            self.held[own] = True
            cuts = np.flatnonzero(np.diff(np.cumsum(self.size[y[places]]) // room)) + 1
            for some in np.split(places, cuts):
                n = self.size[y[some]]
                stop = np.cumsum(n)
                at = np.arange(stop[-1]) + np.repeat(self.start[y[some]] - stop + n, n)
                hits = np.concatenate(([0], np.cumsum(self.held[self.ids[at]])))
                both = hits[stop] - hits[stop - n]
                out[some] = 100 * both >= percent * (len(own) + n - both)
            self.held[own] = False
        return out


def _similar_forest(limit: int, percent: int, first: int, shingles: int, rows: int = PORTION):
    """In each block a spanning forest of its links; every pair is checked or within a group.

    The ``first`` nearest of each node are checked first, then eight times as many, and so on;
    pairs that links before have put in one group need no check. A pair that meets in several
    routes is left to the first of them.
    """

    def run(batches):
        for table in _portions(batches, rows, shingles):
            keys = np.stack([table.column(c).to_numpy() for c in BLOCK_KEY])
            blocks = np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))))
            fps = np.frombuffer(b"".join(table.column("fp").to_pylist()), ">u8").astype(np.uint64)
            index = GrayIndex(fps.reshape(table.num_rows, -1), blocks)
            route = keys[0][index.order]
            routes = pa.concat_arrays(table.column("routes").chunks).flatten().to_numpy().reshape(-1, ROUTES)[index.order]
            sets = _Shingles(pa.concat_arrays(table.column("shingles").chunks), index.order)
            label = np.arange(table.num_rows)
            for a, b in index.pairs(limit):
                met = (routes[a] == routes[b]).argmax(axis=1)
                here = (routes[a, met] == route[a]) & (label[a] != label[b])
                a, b = a[here], b[here]
                far = np.bitwise_count(index.fps[a] ^ index.fps[b]).sum(axis=1)
                order = np.lexsort((b, far, a))
                a, b = a[order], b[order]
                start = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, int)
                place = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
                upto = first
                while len(a):
                    now = place < upto
                    same = sets.similar(a[now], b[now], percent)
                    label = united(label, a[now][same], b[now][same])
                    open_ = ~now & (label[a] != label[b])
                    a, b, place, upto = a[open_], b[open_], place[open_], 8 * upto
            own = np.flatnonzero(label != np.arange(len(label)))
            x, y = (table.column("node").take(pa.array(index.order[i])).combine_chunks() for i in (own, label[own]))
            yield pa.RecordBatch.from_arrays([x, y], names=["a", "b"])

    return run


def _sets(docs: DataFrame, prints: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node and its distinct shingle hashes, of the given nodes, from one row each."""
    rows = prints.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("row_hash").alias("row_hash"))
    chosen = pinned(rows.select("row_hash").distinct())
    text = docs.select(row_hash(docs).alias("row_hash"), text_of(docs).alias("text"))
    once = text.join(chosen, "row_hash", "left_semi")

    def run(batches):
        for batch in slices(batches):
            sets = [_set_of(t, width) for t in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node_of(h) for h in sets], pa.binary()), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    return once.mapInArrow(run, "node binary, shingles array<long>").dropDuplicates(["node"])


def _in_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of ``(route, node)`` in every block that they are part of: every two parts of a route meet."""
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.explode(F.expr("sequence(0, parts - 1)"))
    met = rows.join(parts, "route").withColumn("own", own).withColumn("other", other)
    return met.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("own", "other", "parts")


def similar_groups(
    docs: DataFrame, prints: DataFrame, width: int, limit: int, percent: int, block: int = BLOCK, first: int = 2
) -> DataFrame:
    """a, b: each node but the smallest of a group, and the smallest; links are checked by exact Jaccard similarity.

    Pairs never are rows. The nodes of a route that another one is near to bring their sets
    to the blocks of the route, once a route; there pairs are checked, the nearest of each
    node first. What leaves a block is a link a node at most.
    """
    distinct = pinned(prints.groupBy("node").agg(F.first("fp").alias("fp"), F.first("routes").alias("routes")))
    routed = pinned(distinct.select("node", "fp", F.explode("routes").alias("route")))
    size = routed.groupBy("route").agg(F.count("*").alias("n")).filter("n > 1")
    parts = pinned(size.select("route", F.ceil(F.col("n") / block).cast("int").alias("parts")))
    dealt = _in_parts(routed, parts).repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    near = pinned(dealt.mapInArrow(_partnered(limit), "route long, node binary").distinct())
    sets = pinned(_sets(docs, prints, near.select("node").distinct(), width))
    # a block is as many rows as one task searches, and as many shingles as it holds
    held = near.join(sets.select("node", F.size("shingles").alias("size")), "node").groupBy("route")
    n_parts = F.ceil(F.greatest(F.count("*") / block, F.sum("size") / SHINGLES))
    parts = pinned(held.agg(F.greatest(n_parts, F.lit(1)).cast("int").alias("parts")))
    known = sets.join(distinct, "node")
    dealt = _in_parts(near, parts).join(known, "node").repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    return components(dealt.mapInArrow(_similar_forest(limit, percent, first, SHINGLES), "a binary, b binary"))


def without_near_duplicates(
    docs: DataFrame, width: int = 5, n_words: int = 8, limit: int = 128, percent: int = 80
) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id.

    Linked are texts whose distinct five-word shingles have a Jaccard similarity of 0.8 or
    more, which is counted exactly. The Gray index finds what is counted: 512-bit
    fingerprints that differ in 128 bits at most. At 0.8 the mean is 78 bits with a
    deviation of 8 for long texts, and 96 with one of 9 for the worst short ones, 4 against
    5 shingles. Fingerprints meet where four smallest shingles under seeded orders are the
    same ones: of 16 such routes a pair at 0.8 shares one with 99.98 %.
    """
    prints = pinned(with_sets(docs, width, n_words))
    star = similar_groups(docs, prints, width, limit, percent).withColumnRenamed("a", "node")
    rows = prints.groupBy("node", "doc_id", "row_hash").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash", "n")
    per_node = rows.groupBy("node").agg(F.min(order).alias("best"))
    best = pinned(
        per_node.join(star, "node", "left").groupBy(F.coalesce("b", "node").alias("root"))
        .agg(F.min("best").alias("best")).select("best.doc_id", "best.row_hash", "best.n")
    )
    keyed = docs.withColumn("__row", row_hash(docs)).alias("d")
    same = (F.col("d.__row") == F.col("k.row_hash")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id"))
    single = keyed.join(best.filter("n = 1").alias("k"), same, "left_semi")
    # rows that are repeated in every column: one of them
    repeated = keyed.join(best.filter("n > 1").alias("k"), same, "left_semi").dropDuplicates(["__row"])
    return reduce(DataFrame.unionByName, [single, repeated]).drop("__row")
