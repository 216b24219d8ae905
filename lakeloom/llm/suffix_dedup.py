"""Exact substring dedup by suffix sorting, deep and shallow.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts somewhere else.

1. Anchors. Every window of LENGTH bytes has an anchor, its k-gram with the smallest hash
   (the leftmost of equal ones). Equal windows have equal anchors at equal offsets, so only
   windows whose anchor occurs elsewhere can repeat. Consecutive windows with one anchor
   are one row: its hash, the hash of all bytes they cover (their context), and the place.
   One row stands for about 85 bytes, and bytes themselves are not shuffled.
2. Contexts. Rows are counted by anchor, and equal contexts are collapsed: all windows of a
   context that occurs twice are repeats. Left are contexts whose anchor occurs elsewhere
   with another context, the borders of repeats.
3. Suffix sort. The bytes of one of each such context go to the task of their anchor. The
   suffixes at all their windows are bucketed by anchor and offset, sorted by multikey
   quicksort to a shallow depth, eight bytes at a time and all groups at once, and the
   groups that are still equal there are put in order by blind tries. Neighbours with a
   common prefix of LENGTH are repeats.
4. Places of repeats are joined to the documents, which cut them out.

Anchors with very many different contexts are cut first to the windows whose 64-bit hash
occurs twice; what is left is collapsed again, so that no task gets a group that grows with
the number of documents that share a passage.

Defined cases: a null text is empty: no bytes, no spans, the checksum of nothing. Texts
shorter than LENGTH keep all bytes. Matches never cross documents. Repeated rows are
repeats of each other and lose all their bytes. Hashes of texts, anchors and contexts have
64 bits; a false match is possible at odds of 2^-64 a pair. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import strings, text_of
from lakeloom.session import pinned

LENGTH = 200
GRAM = 32
SHALLOW = 64
SLICE = 4 << 20  # bytes of a text that are hashed at once
CROWD = 4096  # contexts of one anchor beyond which they are cut to repeated windows first

_RNG = np.random.default_rng(20)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = 28  # low bits that hold a position


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        out = np.multiply.accumulate(out)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Polynomial hashes of substrings, modulo 2^64."""

    def __init__(self):
        self.power, self.inverse = _powers(_BASE, 1 << 12), _powers(_INVERSE, 1 << 12)

    def load(self, data: np.ndarray) -> None:
        if len(data) + 1 > len(self.power):
            n = 1 << (len(data) + 1).bit_length()
            self.power, self.inverse = _powers(_BASE, n), _powers(_INVERSE, n)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return _mixed(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values: minima from block starts and to block ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors_of(data: np.ndarray, hasher: Hasher):
    """anchor hash, context hash, first window, windows, anchor's place in the context; for one text."""
    out = []
    for at in range(0, max(0, len(data) - LENGTH + 1), SLICE):
        part = data[at : at + SLICE + LENGTH - 1]
        hasher.load(part)
        start = np.arange(len(part) - GRAM + 1)
        grams = hasher.of(start, start + GRAM)
        low = np.uint64((1 << _PLACE) - 1)
        best = _window_minimum((grams & ~low) | start.astype(np.uint64), LENGTH - GRAM + 1) & low
        head = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
        many = np.diff(np.append(head, len(best)))
        anchor = best[head].astype(np.int64)
        out.append((grams[anchor], hasher.of(head, head + many - 1 + LENGTH), head + at, many, anchor - head))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None


_ANCHORS = "anchor long, context long, text_key long, first int, many int, inside int"


def _anchor_rows(batches):
    hasher = Hasher()
    names = [c.split()[0] for c in _ANCHORS.split(", ")]
    for batch in batches:
        parts = []
        for key, text in zip(batch.column(0).to_pylist(), strings(batch, "text"), strict=True):
            found = anchors_of(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), hasher)
            if found:
                parts.append((*found[:2], np.full(len(found[0]), key, np.int64), *found[2:]))
        if parts:
            a, c, k, f, m, i = (np.concatenate(x) for x in zip(*parts, strict=True))
            columns = [a.view(np.int64), c.view(np.int64), k, f.astype(np.int32), m.astype(np.int32), i.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)


# -- suffix sort -------------------------------------------------------------------


def quicksort(data: np.ndarray, suffixes: np.ndarray, bucket: np.ndarray, depth_limit: int):
    """Multikey quicksort of suffixes within buckets, eight bytes a step, all groups side by side.

    Every round takes the middle suffix of each open group as pivot and parts the group in
    less, equal and greater; equal ones go on eight bytes deeper. Gives the groups that are
    equal to ``depth_limit``, as lists; those that came apart have no repeat.
    """
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        tail = data[k:]
        words = words << np.uint64(8)
        words[: len(tail)] |= tail
    order = np.lexsort((suffixes, bucket))
    suffixes, group = suffixes[order], bucket[order]
    depth = np.zeros(len(suffixes), np.int64)
    deep = []
    while len(suffixes):
        edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        size = np.diff(np.append(edge, len(group)))
        at = np.repeat(np.arange(len(edge)), size)
        keep = size[at] > 1  # one alone is in its place
        done = keep & (depth >= depth_limit)
        if done.any():
            cuts = (np.flatnonzero(np.diff(at[done])) + 1).tolist()
            members = suffixes[done].tolist()
            deep += [members[a:b] for a, b in zip([0, *cuts], [*cuts, len(members)], strict=True)]
        keep &= ~done
        suffixes, depth, at = suffixes[keep], depth[keep], at[keep]
        if not len(suffixes):
            break
        key = words[np.minimum(suffixes + depth, len(words) - 1)]
        edge = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        size = np.diff(np.append(edge, len(at)))
        pivot = np.repeat(key[edge + size // 2], size)
        side = (key >= pivot).astype(np.int64) + (key > pivot)
        depth = depth + 8 * (side == 1)
        group = at * 3 + side
        order = np.argsort(group, kind="stable")
        suffixes, depth, group = suffixes[order], depth[order], group[order]
    return deep


class BlindTrie:
    """A trie that keeps only the places where strings part; one comparison puts a string in.

    A node is [place, {byte: node}]; a leaf is (string, members with that string).
    """

    def __init__(self):
        self.root = None

    def add(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = (string, [member])
            return
        node = self.root
        while isinstance(node, list):  # down without looking at the places between
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(member)
            return
        n = len(string)
        common = n - ((int.from_bytes(string) ^ int.from_bytes(node[0])).bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, list) and node[0] < common:
            above, node = node, node[1][string[node[0]]]
        if isinstance(node, list) and node[0] == common:
            node[1][string[common]] = (string, [member])
            return
        witness = node
        while isinstance(witness, list):
            witness = next(iter(witness[1].values()))
        split = [common, {string[common]: (string, [member]), witness[0][common]: node}]
        if above is None:
            self.root = split
        else:
            above[1][string[above[0]]] = split

    def leaves(self):
        """Members of equal strings, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def repeated_windows(contexts: list[bytes], copies: list[int], anchor: np.ndarray, inside: np.ndarray) -> list[np.ndarray]:
    """For each context whether the window at each of its starts repeats."""
    raw = b"".join(contexts)
    data = np.frombuffer(raw, np.uint8)
    size = np.array([len(c) for c in contexts])
    many = size - LENGTH + 1
    base = np.concatenate(([0], np.cumsum(size)[:-1]))
    of = np.repeat(np.arange(len(contexts)), many)
    start = np.arange(many.sum()) - np.repeat(np.concatenate(([0], np.cumsum(many)[:-1])), many)
    # equal windows have equal anchors at equal offsets: the buckets to start from
    key = _mixed(anchor[of].view(np.uint64) + (inside[of] - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    flag = np.zeros(len(data), bool)
    owner = np.full(len(data), -1, np.int64)
    owner[base[of] + start] = of
    found: list[int] = []
    single = (np.array(copies) == 1)[owner]
    for group in quicksort(data, base[of] + start, key, SHALLOW):
        if len(group) == 2:  # a trie of two strings is one comparison
            a, b = group
            if raw[a : a + LENGTH] == raw[b : b + LENGTH]:
                found += group
            continue
        trie = BlindTrie()
        for s in group:
            trie.add(raw[s : s + LENGTH], s)
        for members in trie.leaves():
            if len(members) > 1:
                found += members
    flag[found] = True
    flag |= ~single & (owner >= 0)  # a context with copies repeats as a whole
    return [flag[b : b + m] for b, m in zip(base.tolist(), many.tolist(), strict=True)]


def _runs(flags: np.ndarray):
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


def _sorted_task(batches):
    """Rows (anchor, context, copies, text_key, first, inside, bytes), sorted by anchor: repeats of single contexts."""
    held: list = []
    size = 0
    last = None

    def solve():
        rows = list({(r[0], r[1]): r for r in held}.values())  # a repeated document gives its context again
        if len(rows) < 2:
            return
        flags = repeated_windows(
            [r[6] for r in rows], [r[2] for r in rows], np.array([r[0] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)
        )
        out: list[list] = [[], [], []]
        for r, f in zip(rows, flags, strict=True):
            if r[2] == 1 and f.any():
                for a, n in zip(*_runs(f), strict=True):
                    for c, v in zip(out, (r[3], r[4] + int(a), int(n)), strict=True):
                        c.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
            names=["text_key", "first", "many"],
        )

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if size > (2 << 20) and row[0] != last:
                yield from solve()
                held, size = [], 0
            held.append(row)
            size += len(row[6])
            last = row[0]
    if held:
        yield from solve()


def _cut_contexts(batches):
    """Texts with their wanted contexts: the bytes of each."""
    names = ["anchor", "context", "copies", "text_key", "first", "inside", "bytes"]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for key, text, wanted in zip(batch.column(0).to_pylist(), strings(batch, "text"), batch.column(2).to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for w in wanted:
                values = (w["anchor"], w["context"], w["copies"], key, w["first"], w["inside"])
                for c, v in zip(rows, (*values, data[w["first"] : w["first"] + w["many"] - 1 + LENGTH]), strict=True):
                    c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)


_CONTEXTS = "anchor long, context long, copies long, text_key long, first int, inside int, bytes binary"


def _window_hashes(batches):
    hasher = Hasher()
    for batch in batches:
        for anchor, context, copies, data in zip(*[batch.column(c).to_pylist() for c in ("anchor", "context", "copies", "bytes")], strict=True):
            hasher.load(np.frombuffer(data, np.uint8))
            at = np.arange(len(data) - LENGTH + 1)
            found = hasher.of(at, at + LENGTH).view(np.int64)
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, v, np.int64)) for v in (anchor, context, copies)] + [pa.array(at.astype(np.int32)), pa.array(found)],
                names=["anchor", "context", "copies", "at", "window"],
            )


def _recut(batches):
    """Contexts cut to their windows from ``low`` to ``high``, with a new context hash."""
    hasher = Hasher()
    for batch in batches:
        t = batch.to_pylist()
        for r in t:
            data = r["bytes"][r["low"] : r["high"] + LENGTH]
            hasher.load(np.frombuffer(data, np.uint8))
            r["cut"] = int(hasher.of(np.array([0]), np.array([len(data)])).view(np.int64)[0])
            r["bytes"], r["first"], r["inside"] = data, r["first"] + r["low"], r["inside"] - r["low"]
        yield pa.RecordBatch.from_pylist(
            [{k: r[k] for k in ("anchor", "cut", "copies", "text_key", "first", "inside", "bytes")} for r in t],
            schema=pa.schema([("anchor", pa.int64()), ("cut", pa.int64()), ("copies", pa.int64()), ("text_key", pa.int64()),
                              ("first", pa.int32()), ("inside", pa.int32()), ("bytes", pa.binary())]),
        )


def _thinned(contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contexts of crowded anchors cut to repeated windows and collapsed; and the places that collapsing settles."""
    windows = contexts.mapInArrow(_window_hashes, "anchor long, context long, copies long, at int, window long")
    twice = pinned(windows.groupBy("anchor", "window").agg(F.sum("copies").alias("n")).filter("n > 1"))
    range_ = windows.join(twice, ["anchor", "window"]).groupBy("anchor", "context").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    cut = pinned(
        contexts.join(range_, ["anchor", "context"])
        .select("anchor", "copies", "text_key", "first", "inside", "bytes", "low", "high")
        .mapInArrow(_recut, _CONTEXTS.replace("context", "cut"))
    )
    alike = cut.groupBy("anchor", "cut").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("n"), F.min(F.struct("text_key", "first", "inside", "bytes")).alias("one")
    )
    alike = pinned(alike)
    settled = cut.filter("copies = 1").join(alike.filter("n > 1 or copies > 1").select("anchor", "cut"), ["anchor", "cut"])
    settled = settled.select("text_key", "first", (F.length("bytes") - LENGTH + 1).cast("int").alias("many"))
    rest = alike.select("anchor", F.col("cut").alias("context"), "copies", "one.text_key", "one.first", "one.inside", "one.bytes")
    return rest, settled


def repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """text_key, first, many: ``many`` windows that repeat, from byte ``first`` of the texts with that key."""
    texts = docs.select(F.xxhash64(text_of(docs)).alias("text_key"), F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = pinned(texts.select("text_key", "text").mapInArrow(_anchor_rows, _ANCHORS))
    # written first: AQE splits a hot anchor in the join only where no grouping feeds it
    often = pinned(
        rows.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("mixed"))
        .filter("n > 1").select("anchor", "mixed")
    )
    found = pinned(rows.join(often, "anchor"))
    alike = pinned(
        found.filter("mixed").groupBy("anchor", "context").agg(
            F.count("*").alias("copies"), F.min(F.struct("text_key", "first", "many", "inside")).alias("one")
        )
    )
    whole = found.filter("not mixed").select("text_key", "first", "many").unionByName(
        found.filter("mixed").join(alike.filter("copies > 1").select("anchor", "context"), ["anchor", "context"])
        .select("text_key", "first", "many")
    )
    # where every context of an anchor has copies, all is settled
    open_ = alike.groupBy("anchor").agg(F.min("copies").alias("fewest"), F.count("*").alias("n")).filter("fewest = 1")
    open_ = pinned(open_.select("anchor", "n"))
    wanted = alike.join(open_, "anchor").groupBy(F.col("one.text_key").alias("text_key")).agg(
        F.collect_list(F.struct("anchor", "context", "copies", "one.first", "one.many", "one.inside")).alias("wanted")
    )
    # one document for each text
    one = texts.groupBy("text_key").agg(F.min("doc_id").alias("least"))
    wanted = pinned(wanted.join(one, "text_key")).alias("w")
    same = (F.col("t.text_key") == F.col("w.text_key")) & F.col("t.doc_id").eqNullSafe(F.col("w.least"))
    contexts = pinned(
        texts.alias("t").join(wanted, same).select("t.text_key", "t.text", "w.wanted").mapInArrow(_cut_contexts, _CONTEXTS)
    )
    crowded = open_.filter(F.col("n") > crowd).select("anchor")
    few = contexts.join(crowded, "anchor", "left_anti")
    rest, settled = _thinned(contexts.join(crowded, "anchor", "left_semi"))
    to_sort = few.unionByName(rest)
    borders = to_sort.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _sorted_task, "text_key long, first int, many int"
    )
    return pinned(whole.unionByName(settled).unionByName(borders))


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept``: the bytes that stay."""
    places = pinned(
        repeats(docs).groupBy("text_key").agg(F.collect_set(F.struct("first", "many")).alias("places"))
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def run(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text, found in zip(batch.column(0).to_pylist(), strings(batch, "text"), batch.column(2).to_pylist(), strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                steps = np.zeros(len(data) + 1, np.int32)
                for p in found or ():
                    steps[p["first"]] += 1
                    steps[min(len(data), p["first"] + p["many"] - 1 + LENGTH)] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                kept = data[~gone].tobytes()
                values = (doc_id, len(data), int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept)
                for c, v in zip(rows, values, strict=True):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"), F.xxhash64(text_of(docs)).alias("text_key"))
    return texts.join(places, "text_key", "left").select("doc_id", "text", "places").mapInArrow(run, schema)
