"""The prefix trie against every prefix of every conversation."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lakeloom.llm import conversation_trie

TURNS = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in convs.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def conversations(rng, n):
    """Shared first turns, a group of copies, one long conversation, gaps and null fields."""
    rows = []
    for c in range(n):
        copy = c % 100 > 70
        for t in range(3 if copy else rng.choice([1, 2, 4, 7])):
            text = f"hello {t}" if copy or (t < 2 and c % 3) else rng.choice(["a", "bb", "é\U0001f600", "", None])
            rows.append((c, t * 2, rng.choice(["user", "bot"]) if not copy else "user", text))
    rows += [(5000, t, "user", str(t % 9)) for t in range(300)]
    rows += [(5001, t, "user", str(t % 9)) for t in range(290)]
    rows += [(c, None, None, None) for c in (900, 901, 902)] + [(None, 1, "user", "lost"), (901, 1, "user", "x"), (901, 1, "user", "x")]
    rows += [(-101, 1, "a", "b"), (-101, 2, "a", "c"), (-100, 1, "a", "z"), (777_777, 0, "user", "hello 0")]
    rng.shuffle(rows)
    return rows


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("shard_rows,portion", [(20_000, 100_000), (40, 10), (3, 500), (0, 1)])
def test_trie_equals_every_prefix(spark, shard_rows, portion):
    rows = conversations(random.Random(2), 400)
    frame = spark.createDataFrame([(*r, "x") for r in rows], TURNS + ", depth string").repartition(5)
    got = shown(conversation_trie.trie(frame, shard_rows=shard_rows, portion=portion))
    assert got == sorted(by_hand(rows), key=lambda r: tuple((x is None, x) for x in r))


def test_trie_odd_tables(spark):
    assert conversation_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert conversation_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
    bare = [(c, 0, "user", "x") for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6]  # no base, all turns replaced
    assert shown(conversation_trie.trie(spark.createDataFrame(bare, TURNS))) == by_hand(bare)
    long = [(7, 0, "user", "word " * 200_000), (8, 0, "user", "word " * 200_000), (8, 1, None, "")]
    assert shown(conversation_trie.trie(spark.createDataFrame(long, TURNS))) == sorted(by_hand(long), key=lambda r: tuple((x is None, x) for x in r))


def test_a_conversation_over_several_ranges(spark, monkeypatch):
    """A hot conversation is dealt into several ranges, and numbered through."""
    rows = [(1, t, "u", str(t)) for t in range(5000)] + [(2, t, "u", "x") for t in range(10)]
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    turns = conversation_trie.turn_rows(spark.createDataFrame(rows, TURNS).repartition(8))
    got = sorted((r["conv_id"], r["__at"]) for r in turns.collect())
    assert got == sorted([(1, t + 1) for t in range(5000)] + [(2, t + 1) for t in range(10)])
    local = spark.createDataFrame([(1, t, 1 << (t % 60)) for t in range(3000)], "conv_id long, depth long, r1 long")
    with monkeypatch.context() as m:
        parts = []
        whole = conversation_trie.pinned
        m.setattr(conversation_trie, "pinned", lambda df: parts.append(whole(df)) or parts[-1])
        out = conversation_trie.in_order(local.repartition(4), "conv_id", ["depth"], ("r1",)).orderBy("depth").collect()
    spark.conf.unset(small)
    assert parts[0].select("__part").distinct().count() > 1
    total = 0
    for t, r in enumerate(out):
        total ^= 1 << (t % 60)
        assert (r["__at"], r["__r1"]) == (t + 1, total)


def test_many_ids_are_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 50)
    rows = [(c, 0, "u", "same") for c in range(1000, 3000)]
    assert shown(conversation_trie.trie(spark.createDataFrame(rows, TURNS))) == sorted(by_hand(rows), key=lambda r: tuple((x is None, x) for x in r))


def test_double_array_holds_what_went_in():
    rng = np.random.default_rng(3)
    paths = [tuple(rng.integers(0, 12, rng.integers(1, 9)).tolist()) for _ in range(400)]
    lengths = np.array([len(p) for p in paths])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    trie = conversation_trie.DoubleArray(np.array([x for p in paths for x in p]), starts, lengths)
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
    assert (trie.check[: trie.top] >= 0).sum() == len(prefixes)  # one slot each, none shared
    node, level = trie.walk()
    assert len({(n, p[:d]) for p, s in zip(paths, starts, strict=True) for d, n in enumerate(node[s : s + len(p)], 1)}) == len(prefixes) - 1
    # no other prefix is found
    for p in list(prefixes)[:300]:
        state = np.zeros(1, np.int64)
        for x in p:
            state = trie.child(state, np.array([x]))
        for x in range(12):
            assert (trie.child(state, np.array([x]))[0] >= 0) == ((*p, x) in prefixes)
