"""Top-k search against every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lakeloom.llm import vector_search

VECTORS = "vec_id long, embedding array<double>, label int"


def by_hand(rows, k, every):
    """Per query row: (query_id, rank, vec_id, score), all pairs scored in whole numbers."""
    fit = []
    for i, (vec_id, x, *_) in enumerate(rows):
        if x is not None and all(c is not None and math.isfinite(c) for c in x):
            fit.append((i, vec_id, [math.floor(64 * c) for c in x]))
    out = []
    for i, vec_id, x in fit:
        if vec_id is None or vec_id % every:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), d is None, d or 0, d) for j, d, y in fit if j != i and len(x) == len(y)]
        out += [(vec_id, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda t: t[:3])[:k])]
    return sorted(out, key=repr)


def rows_with_groups(rng, n, dim):
    """Clusters, exact copies of one vector (a third of all), ties, repeated ids and rows."""
    centres = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(5)]
    hot = [rng.gauss(0, 0.3) for _ in range(dim)]
    rows = []
    for i in range(n):
        x = hot if i % 3 == 0 else [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]
        rows.append((i, list(x), 0))
    rows += rows[:7] + [(3, [0.0] * dim, 1), (None, hot, 1), (None, list(centres[0]), 1), (20, None, 1), (40, [0.1] * (dim - 1), 1)]
    rows += [(60, [0.1] * (dim - 1), 1), (60, [], 1), (61, [], 1), (-20, hot, 1), (80, [math.nan] + hot[1:], 1), (81, [math.inf] + hot[1:], 1)]
    return rows + [(100, [None] + hot[1:], 1)]


@pytest.mark.parametrize("shard_bytes,block", [(1 << 20, 1 << 15), (100 * 8 * 16, 1 << 15), (60 * 8 * 16, 7)])
def test_top_k_equals_every_pair(spark, shard_bytes, block):
    rows = rows_with_groups(random.Random(4), 500, 16)
    frame = spark.createDataFrame(rows, VECTORS)
    got = vector_search.top_k(frame, 6, 20, shard_bytes=shard_bytes, query_block=block).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows, 6, 20)


def test_top_k_odd_tables(spark):
    assert vector_search.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_search.top_k(spark.createDataFrame([(20, [1.0], 0)], VECTORS)).count() == 0  # none but itself
    few = spark.createDataFrame([(20, [1.0], 5, "x"), (21, [-1.0], 5, "x"), (22, [0.5], 5, "x")], VECTORS + ", score string")
    assert [tuple(r) for r in vector_search.top_k(few).orderBy("rank").collect()] == [(20, 1, 22, 64 * 32), (20, 2, 21, -64 * 64)]
    floats = spark.createDataFrame([(20, [0.1], 0), (21, [0.3], 0)], "vec_id int, embedding array<float>, label int")
    assert [r["score"] for r in vector_search.top_k(floats).collect()] == [math.floor(64 * float(np.float32(0.1))) * math.floor(64 * float(np.float32(0.3)))]
    large = [(0, [1e9, 3.0, -1e10], 0), (1, [1e9, 1.0, 2e9], 0), (2, [-1e9, 5.0, 1e10], 0), (3, [1e9, 1.0, 2e9 + 1], 0)]
    got = vector_search.top_k(spark.createDataFrame(large, VECTORS)).collect()
    want = [(q, r, d, max(-(1 << 63), min((1 << 63) - 1, s))) for q, r, d, s in by_hand(large, 20, 20)]
    assert sorted((r["query_id"], r["score"]) for r in got) == sorted((q, s) for q, _, _, s in want)


@pytest.mark.parametrize("leaf", [2, 16])
def test_tree_boxes_are_tight_and_bounds_hold(leaf):
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.normal(0, 20, (333, 5)))
    ids = rng.permutation(333)
    tree = vector_search.KdTree(vectors, ids, ids, leaf)
    assert sorted(tree.ids.tolist()) == list(range(333)) and np.diff(tree.ends).max() <= leaf
    low, high, first = tree.levels[-1]
    queries = np.floor(rng.normal(0, 20, (40, 5)))
    none = np.full(40, vector_search.LOW)
    bound, open_ = tree.bounds(queries, none, np.full(40, vector_search.HIGH))
    assert open_.all()
    for i, (a, b) in enumerate(zip(tree.ends[:-1], tree.ends[1:], strict=True)):
        part = tree.vectors[a:b]
        assert (part.min(axis=0) == low[i]).all() and (part.max(axis=0) == high[i]).all() and tree.ids[a:b].min() == first[i]
        assert ((queries @ part.T).max(axis=1) <= bound[:, i]).all()


def test_tree_leaves_out_what_cannot_pass():
    """Of far clusters and of copies of the best vector, most leaves are not opened."""
    rng = np.random.default_rng(7)
    vectors = np.concatenate((np.tile([60.0, 0.0], (4000, 1)), rng.integers(-60, 0, (4000, 2)).astype(float)))
    tree = vector_search.KdTree(vectors, np.arange(8000), np.arange(8000))
    opened = []
    whole = vector_search.products
    try:
        vector_search.products = lambda a, b: opened.append(len(b)) or whole(a, b)
        q, at, s = tree.search(np.array([[60.0, 0.0]]), np.array([-1]), 20, np.array([vector_search.LOW]), np.array([vector_search.HIGH]))
    finally:
        vector_search.products = whole
    assert sorted(tree.ids[at].tolist()) == list(range(20)) and set(s.tolist()) == {3600}
    assert sum(opened) < 2000
