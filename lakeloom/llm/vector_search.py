"""Exact top-k search by inner product, with a KD-tree per shard.

Vectors are dealt into shards that a task can hold. A shard's tree is split at medians, in
the dimension in which its vectors spread most, and every node keeps the tight box of its
vectors and their smallest id. A query cannot score more in a box than the sum, over the
dimensions, of the larger of its products with the two sides: the tree is searched from the
best such bound on, and what cannot pass the k-th score found so far is left out. A query
is first searched in the shard it lies in itself; the k-th score found there goes with it to
all other shards, which start from it. Queries come in blocks, so that a task has one shard
and one block, whatever the number of either.

Defined cases: a component becomes floor(64 x), cut to +-2^62; a score is cut to the range of
long. Vectors that are null or hold a null or a component that is not finite take no part.
Vectors of different lengths have no inner product and do not meet; empty ones score 0 with
one another. Each row is a candidate and, if its id says so, a query of its own, whether or
not the id repeats; a null id is no query and comes last among equal scores. Rows that are
equal in all columns are rows all the same. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import pinned

SCALE = 64
EVERY = 20  # rows with an id divisible by it are the queries
TOP = 20
SHARD_BYTES = 8 << 20  # of a shard's components, as eight bytes each
QUERY_BLOCK = 1 << 15  # queries that meet a shard in one task
LEAF = 128  # vectors of a leaf
AT_ONCE = 256  # queries that go down a tree together
MOST = float(1 << 62)
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
ROW = "dim int, shard int, block int, kind int, uid long, vec_id long, v binary, floor long, floor_id long"
FOUND = "uid long, query_id long, vec_id long, score long"


# -- whole numbers -------------------------------------------------------------------


def packed(row: np.ndarray) -> bytes:
    """Whole numbers in the smallest of three forms, which the length tells apart."""
    most = np.abs(row).max(initial=0)
    return row.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8").tobytes()


def unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    if not dim:
        return np.zeros((len(rows), 0))
    forms = {2 * dim: "<i2", 4 * dim: "<i4", 8 * dim: "<f8"}
    sizes = {len(r) for r in rows}
    if len(sizes) == 1:
        return np.frombuffer(b"".join(rows), forms[sizes.pop()]).reshape(-1, dim).astype(np.float64)
    return np.array([np.frombuffer(r, forms[len(r)]) for r in rows], np.float64).reshape(len(rows), dim)


def _scaled(scale: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
            wrong = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            fit = ~lists.is_null().to_numpy(zero_copy_only=False) & (wrong[ends[1:]] == wrong[ends[:-1]])
            with np.errstate(all="ignore"):
                whole = np.clip(np.floor(values * scale), -MOST, MOST)
            keep = np.flatnonzero(fit)
            rows = [packed(whole[ends[i] : ends[i + 1]]) for i in keep]
            dims = (ends[1:] - ends[:-1])[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array(dims, pa.int32()), pa.array(rows, pa.binary())],
                names=["vec_id", "dim", "v"],
            )

    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, exactly, cut to the range of long."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    out = (whole(a).astype(object) @ whole(b).astype(object).T).reshape(len(a), len(b))
    return np.clip(out, LOW, HIGH).astype(np.int64)


# -- tree ----------------------------------------------------------------------------


class KdTree:
    """Leaves in a row and the boxes above them, level by level, the root first.

    Each level halves every node of the one before at its median, in the dimension of its
    box that is widest; among equal components the smaller id goes left.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, uids: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        bounds = np.array([0, len(order)])
        cuts = [bounds]
        while np.diff(bounds).max(initial=0) > leaf:
            middles = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                part = vectors[order[a:b]]
                wide = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if part.size else 0
                if part.size:
                    order[a:b] = order[a:b][np.argsort(part[:, wide], kind="stable")]
                middles.append((a + b) // 2)
            bounds = np.sort(np.concatenate((bounds, middles)))
            cuts.append(bounds)
        self.vectors, self.ids, self.uids = vectors[order], ids[order], uids[order]
        self.ends = bounds
        self.levels = []
        for bounds in cuts:
            starts = bounds[:-1]
            self.levels.append(
                (
                    np.minimum.reduceat(self.vectors, starts, axis=0), np.maximum.reduceat(self.vectors, starts, axis=0),
                    np.minimum.reduceat(self.ids, starts),
                )
            )

    def bounds(self, queries: np.ndarray, score: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most each query can score in each leaf, and whether the leaf can still hold a better one.

        Goes down from the root; what lies below a node that is left out is left out with it.
        """
        signed = np.hstack((np.maximum(queries, 0), np.minimum(queries, 0)))
        open_ = np.ones((len(queries), 1), bool)
        bound = None
        for low, high, first in self.levels:
            if open_.shape[1] < len(low):
                open_ = np.repeat(open_, 2, axis=1)
            live = np.flatnonzero(open_.any(axis=1))
            bound = np.full(open_.shape, LOW)
            if len(live):
                bound[live] = products(signed[live], np.hstack((high, low)))
            open_ &= (bound > score[:, None]) | ((bound == score[:, None]) & (first[None, :] < least[:, None]))
        return bound, open_

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, score: np.ndarray, least: np.ndarray):
        """(query, place, score) of what may be among the k best, given a k-th (score, id) that each knows already.

        Leaves come best bound first, one for each query, then two, four and so on, each
        round with the k-th score of the rounds before.
        """
        score, least = score.copy(), least.copy()
        q, at, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound, open_ = self.bounds(queries, score, least)
        first = self.levels[-1][2]
        order = np.argsort(np.where(open_, -(bound // 2), HIGH), axis=1, kind="stable")
        done, step = 0, 1
        while done < order.shape[1]:
            now = order[:, done : done + step]
            rows = np.arange(len(queries))[:, None]
            known = bound[rows, now]
            live = open_[rows, now] & ((known > score[:, None]) | ((known == score[:, None]) & (first[now] < least[:, None])))
            if not live.any():
                if not open_[rows, order[:, done:]].any():
                    break
                done, step = done + step, 2 * step
                continue
            ask, slot = np.nonzero(live)
            leaf = now[ask, slot]
            turn = np.argsort(leaf, kind="stable")
            ask, leaf = ask[turn], leaf[turn]
            found = [(q, at, s)]
            for part in np.split(np.arange(len(leaf)), np.flatnonzero(np.diff(leaf)) + 1):
                a, b = self.ends[leaf[part[0]]], self.ends[leaf[part[0]] + 1]
                asked = ask[part]
                scores = products(queries[asked], self.vectors[a:b])
                ids, uids = self.ids[a:b], self.uids[a:b]
                better = (scores > score[asked, None]) | ((scores == score[asked, None]) & (ids[None, :] < least[asked, None]))
                better &= uids[None, :] != own[asked, None]
                i, j = np.nonzero(better)
                found.append((asked[i], a + j, scores[i, j]))
            q, at, s = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = np.lexsort((self.ids[at], -s, q))
            q, at, s = q[keep], at[keep], s[keep]
            start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
            place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
            last = place == k - 1
            score[q[last]], least[q[last]] = s[last], self.ids[at[last]]
            q, at, s = q[place < k], at[place < k], s[place < k]
            done, step = done + step, 2 * step
        return q, at, s


# -- jobs ----------------------------------------------------------------------------


def _column(batch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _searched(k: int):
    """Of rows in order of shard and block, a shard's vectors before its queries: what each query finds."""

    def run(batches):
        at, kept, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([_column(batch, c).to_numpy() for c in ("dim", "shard", "block", "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part, key = batch.slice(a, b - a), tuple(keys[:3, a].tolist())
                if key != at:
                    at, kept, tree = key, [], None
                if not keys[3, a]:
                    kept.append(part)
                    continue
                if not kept:
                    continue
                if tree is None:
                    table = pa.Table.from_batches(kept)
                    ids = table.column("vec_id").fill_null(HIGH).to_numpy()
                    tree = KdTree(unpacked(table.column("v").to_pylist(), at[0]), ids, table.column("uid").to_numpy())
                    named = dict(zip(table.column("uid").to_pylist(), table.column("vec_id").is_null().to_pylist(), strict=True))
                    nameless = np.array([named[u] for u in tree.uids.tolist()], bool)
                for c in range(0, part.num_rows, AT_ONCE):
                    block = part.slice(c, AT_ONCE)
                    own = _column(block, "uid").to_numpy()
                    q, place, score = tree.search(
                        unpacked(_column(block, "v").to_pylist(), at[0]), own, k,
                        _column(block, "floor").fill_null(LOW).to_numpy(), _column(block, "floor_id").fill_null(HIGH).to_numpy(),
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[q]), _column(block, "vec_id").take(pa.array(q)),
                            pa.array(tree.ids[place], pa.int64(), mask=nameless[place]), pa.array(score),
                        ],
                        names=["uid", "query_id", "vec_id", "score"],
                    )

    return run


def _met(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    rows = vectors.select(*_ROW).unionByName(queries.select(*_ROW))
    keys = ["dim", "shard", "block"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(_searched(k), FOUND)


_ROW = [part.split()[0] for part in ROW.split(", ")]


def top_k(
    vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE,
    shard_bytes: int = SHARD_BYTES, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of each query, equal scores by smaller id."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = rows.mapInArrow(_scaled(scale), "vec_id long, dim int, v binary")
    # written: a row keeps its number in all that follows
    base = pinned(whole.withColumn("uid", F.monotonically_increasing_id()))
    is_query = F.col("vec_id") % every == 0
    sizes = base.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("n_queries"))
    room = F.greatest(F.lit(1), F.lit(shard_bytes) / (8 * F.greatest(F.col("dim"), F.lit(1))))
    sizes = pinned(
        sizes.select("dim", F.ceil(F.col("n") / room).cast("int").alias("shards"), F.ceil(F.col("n_queries") / query_block).cast("int").alias("blocks"))
    )
    none = F.lit(None).cast("long")
    dealt = base.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("uid"), F.col("shards")).cast("int"))
    dealt = dealt.withColumn("block", F.lit(0)).withColumn("kind", F.lit(0)).withColumn("floor", none).withColumn("floor_id", none)
    queries = dealt.filter(is_query).withColumn("kind", F.lit(1))
    home = pinned(_met(dealt, queries, k))
    best = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = home.withColumn("rank", F.row_number().over(best))
    floors = ranked.filter(F.col("rank") == k).select("uid", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
    away = queries.drop("floor", "floor_id").join(floors, "uid", "left").withColumn("home", F.col("shard"))
    away = away.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), F.col("blocks")).cast("int"))
    away = away.withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)"))).filter("shard <> home")
    spread = dealt.filter("shards > 1").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    found = home.unionByName(_met(spread.filter("blocks > 0"), away, k))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
