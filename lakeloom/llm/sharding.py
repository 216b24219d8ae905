"""Two-pass external shuffle into shards.

Pass one scatters the rows over memory-sized buckets by a seeded hash of the whole row.
Pass two puts each bucket into a fixed order, shuffles it by Fisher-Yates with a generator
seeded by the bucket, and writes it. The buckets one after the other are the shuffled
order; it is cut into shards whose row counts differ by one at most (law ``rows``).

Defined cases: a null text has size 1 and checksum 0. Rows that are equal in every column
go to different buckets by their number within the input partition, so that a row repeated
many times fills no bucket; which of the equal rows is which does not matter. An empty
table gives no rows. Input columns named like the new ones give way to them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import text_of, with_columns
from lakeloom.session import pinned

BUCKET_BYTES = 32 << 20
MIN_BUCKETS = 64


def digests(docs: DataFrame, *kept: str) -> DataFrame:
    """doc_id, size in bytes plus one, and CRC-32 of the text: what a shard listing needs; and columns that are kept."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of(docs)) + 1).cast("long").alias("size"),
        F.crc32(text_of(docs)).alias("text_crc32"),
        *kept,
    )


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _scatter(buckets: int, seed: int):
    def run(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            keys = batch.column(batch.num_columns - 1).to_numpy()
            ranks = np.zeros(len(keys), np.uint64)
            for i, k in enumerate(keys.tolist()):
                if k in seen:
                    ranks[i] = seen[k]
                    seen[k] += 1
                else:
                    seen[k] = 1
            with np.errstate(over="ignore"):
                mixed = _mixed(keys.astype(np.uint64) + ranks * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
            bucket = pa.array((mixed % np.uint64(buckets)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, bucket], names=[*batch.schema.names, "__bucket"])

    return run


def fisher_yates(n: int, rng: np.random.Generator) -> list[int]:
    order = list(range(n))
    draws = rng.integers(0, np.arange(1, n + 1)).tolist() if n else []
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return order


def _shuffled(seed: int):
    def run(group: pa.Table) -> pa.Table:
        # a fixed order first: a task that runs again meets its rows in another one
        group = group.take(np.argsort(group.column("__key").to_numpy(), kind="stable"))
        bucket = group.column("__bucket")[0].as_py()
        order = fisher_yates(group.num_rows, np.random.default_rng([seed, bucket]))
        return group.take(pa.array(order, pa.int64())).append_column(
            "__place", pa.array(np.arange(group.num_rows, dtype=np.int64))
        )

    return run


def shard(
    docs: DataFrame,
    n_shards: int,
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
    min_buckets: int = MIN_BUCKETS,
    size: str | None = None,
) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` and ``slot``; ``size`` names a column with bytes per row.

    Without it the bytes of ``text`` count. The number of buckets follows the total, so a
    bucket holds about ``bucket_bytes`` at any scale.
    """
    docs = docs.drop("shard", "slot")
    spark = docs.sparkSession
    weight = F.col(size) if size else F.octet_length(text_of(docs)) + 1
    total = docs.agg(F.coalesce(F.sum(weight.cast("long")), F.lit(0))).first()[0]
    buckets = max(min_buckets, -(-total // bucket_bytes))
    keyed = docs.withColumn("__key", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns]))
    schema = with_columns(keyed.schema, ("__bucket", "long"))
    scattered = keyed.mapInArrow(_scatter(buckets, seed), schema)
    placed = pinned(scattered.groupBy("__bucket").applyInArrow(_shuffled(seed), with_columns(schema, ("__place", "long"))))

    counts = placed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = pinned(counts.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    rows = placed.count()
    if not rows:
        return spark.createDataFrame([], with_columns(docs.schema, ("shard", "integer"), ("slot", "long")))
    at = placed.join(offsets, "__bucket").withColumn("__at", F.col("__offset") + F.col("__place"))
    at = at.withColumn("shard", F.expr(f"cast(__at * {n_shards} div {rows} as int)"))
    first = F.expr(f"(cast(shard as long) * {rows} + {n_shards - 1}) div {n_shards}")
    return at.withColumn("slot", F.col("__at") - first).select(*docs.columns, "shard", "slot")


def write_shards(docs: DataFrame, path: str, n_shards: int, **how) -> None:
    """The shards as folders ``shard=N``, each file in slot order."""
    placed = shard(docs, n_shards, **how)
    ranged = placed.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
