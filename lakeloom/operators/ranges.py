"""Running sums over a global order without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import pinned


def running_sum(df: DataFrame, value: str, name: str, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` plus the sum of ``value`` up to and with each row, in ``order`` within ``keys``.

    Rows are dealt into ranges of (keys, order) and written; each range sums its own, plus
    the sums of the ranges before, which are one row per range and key.
    """
    keys, order = list(keys), list(order)
    ranged = pinned(df.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy("__part", *keys).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(sums.select("__part", *keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")))
    within = Window.partitionBy("__part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("__within", F.sum(value).over(within)).join(offsets, ["__part", *keys])
    return summed.withColumn(name, F.col("__within") + F.col("__before")).drop("__part", "__within", "__before")
