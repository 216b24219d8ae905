"""Size of a lake: statistics of its seed tables, and what subtables would add."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.ranges import running_sum
from lakeloom.session import pinned

# The numbers of projections that the sweep goes through.
SWEEP = [1, 3, 5, 10, 30, 50, 100]


def seed_stats(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """``(seed_table, rows, cols, n_num, c_num, size, cells)`` before anything is written.

    ``size`` is the number of bytes of the text in the cells. The subject column
    counts as a text column.
    """
    filled = F.aggregate(
        F.map_values("attrs"), F.lit(0).cast("long"), lambda acc, v: acc + F.octet_length(v).cast("long")
    )
    counted = rows.groupBy("seed_table").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("subject") + filled).alias("size")
    )
    shapes = columns.groupBy("seed_table").agg(
        (F.count("*") + 1).alias("cols"),
        F.count_if("is_numeric").alias("n_num"),
        (F.count_if(~F.col("is_numeric")) + 1).alias("c_num"),
    )
    return with_cells(
        counted.join(shapes, "seed_table").select("seed_table", "rows", "cols", "n_num", "c_num", "size")
    )


def with_cells(stats: DataFrame) -> DataFrame:
    return stats.withColumn("cells", F.col("rows") * F.col("cols"))


def at_ranks(stats: DataFrame, columns: Sequence[str], ranks: dict[str, Column]) -> DataFrame:
    """``(column, <rank name> …)``: the values at given ranks (from 0, over ``n`` rows) of sorted columns.

    Equal values are counted first, and the counts summed up over ranges of values, so that
    no task holds a whole column.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counted = stats.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("c"))
    upto = running_sum(counted, "c", "upto", ["value"], ["column"])
    sizes = pinned(counted.groupBy("column").agg(F.sum("c").alias("n")))
    found = upto.join(sizes, "column").groupBy("column")
    return found.agg(*[F.min(F.when(F.col("upto") > rank, F.col("value"))).alias(name) for name, rank in ranks.items()])


def summary(stats: DataFrame, min_cols: int = 8, q: float = 0.8) -> DataFrame:
    """Median, mean and quantile of rows, columns and cells for tables wider than ``min_cols``.

    The quantile is the value at rank round(q·(n-1)).
    """
    named = [("rows", "row"), ("cols", "col"), ("cells", "cell")]
    wide = stats.filter(F.col("cols") > min_cols)
    n = F.col("n")
    ranks = {"low": F.floor((n - 1) / 2), "high": F.ceil((n - 1) / 2), "qle": F.round((n - 1) * F.lit(q))}
    placed = at_ranks(wide, [c for c, _ in named], ranks)

    def of(column: str, value: Column) -> Column:
        return F.max(F.when(F.col("column") == column, value))

    picked = placed.agg(
        *[of(c, (F.col("low") + F.col("high")) / 2).alias(f"{n}_median") for c, n in named],
        *[of(c, F.col("qle")).cast("long").alias(f"{n}_qle") for c, n in named],
    )
    means = wide.agg(*[F.avg(c).alias(f"{n}_mean") for c, n in named], F.count("*").alias("len"))
    order = [f"{n}_{what}" for what in ("median", "mean", "qle") for _, n in named]
    both = picked.unionByName(means, allowMissingColumns=True)  # one row each
    return both.agg(*[F.max(c).alias(c) for c in [*order, "len"]])


def _number(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _expected(stats: DataFrame, drawn_cols: Column, resample_rows: int, fraction: float, min_rows: int) -> Column:
    """Expected bytes of a table's subtables, 0 for a table that stays too small."""
    exp_rows = F.col("rows") * (1 + resample_rows * F.lit(fraction))
    size = F.col("size") / F.col("cells") * (exp_rows * drawn_cols)
    return F.when(exp_rows > min_rows, size).otherwise(F.lit(0.0))


def expected_all(
    stats: DataFrame, resample_rows: int, resample_columns: Column | int, fraction: float = 0.7, min_rows: int = 100
) -> Column:
    """Expected bytes of the subtables drawn over all columns."""
    cols = (F.col("cols") + F.col("cols") - 2) / 2 * _number(resample_columns)
    return _expected(stats, cols, resample_rows, fraction, min_rows)


def expected_numeric(
    stats: DataFrame, resample_rows: int, resample_columns: Column | int, fraction: float = 0.7, min_rows: int = 100
) -> Column:
    """Expected bytes of the subtables drawn over the numeric columns."""
    least = F.when(F.col("n_num") > 2, F.col("n_num") - 2).otherwise(2)
    cols = (F.col("n_num") + least) / 2 * _number(resample_columns)
    return _expected(stats, cols, resample_rows, fraction, min_rows)


def size_all(stats: DataFrame, resample_rows: int, resample_columns: int, fraction: float = 0.7, min_rows: int = 100):
    return stats.agg(
        F.sum(expected_all(stats, resample_rows, resample_columns, fraction, min_rows)).alias("exp_size")
    )


def size_numeric(
    stats: DataFrame, resample_rows: int, resample_columns: int, fraction: float = 0.7, min_rows: int = 100
):
    return stats.agg(
        F.sum(expected_numeric(stats, resample_rows, resample_columns, fraction, min_rows)).alias("exp_size")
    )


def estimate_size(
    stats: DataFrame,
    resample_rows: int,
    resample_columns: Column | int,
    fraction: float = 0.7,
    min_rows: int = 100,
    min_cols: int = 8,
    by: Sequence[str] = (),
) -> DataFrame:
    """Total expected bytes: both kinds of subtables of the tables wider than ``min_cols``."""
    wide = stats.filter(F.col("cols") > min_cols)
    both = expected_all(wide, resample_rows, resample_columns, fraction, min_rows) + F.when(
        F.col("n_num") >= 2, expected_numeric(wide, resample_rows, resample_columns, fraction, min_rows)
    ).otherwise(F.lit(0.0))
    return wide.groupBy(*by).agg(F.sum(both).alias("exp_size"))


def sweep(
    stats: DataFrame,
    resample_rows: int = 2,
    min_rows: int = 50,
    min_cols: int = 8,
    projections: Sequence[int] = tuple(SWEEP),
) -> DataFrame:
    """``(resample_columns, n_tables, exp_size)`` for several numbers of projections, one pass.

    The size uses its own defaults for the least rows and columns, not the ones given
    here for the table count.
    """
    each = stats.withColumn("resample_columns", F.explode(F.array(*[F.lit(c) for c in projections])))
    viable = (F.col("rows") > min_rows) & (F.col("cols") > min_cols)
    counted = each.groupBy("resample_columns").agg(
        (F.count_if(viable & (F.col("n_num") > 2)) + F.count_if(viable)).alias("n")
    )
    sizes = estimate_size(each, resample_rows, F.col("resample_columns"), by=["resample_columns"])
    return counted.join(sizes, "resample_columns", "left").select(
        "resample_columns",
        (F.col("n") * (resample_rows + 1) * F.col("resample_columns")).alias("n_tables"),
        F.coalesce("exp_size", F.lit(0.0)).alias("exp_size"),
    )


def bytes_per_cell(stats: DataFrame, min_rows: int = 100, min_cols: int = 8) -> DataFrame:
    """Mean bytes per cell of the tables that are long and wide enough."""
    return stats.filter((F.col("rows") > min_rows) & (F.col("cols") > min_cols)).agg(
        F.avg(F.col("size") / F.col("cells")).alias("avg_size")
    )
