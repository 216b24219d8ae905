"""Numbers, dates, arrays and hashes as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what counts as a number in a text column. try_cast alone would
# also take '1d' and ' 1 '; 'inf' and 'nan' stay text.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"

# Longest array that one generator step may build.
RANGE_STEP = 65536


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_number(c: Column | str) -> Column:
    return _col(c).rlike(NUMBER)


def is_text(c: Column | str) -> Column:
    """True for a value that keeps its column from becoming numeric."""
    return F.coalesce(~is_number(c), F.lit(False))


def to_number(c: Column | str) -> Column:
    """Double where the text is a number, NULL elsewhere; never raises."""
    return F.when(is_number(c), _col(c).try_cast("double"))


def full_date(c: Column | str, separator: str = "^^") -> Column:
    """Text before the separator as ISO date text; NULL unless year, month and day are there.

    The date goes back to text inside Spark because years before 1 cannot be
    carried into Python.
    """
    return F.try_to_date(F.substring_index(_col(c), separator, 1), "yyyy-MM-dd").cast("string")


def between_open(c: Column | str, start: str, end: str) -> Column:
    """Open date range on timestamp text: midnight of ``start`` and all of ``end`` are outside."""
    moment = F.try_to_timestamp(_col(c))
    return (moment > F.lit(start).cast("timestamp")) & (moment < F.lit(end).cast("timestamp"))


def log10_or_minus_inf(c: Column | str) -> Column:
    """log10 with minus infinity at zero, where the built-in gives NULL."""
    x = _col(c).cast("double")
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(F.log10(x))


def head(c: Column | str, k: int) -> Column:
    return F.slice(_col(c), 1, k)


def spread(c: Column | str, name: str, k: int) -> list[Column]:
    """Array to ``k`` columns ``name_0 …``; missing places are NULL."""
    return [F.get(_col(c), F.lit(i)).alias(f"{name}_{i}") for i in range(k)]


def table_id(columns: Column) -> Column:
    """Stable identifier of a table from its ordered column names."""
    return F.xxhash64(F.array_join(columns, "-"))


def order_hash(seed: int, *parts: Column) -> Column:
    """Repeatable pseudo-random 64-bit number for a row."""
    return F.xxhash64(F.lit(seed), *parts)


def explode_range(df: DataFrame, count: Column, out: str, spread_by: Sequence[str] = ()) -> DataFrame:
    """Each row ``count`` times, numbered 0 … count-1 in ``out``.

    Two generator steps, so that a row with a huge count never needs an array
    longer than ``count / RANGE_STEP``. With ``spread_by`` (key columns) the blocks of a
    row go to different tasks before they are numbered.
    """
    n, block = f"__{out}_n", f"__{out}_block"
    first = F.col(block) * RANGE_STEP
    blocks = (
        df.withColumn(n, count.cast("long"))
        .filter(F.col(n) > 0)
        .withColumn(block, F.explode(F.expr(f"sequence(0L, (`{n}` - 1) div {RANGE_STEP})")))
    )
    if spread_by:
        blocks = blocks.repartition(*spread_by, block)
    return (
        blocks.withColumn(out, F.explode(F.sequence(first, F.least(F.col(n), first + RANGE_STEP) - 1)))
        .drop(n, block)
    )


def non_null_any(columns: Sequence[str]) -> Column:
    """True where at least one of the columns holds a value."""
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns]).isNotNull()


def non_null_all(columns: Sequence[str]) -> Column:
    """True where every one of the columns holds a value."""
    test = F.lit(True)
    for c in columns:
        test = test & F.col(f"`{c}`").isNotNull()
    return test
