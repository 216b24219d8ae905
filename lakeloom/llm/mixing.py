"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a queue in a shuffled order, twice over. A place in the
queue has a virtual finish time: the source's words up to and with it, divided by the
source's target. All places are sorted by finish time and taken until the budget is spent.

Defined cases: a null text has no words; null is a source of its own and comes last.
Documents without words are never taken. Equal rows are interchangeable. An empty table
gives no rows. Extra columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import text_of, word_count
from lakeloom.session import pinned

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # the budget: three halves of all words
MOST = 2  # times a document is taken at most


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """source, source_size to rank, weight, target; one row per source.

    Targets are weight times a level, but ``most`` times the source's size at most. With
    the sources ordered by that limit per weight, the level is fixed by the first source
    that does not reach its limit; the windows run over one row per source.
    """
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    cap = F.col("source_size") * most
    order = Window.orderBy(cap / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (
        (F.sum("source_size").over(every) * share[0] / share[1] - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # the level of the first source that stays below its limit; the limits hold for those before it
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= cap, F.struct("cap_order", "level"))).over(every)
    return (
        ranked.withColumn("level", level)
        .withColumn("cap_order", F.row_number().over(order))
        .withColumn("open", open_level)
        .withColumn(
            "target",
            F.when(F.col("open").isNull() | (F.col("cap_order") < F.col("open.cap_order")), cap.cast("double")).otherwise(
                F.col("open.level") * F.col("weight")
            ),
        )
        .select("source", "source_size", "rank", "weight", "target")
    )


def _running(ranged: DataFrame, keys: list[str], order: list, value: str, name: str) -> DataFrame:
    """Running sums over a range-partitioned table (column ``part``) without one task for all.

    Within a part a window, plus the sums of the parts before; a hot key is in many parts.
    """
    parts = ranged.groupBy("part", *keys).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(parts.select("part", *keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")))
    within = Window.partitionBy("part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("__within", F.sum(value).over(within))
        .join(offsets, ["part", *keys])
        .withColumn(name, F.col("__within") + F.col("__before"))
        .drop("__within", "__before")
    )


def _ranged(df: DataFrame, *order) -> DataFrame:
    return pinned(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """What the queues need of a document: id, source, words, and its place in the shuffled order."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text_of(docs)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("draw"),
        F.xxhash64(text_of(docs)).alias("text_hash"),
    )


def mix(docs: DataFrame, seed: int = 17, weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """Per document: doc_id, source, size, text_hash, source_size, target, times, taken."""
    return queue(pinned(sized(docs, seed)), weights, share, most)


def queue(rows: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """The same for rows that are sized already."""
    sources = pinned(
        targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    )
    budget = sources.agg(F.expr(f"coalesce(sum(source_size), 0) * {share[0]} div {share[1]}")).first()[0]
    ranked = (
        rows.alias("r")
        .join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        .select("r.*", "s.source_size", "s.rank", "s.target")
        # equal rows may lie in different parts: the last key only keeps them apart
        .withColumn("tie", F.monotonically_increasing_id())
    )
    order = ["draw", "doc_id", "text_hash", "size", "tie"]
    queued = pinned(_running(_ranged(ranked, "rank", *order), ["rank"], order, "size", "served"))

    def finish(time: int):
        return F.when(F.col("target") > 0, (F.col("served") + F.col("source_size") * time) / F.col("target"))

    places = queued.filter("size > 0").select(
        "rank", "size", F.explode(F.array(*[finish(t) for t in range(most)])).alias("finish")
    )
    lined = _running(_ranged(places, "finish", "rank"), [], ["finish", "rank"], "size", "spent")
    cut = lined.filter(F.col("spent") <= budget).agg(F.max(F.struct("finish", "rank")).alias("cut")).first()[0]
    if cut is None:
        times = F.lit(0)
    else:
        at = F.lit(cut["finish"]).cast("double")
        times = sum(
            F.when((finish(t) < at) | ((finish(t) == at) & (F.col("rank") <= cut["rank"])), 1).otherwise(0)
            for t in range(most)
        )
    times = F.when(F.col("size") > 0, times).otherwise(0).cast("int")
    return queued.withColumn("times", times).select(
        "doc_id", "source", "size", "text_hash", "source_size", "target", "times",
        (F.col("size") * times).alias("taken"),
    )


def mixed_documents(docs: DataFrame, seed: int = 17, **how) -> DataFrame:
    """The documents that the mix takes, as often as it takes them; the columns of ``docs``.

    Rows with equal id, source and text are taken alike on average: their times are summed
    and dealt to them as evenly as whole numbers allow, the rest to the first by row hash.
    """
    spark = docs.sparkSession
    key = ["__id", "__source", "__text"]
    taken = pinned(
        mix(docs, seed, **how)
        .groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_hash").alias("__text"))
        .agg(F.sum("times").alias("__times"), F.count("*").alias("__rows"))
        .filter("__times > 0")
    )
    keyed = docs.select(
        "*",
        F.col("doc_id").cast("long").alias("__id"),
        F.col("source").cast("string").alias("__source"),
        F.xxhash64(text_of(docs)).alias("__text"),
    )
    same = None
    for c in key:
        part = F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}"))
        same = part if same is None else same & part
    joined = keyed.alias("d").join(taken.alias("t"), same).select("d.*", "t.__times", "t.__rows")
    one = joined.filter("__rows = 1").withColumn("__copies", F.col("__times"))
    # written: both branches below must see the same numbers
    many = pinned(joined.filter("__rows > 1").withColumn("__tie", F.monotonically_increasing_id()))
    # repeats of one row are numbered within salted groups, so that a hot row is not one task's work
    salted = many.withColumn("__salt", F.col("__tie") % 64)
    groups = salted.groupBy(*key, "__salt").agg(F.count("*").alias("__in"))
    before = Window.partitionBy(*key).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("__off", F.coalesce(F.sum("__in").over(before), F.lit(0)))
    same = F.col("d.__salt") == F.col("g.__salt")
    for c in key:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"g.{c}"))
    number = F.row_number().over(Window.partitionBy(*key, "__salt").orderBy("__tie")) - 1
    many = (
        salted.withColumn("__number", number).alias("d").join(groups.alias("g"), same)
        .select("d.*", (F.col("d.__number") + F.col("g.__off")).alias("__at"))
        .withColumn("__copies", F.expr("__times div __rows + if(__at < __times % __rows, 1, 0)"))
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = one.select("__copies", *columns).unionByName(many.select("__copies", *columns))
    out = out.filter("__copies > 0").withColumn("__copy", F.explode(F.expr("sequence(1, cast(__copies as int))")))
    return out.select(*columns) if docs.columns else spark.createDataFrame([], docs.schema)
