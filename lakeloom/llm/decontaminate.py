"""Benchmark decontamination by spaced-seed hashing, in DataFrame expressions only.

Fixed masks read seven of eleven neighbouring words and ignore the others; the hash of
what a mask reads is a seed. Seeds of the benchmark and of the documents are joined. Around
each hit document and item are laid side by side, twelve words further on both sides. Of
this stretch the part counts that has most equal words, the shortest and first of several:
it has the seed's words in it, ``MIN_EQUAL`` equal words at least, and seven tenths of its
words are equal. Words may be replaced within it, at ignored places or not; an excerpt
within other text is a part of its stretch.

Defined cases: words are runs of letters and digits, lower-cased. Null and empty texts have
no overlap. Items of ``MIN_SHORT`` to ten words have no seeds; a document that has all their
words in a row overlaps them, a hit for each place. Items of fewer words, one common word
say, would remove documents wholesale: they are not searched, ``skipped_items`` names them.
Items that repeat are reported each; documents that are equal in id and text are one row.
Whole texts count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import text_of
from lakeloom.session import pinned

MASKS = ("11011001101", "10111010011", "11100101101")
SPAN = 11
AROUND = 12
MIN_EQUAL = 10
MIN_PERCENT = 70
MIN_SHORT = 5  # words that an item has at least
SEED_BYTES = 64 << 20  # seeds that are broadcast at once
PORTIONS = 3  # of so many bytes are broadcast one after the other; more seeds meet the documents in a shuffle


def _tokens(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def _seeds(tokens: str, masks=MASKS) -> Column:
    """Seeds of all masks one after the other; position within a mask is the index modulo their number."""
    at = F.col(tokens)

    def of(k: int, mask: str) -> Column:
        places = [i for i, c in enumerate(mask) if c == "1"]
        return F.transform(
            F.sequence(F.lit(0), F.size(at) - SPAN), lambda i: F.xxhash64(F.lit(k), *[at[i + p] for p in places])
        )

    none = F.array().cast("array<bigint>")
    return F.when(F.size(at) >= SPAN, F.concat(*[of(k, m) for k, m in enumerate(masks)])).otherwise(none)


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """item_id, item_at, seed, and ``near``: the word hashes of the item around the place.

    ``ahead`` and ``behind`` count those before and after it, ``AROUND`` at most, so that a
    row stays small however long an item is.
    """
    rows = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), _tokens(text_of(benchmark)).alias("item")
    ).withColumn("seeds", _seeds("item"))
    rows = rows.select("item_id", "item", F.posexplode_outer("seeds").alias("place", "seed")).filter("seed is not null")
    rows = rows.withColumn("item_at", (F.col("place") % (F.size("item") - SPAN + 1)).cast("int"))
    ahead = F.least(F.lit(AROUND), F.col("item_at"))
    behind = F.least(F.lit(AROUND), F.size("item") - F.col("item_at") - SPAN)
    near = F.slice("item", F.col("item_at") - ahead + 1, ahead + SPAN + behind)
    return rows.select("item_id", "item_at", "seed", ahead.alias("ahead"), behind.alias("behind"), near.alias("near"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, and of the best overlap: equal, length, doc_at (its first word); hits counts seeds."""
    seeds = pinned(benchmark_seeds(benchmark))
    held = seeds.agg(F.coalesce(F.sum(F.size("near") * 8 + 48), F.lit(0))).first()[0]
    portions = max(1, -(-held // SEED_BYTES))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_hash"),
        _tokens(text_of(docs)).alias("tokens"),
    ).withColumn("seeds", _seeds("tokens"))
    # outer: a filter on the size of ``seeds`` would be pushed below and compute the words once for each seed
    placed = rows.select("doc_id", "text_hash", "tokens", F.posexplode_outer("seeds").alias("place", "seed"))
    if portions <= PORTIONS:
        own = F.pmod(F.xxhash64("item_id", "item_at"), F.lit(portions))
        hits = reduce(
            DataFrame.unionByName,
            [placed.join(F.broadcast(seeds.filter(own == k)), "seed") for k in range(portions)],
        )
    else:  # seeds alone are dealt out, the words of a document come to its hits afterwards
        slim = placed.select("doc_id", "text_hash", "place", "seed").filter("seed is not null")
        found = pinned(slim.join(seeds, "seed"))
        whose = F.col("f.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("f.text_hash") == F.col("r.text_hash"))
        words = rows.select("doc_id", "text_hash", "tokens").dropDuplicates(["doc_id", "text_hash"])
        hits = found.alias("f").join(words.alias("r"), whose).select("f.*", "r.tokens")
    hits = hits.withColumn("doc_at", (F.col("place") % (F.size("tokens") - SPAN + 1)).cast("int"))
    left = F.least("ahead", "doc_at")
    right = F.least("behind", F.size("tokens") - F.col("doc_at") - SPAN)
    hits = hits.select(
        "doc_id", "text_hash", "item_id", "doc_at", left.alias("left"), right.alias("right"),
        F.slice("tokens", F.col("doc_at") - left + 1, left + SPAN + right).alias("a"),
        F.slice("near", F.col("ahead") - left + 1, left + SPAN + right).alias("b"),
    )
    same = F.transform(F.zip_with("a", "b", lambda x, y: x == y), lambda e: e.cast("int"))
    # exploded: as a plain column it would be computed once for each use, and a filter on it would become
    # part of the join, which then copies all words of a document for each of its seeds
    laid = hits.select("doc_id", "text_hash", "item_id", "doc_at", "left", "right", F.explode(F.array(same)).alias("same"))
    checked = laid.select("doc_id", "text_hash", "item_id", F.explode(F.array(_best_part())).alias("part"))
    grouped = checked.groupBy("doc_id", "text_hash", "item_id").agg(F.max("part").alias("best"), F.count("part").alias("hits"))
    found = grouped.filter("hits > 0").select(
        "doc_id", "text_hash", "item_id", F.col("best.equal").alias("equal"), (-F.col("best.short")).alias("length"),
        (-F.col("best.early")).alias("doc_at"), "hits",
    )
    short = _short_overlaps(docs, benchmark)
    return found if short is None else found.unionByName(short)


def _passes(equal: Column, length: Column) -> Column:
    return (equal >= MIN_EQUAL) & (100 * equal >= MIN_PERCENT * length)


def _part(equal: Column, ahead: Column, behind: Column) -> Column:
    """A part with so many equal words that begins and ends so many words from the seed's."""
    return F.struct(equal.alias("equal"), (-(ahead + SPAN + behind)).alias("short"), (ahead - F.col("doc_at")).alias("early"))


def _best_part() -> Column:
    """The part of a stretch with most equal words that passes, with the seed's words in it; null if none does.

    Where all equal words together pass, they are the best part. Else every beginning is met
    with every end.
    """
    before, after = F.slice("same", F.lit(1), F.col("left")), F.slice("same", F.col("left") + SPAN + 1, F.col("right"))
    first, last = F.array_position(before, 1).cast("int"), F.array_position(F.reverse(after), 1).cast("int")
    ahead = F.when(first > 0, F.col("left") - first + 1).otherwise(0)
    behind = F.when(last > 0, F.col("right") - last + 1).otherwise(0)
    equal = F.size(F.array_remove("same", 0))

    def ones(start, n):
        return F.size(F.array_remove(F.slice("same", start, n), 0))

    core = ones(F.col("left") + 1, F.lit(SPAN))
    starts = F.transform(F.sequence(F.lit(0), "left"), lambda i: F.struct(i.alias("n"), ones(F.col("left") - i + 1, i).alias("equal")))
    ends = F.transform(
        F.sequence(F.lit(0), "right"), lambda j: F.struct(j.alias("n"), (core + ones(F.col("left") + SPAN + 1, j)).alias("equal"))
    )
    parts = F.flatten(F.transform(starts, lambda x: F.transform(ends, lambda y: _part(x["equal"] + y["equal"], x["n"], y["n"]))))
    searched = F.array_max(F.filter(parts, lambda p: _passes(p["equal"], -p["short"])))
    return F.when(_passes(equal, ahead + SPAN + behind), _part(equal, ahead, behind)).otherwise(searched)


def skipped_items(benchmark: DataFrame) -> DataFrame:
    """item_id and number of words of the items that are too short to be searched."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.size(_tokens(text_of(benchmark))).alias("n_words"))
    return items.filter(F.col("n_words") < MIN_SHORT)


def _short_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """Items of ``MIN_SHORT`` words to fewer than ``SPAN``, as rows of ``overlaps``: all their words in a row. None without such items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _tokens(text_of(benchmark)).alias("item"))
    items = items.filter((F.size("item") >= MIN_SHORT) & (F.size("item") < SPAN))
    items = pinned(items.select("item_id", F.size("item").alias("length"), F.xxhash64("item").alias("run")))
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # six at most
    if not lengths:
        return None
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_hash"),
        _tokens(text_of(docs)).alias("tokens"),
    )

    def runs(n: int) -> Column:
        at = F.sequence(F.lit(0), F.size("tokens") - n)
        each = F.transform(
            at, lambda i: F.struct(F.lit(n).alias("length"), F.xxhash64(F.slice("tokens", i + 1, n)).alias("run"), i.alias("doc_at"))
        )
        return F.when(F.size("tokens") >= n, each).otherwise(F.array().cast("array<struct<length:int,run:bigint,doc_at:int>>"))

    placed = rows.select("doc_id", "text_hash", F.explode(F.concat(*map(runs, lengths))).alias("r"))
    hits = placed.select("doc_id", "text_hash", "r.*").join(items, ["length", "run"])
    # a document that repeats is one row, its places counted as often as it does, as for longer items
    return hits.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("length").alias("equal"), F.max("length").alias("length"), F.min("doc_at").alias("doc_at"), F.count("*").alias("hits")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no item, in the columns of ``docs``."""
    found = pinned(overlaps(docs, benchmark).select("doc_id", "text_hash").distinct())
    keyed = docs.withColumn("__text", F.xxhash64(text_of(docs))).alias("d")
    same = (F.col("d.__text") == F.col("f.text_hash")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("f.doc_id"))
    return keyed.join(found.alias("f"), same, "left_anti").drop("__text")
