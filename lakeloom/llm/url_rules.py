"""URL filters: fixed host and path rules, and association rules mined from labelled urls.

A url becomes a set of tokens (labels of the host, steps of the path, names in the query).
Spark's FP-growth finds token combinations that go with the label; rules with too little
support or confidence, and those that a shorter rule implies, are pruned. Each rule is
posted under its rarest token; a url looks up its tokens there and is checked against whole
rules only.

Labels, where none are given, come from the pages: a page is blocked whose text is rejected
by the quality rules. Urls that a fixed rule decides are neither learnt from nor judged by
mined rules.

Every item of a url can be in a rule. What mining leaves out can be in no rule that is kept:
tokens that occur in exactly the same urls are one item; items of too few labelled urls;
items that are a sure rule by themselves, which implies every longer one; and items of all
urls, which a rule can do without. What is mined is counted again on all urls.

Defined cases: a null url, or one without ``://``, has an empty host and path, no tokens
of them, and is allowed. Equal urls get equal verdicts. Without blocked urls no rules are
mined. Extra columns of the input are not looked at.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import html_text, quality
from lakeloom.session import pinned

# fixed values: verdict, host, path
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)\??([^#]*)"
MIN_SUPPORT = 0.005  # share of the labelled urls that a rule blocks rightly
MIN_URLS = 2  # and how many at least
MIN_CONFIDENCE = 0.9
MAX_ITEMS = 10  # of a url; with more in some url mining is spread over a partition for each item


def _part(url: Column, k: int) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, k), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (verdict, rule), or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, at, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(at + below).alias("rule"))).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens; digits within a step count as ``#``, so that numbered pages are alike."""
    hosts = F.split(host_of(url), r"\.")
    places = F.transform(hosts, lambda x, i: F.when(i == F.size(hosts) - 1, F.concat(F.lit("top:"), x)).otherwise(F.concat(F.lit("host:"), x)))
    steps = F.split(F.regexp_replace(F.lower(path_of(url)), "[0-9]+", "#"), "[/.]")
    names = F.transform(F.split(F.lower(_part(url, 3)), "&"), lambda x: F.substring_index(x, "=", 1))
    full = F.concat(
        places,
        F.transform(F.filter(steps, lambda x: x != ""), lambda x: F.concat(F.lit("path:"), x)),
        F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("query:"), x)),
    )
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(full)))


RULE = "tokens array<string>, rarest string, confidence double, support double"


def _items(shapes: DataFrame, least: int) -> DataFrame:
    """``(token, item, often, blocked)``: tokens of enough blocked urls, those of the same urls as one item.

    The item is called like its first token. Which urls a token is in is told by two sums of
    hashes of their token sets.
    """
    h = [F.xxhash64(F.lit(k), "tokens").cast("decimal(20,0)") for k in (1, 2)]
    tokens = shapes.select("n", "n_blocked", h[0].alias("h1"), h[1].alias("h2"), F.explode("tokens").alias("token"))
    counted = tokens.groupBy("token").agg(
        F.sum("n").alias("often"), F.sum("n_blocked").alias("blocked"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2")
    )
    same = counted.filter(F.col("blocked") >= least).groupBy("often", "blocked", "h1", "h2")
    merged = same.agg(F.array_sort(F.collect_set("token")).alias("merged"))
    return merged.select(F.explode("merged").alias("token"), F.get("merged", F.lit(0)).alias("item"), "merged", "often", "blocked")


def _contained(sets: DataFrame, needed: DataFrame) -> DataFrame:
    """Pairs of ``sets.tokens`` and rows of ``needed`` whose tokens are all among them, found under the rarest one."""
    looked = sets.withColumn("rarest", F.explode("tokens"))
    hit = looked.join(needed.withColumnRenamed("tokens", "needed"), "rarest")
    return hit.filter(F.size(F.array_except("needed", "tokens")) == 0)


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    min_urls: int = MIN_URLS,
) -> DataFrame:
    """Rules (tokens, rarest, confidence, support) from rows with ``tokens`` and boolean ``blocked``."""
    spark = labelled.sparkSession
    blocked = F.coalesce(F.col("blocked"), F.lit(False))
    shapes = labelled.groupBy("tokens").agg(F.count("*").alias("n"), F.count_if(blocked).alias("n_blocked"))
    shapes = pinned(shapes.filter(F.size("tokens") > 0))
    total = shapes.agg(F.sum("n"), F.sum("n_blocked")).first()
    if not total[1]:
        return spark.createDataFrame([], RULE)
    least = max(min_urls, math.ceil(min_support * total[0]))
    items = pinned(_items(shapes, least))
    merged = items.filter(F.col("token") == F.col("item"))
    mixed = merged.filter((F.col("blocked") < F.col("often")) & (F.col("often") < total[0])).select("token", "item")
    numbered = shapes.filter("n_blocked > 0").withColumn("shape", F.monotonically_increasing_id())
    held = numbered.select("shape", "n_blocked", F.explode("tokens").alias("token"))
    baskets = held.join(mixed, "token").groupBy("shape", "n_blocked").agg(F.collect_list("item").alias("items"))
    baskets = pinned(baskets.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n_blocked"))).select("items"))
    n_baskets, longest = baskets.agg(F.count("*"), F.max(F.size("items"))).first()
    single = merged.select(F.array("item").alias("items"))
    found = single.limit(0)
    if n_baskets >= least:
        growth = FPGrowth(itemsCol="items", minSupport=least / n_baskets, minConfidence=1.0)
        if longest > MAX_ITEMS:
            growth.setNumPartitions(max(1, mixed.count()))
        found = growth.fit(baskets).freqItemsets.select("items").filter(F.size("items") > 1)
    # whole items again, counted on all urls
    sets = pinned(single.unionByName(found).withColumn("id", F.monotonically_increasing_id()))
    parts = sets.select("id", F.explode("items").alias("item")).join(merged.select("item", "merged", "often"), "item")
    rarest = F.min(F.struct("often", "item")).getField("item")
    needed = pinned(
        parts.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("merged"))).alias("tokens"), rarest.alias("rarest")).drop("id")
    )
    counted = _contained(shapes, needed).groupBy("needed", "rarest").agg(F.sum("n").alias("n"), F.sum("n_blocked").alias("n_blocked"))
    sure = counted.withColumn("confidence", F.col("n_blocked") / F.col("n"))
    sure = sure.filter((F.col("confidence") >= min_confidence) & (F.col("n_blocked") >= least))
    rules = pinned(
        sure.select(F.col("needed").alias("tokens"), "rarest", "confidence", (F.col("n_blocked") / F.lit(total[0])).alias("support"))
    )
    # a rule that holds another one whole, and is no surer, adds nothing
    shorter = rules.select("tokens", "rarest", F.col("confidence").alias("other"))
    implied = _contained(rules.select("tokens", "confidence"), shorter)
    implied = implied.filter((F.size("needed") < F.size("tokens")) & (F.col("other") >= F.col("confidence")))
    return pinned(rules.join(implied.select("tokens").distinct(), "tokens", "left_anti"))


def matched(shapes: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens and the best confidence among the mined rules they contain; ``shapes`` has distinct ``tokens``."""
    return _contained(shapes.select("tokens"), rules).groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def labels_of(pages: DataFrame) -> DataFrame:
    """url and blocked: whether the quality rules reject the text of the page."""
    keyed = pinned(pages.select(F.col("url").cast("string").alias("url"), "html").withColumn("page_id", F.monotonically_increasing_id()))
    text = html_text.extract(keyed.select("page_id", "html")).withColumnRenamed("page_id", "doc_id")
    judged = quality.judge(text.withColumn("lang", F.lit(None).cast("string")))
    return keyed.join(judged.select(F.col("doc_id").alias("page_id"), (~F.col("kept")).alias("blocked")), "page_id").select("url", "blocked")


def judge(pages: DataFrame, rules=RULES, labels: DataFrame | None = None, **limits) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence.

    ``labels`` (url, blocked) is what rules are mined from, without it ``labels_of`` the
    pages. Urls without a fixed rule get the mined verdict, and only they are learnt from.
    """
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        tokens_of(url).alias("tokens"),
    )
    rows = pinned(rows.withColumn("fixed", fitting_rule(F.col("host"), F.col("path"), rules)))
    known = labels_of(pages) if labels is None else labels.select(F.col("url").cast("string").alias("url"), "blocked")
    open_ = known.filter(fitting_rule(host_of(F.col("url")), path_of(F.col("url")), rules).isNull())
    mined = mine(open_.select(tokens_of(F.col("url")).alias("tokens"), "blocked"), **limits)
    # verdicts are found once per token set; many pages share one
    shapes = rows.filter("fixed is null").select("tokens").distinct()
    best = pinned(matched(shapes, mined))
    verdict = F.coalesce("fixed.verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return rows.join(best, "tokens", "left").select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), "confidence"
    )


def allowed(pages: DataFrame, **how) -> DataFrame:
    """page_id of the pages that no rule blocks."""
    return judge(pages, **how).filter("verdict = 'allow'").select("page_id")
