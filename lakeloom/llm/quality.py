"""Quality rules by distribution divergence, in DataFrame expressions only.

Three histograms of a document are compared with those of its language by Jensen-Shannon
distance: its character classes, which of the common words of four languages it uses, and
how much of it is common words at all (two classes). A document is rejected where one of
them is too far. The references are class-wise medians over the documents of a language that
pass the base rules and are long enough to be judged: a group of less than half of them, be
it a source or copies of one text, cannot pull a median out of what the others span. Short
documents are guarded: below a minimum length a distance says nothing.

Words for this are runs of characters other than ASCII non-letters, with A-Z lower-cased,
so that ``The`` and ``the,`` count as ``the``.

Defined cases: a null text has no words and fails the base rules, like every text with
fewer than ten. A null language is one of its own. Repeated rows are judged alike. Without
a document that a reference can be made of, base rules decide alone. Whole texts count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import BLANKS, text_of
from lakeloom.session import pinned

# fixed values: frequent function words of English, German, French and Spanish
COMMON = (
    "the of and to in is that for it with "
    "der die das und ist nicht mit den von zu "
    "le les des et est une que qui pour dans "
    "el los las y es una por con no se"
).split()
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_CHARS_JUDGED = 400  # letters and marks below which character classes are not judged
MIN_WORDS_JUDGED = 100  # words below which the share of common words is not judged
MIN_COMMON_JUDGED = 20  # common words below which it is not judged which ones they are: a passage in another language may be half of them
MAX_CHAR_DISTANCE = 0.3
MAX_SHARE_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.92  # a text that is mostly, but not wholly, in another language is below
PLACE_BITS = 24  # of a number that holds the place of a window and the start of its hash
PARTS = 10_000  # medians are of whole ten-thousandths, so a language has 10,001 values a class at most
TOKEN_END = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# character classes, taken away from the text one after the other; what is left is its own class
CLASSES = [
    ("lower", "[a-z]+"),
    ("upper", "[A-Z]+"),
    ("blank", f"{BLANKS}+"),
    ("digit", "[0-9]+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("mark", r"[\x21-\x7E]+"),
]


def _joined(a: Column, b: Column, ahead: int) -> Column:
    """Each value of ``a`` hashed with the value of ``b`` that is so many places ahead, where there is one."""
    n = F.greatest(F.size(b) - ahead, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(ahead + 1), n), lambda x, y: F.xxhash64(x, y))


PLACE = (1 << PLACE_BITS) - 1


def _packed(windows: str) -> Column:
    """The first 40 bits of each hash with its place, in order: numbers are sorted, and not pairs."""
    return F.sort_array(F.transform(windows, lambda x, i: x.bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long"))))


def _maybe_repeated(packed: str) -> Column:
    """Places of all windows that have an equal one, and perhaps of others; every place where 24 bits do not hold it."""
    n = F.size(packed) - 1
    met = F.zip_with(
        F.slice(packed, F.lit(1), n), F.slice(packed, F.lit(2), n),
        lambda a, b: F.when(F.shiftrightunsigned(a.bitwiseXOR(b), PLACE_BITS) == 0, F.array(a, b)),
    )
    found = F.array_distinct(F.transform(F.flatten(F.array_compact(met)), lambda v: v.bitwiseAND(F.lit(PLACE)).cast("int")))
    return F.when(n < PLACE, found).otherwise(F.sequence(F.lit(0), n))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base figures, and the histograms ``chars``, ``common`` and ``share``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_of(docs).alias("text")
    )
    left = F.col("text")
    steps = []
    for k, (_, pattern) in enumerate(CLASSES):
        rows = rows.withColumn(f"left_{k}", F.regexp_replace(left, pattern, ""))
        steps.append((F.length(left) - F.length(f"left_{k}")).cast("long"))
        left = F.col(f"left_{k}")
    steps.append(F.length(left).cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "lang", F.array(*steps).alias("chars"), lines.alias("lines"),
        F.array_remove(F.split("text", f"{BLANKS}+"), "").alias("words"),
        F.array_remove(F.split("text", TOKEN_END), "").alias("tokens"),
    )
    # no letter beyond ASCII becomes one of these words in lower case
    used = F.transform(F.filter("tokens", lambda w: (F.length(w) <= max(map(len, COMMON))) & F.lower(w).isin(COMMON)), F.lower)
    rows = rows.select(
        "doc_id", "lang", "chars",
        F.size("tokens").alias("n_tokens"),
        used.alias("used"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    at, used = F.col("hashes"), F.size("used")
    # one loop over the words: an expression for each would make a method too large to be compiled
    common = F.transform(F.array(*map(F.lit, COMMON)), lambda w: (used - F.size(F.array_remove("used", w))).cast("long"))
    share = F.array(used, F.col("n_tokens") - used).cast("array<long>")
    rows = rows.withColumn("common", common).withColumn("share", share).drop("used", "n_tokens")
    # windows of 2, 4 and 5 words, each from the one before
    rows = rows.withColumn("two", _joined(at, at, 1))
    rows = rows.withColumn("four", _joined(F.col("two"), F.col("two"), 2)).drop("two")
    rows = rows.withColumn("windows", _joined(F.col("four"), at, WINDOW - 1)).drop("four", "hashes")
    # only texts with a repeated window are looked at, and of these only windows that may be repeated are sorted
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("packed", F.when(repeats, _packed("windows")))
    rows = rows.withColumn("maybe", _maybe_repeated("packed")).drop("packed")
    ordered = F.sort_array(F.transform("maybe", lambda i: F.struct(F.get("windows", i).alias("x"), i.alias("i"))))
    rows = rows.withColumn("ordered", ordered).drop("windows", "maybe")
    s, n = F.col("ordered"), F.size("ordered")
    twice = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["x"] == s[j]["x"]))
        | ((j < n - 1) & (s[F.least(j + 1, n - 1)]["x"] == s[j]["x"])),
    )
    starts = F.when(s.isNotNull(), F.sort_array(F.transform(twice, lambda j: s[j]["i"])))
    rows = rows.withColumn("starts", starts).drop("ordered")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")),
    )["total"]
    rows = rows.select(
        "doc_id", "lang", "n_words",
        (_total("chars") - F.col("chars")[2]).alias("word_chars"),
        F.col("chars")[4].alias("n_symbols"),
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "chars", "common", "share",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _total(counts: str | Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def _judged() -> dict[str, Column]:
    """The three histograms, and where they are long enough to be judged."""
    return {
        "chars": F.col("word_chars") >= MIN_CHARS_JUDGED,
        "common": (F.col("n_words") >= MIN_WORDS_JUDGED) & (_total("common") >= MIN_COMMON_JUDGED),
        "share": F.col("n_words") >= MIN_WORDS_JUDGED,
    }


def _parts(counts: str) -> Column:
    return F.transform(counts, lambda x: F.floor(x * PARTS / F.greatest(_total(counts), F.lit(1))))


def references(rows: DataFrame) -> DataFrame:
    """Per language the medians of each class over the documents that pass the base rules and are judged.

    The counts of a median are merged on the map side; they are 10,001 a class at most.
    """
    judged = _judged()
    good = rows.filter("not base_failed").select("lang", *[F.when(long, _parts(c)).alias(c) for c, long in judged.items()])
    size = {"chars": len(CLASSES) + 1, "common": len(COMMON), "share": 2}
    middle = [F.percentile(F.col(c)[k], 0.5).alias(f"{c}_{k}") for c, n in size.items() for k in range(n)]
    found = good.groupBy("lang").agg(*middle)
    return found.select(
        F.col("lang").alias("of"),
        *[F.when(F.col(f"{c}_0").isNotNull(), F.array(*[f"{c}_{k}" for k in range(n)])).alias(f"ref_{c}") for c, n in size.items()],
    )


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; each is divided by its sum."""

    def share(c):
        total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        return F.transform(c, lambda x: x / F.greatest(total, F.lit(1.0)))

    def term(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    parts = F.zip_with(share(p), share(q), lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2)
    return F.round(F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))), 6)


def judge(docs: DataFrame) -> DataFrame:
    """Per document the base figures, the three distances (null where not judged), base_failed and kept."""
    rows = pinned(measured(docs))  # a few dozen numbers a document
    known = pinned(references(rows))  # one row per language
    rows = rows.join(known, F.col("lang").eqNullSafe(F.col("of")), "left")
    judged = _judged()
    rows = rows.select(
        "*",
        F.when(judged["chars"], distance("chars", "ref_chars")).alias("char_distance"),
        F.when(judged["common"], distance("common", "ref_common")).alias("word_distance"),
        F.when(judged["share"], distance("share", "ref_share")).alias("share_distance"),
    )
    limits = {"char_distance": MAX_CHAR_DISTANCE, "word_distance": MAX_WORD_DISTANCE, "share_distance": MAX_SHARE_DISTANCE}
    far = reduce(Column.__or__, [F.coalesce(F.col(c), F.lit(0.0)) > limit for c, limit in limits.items()])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), *limits,
    )
