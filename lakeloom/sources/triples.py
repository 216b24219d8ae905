"""Triple tables: reading, sampling and normalising into one fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.values import full_date, order_hash

# Column names and file names of the triple tables.
TRIPLE_COLUMNS = ["id", "subject", "predicate", "cat_object", "num_object"]
TYPES_FILE = "facts_parquet/yago_updated_2022_part1/yagoTypes.tsv.parquet"
FACTS_FILE = "facts_parquet/yago_updated_2022_part2/yagoFacts.tsv.parquet"
LITERALS_FILE = "facts_parquet/yago_updated_2022_part2/yagoLiteralFacts.tsv.parquet"
DATES_FILE = "facts_parquet/yago_updated_2022_part2/yagoDateFacts.tsv.parquet"
WORDNET_PREFIX = "<wordnet_"
SAMPLE_ROWS = 10_000

FACT_COLUMNS = ["subject", "predicate", "cat_object"]


def read_triples(
    spark: SparkSession, path: str, drop_last: bool = True, limit: int | None = None
) -> DataFrame:
    """A triple parquet with its five columns renamed by position.

    ``drop_last`` leaves out the last row of the last file, ``limit`` keeps the
    first rows of each file. Both go by the row position that the parquet reader
    knows, so that neither depends on how the scan is split.
    """
    raw = spark.read.parquet(path)
    if len(raw.columns) != len(TRIPLE_COLUMNS):
        raise ValueError(f"expected {len(TRIPLE_COLUMNS)} columns in {path}, found {len(raw.columns)}")
    if not drop_last and limit is None:
        return raw.toDF(*TRIPLE_COLUMNS)

    place = raw.select(
        *raw.columns,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    ).toDF(*TRIPLE_COLUMNS, "__file", "__row")
    if drop_last:
        last = place.agg(F.max(F.struct("__file", "__row")).alias("last")).select("last.__file", "last.__row")
        place = place.join(last, ["__file", "__row"], "left_anti")
    if limit is not None:
        place = place.filter(F.col("__row") < limit)
    return place.select(*TRIPLE_COLUMNS)


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """Exactly ``n`` rows (or all), the same ones on every run: a top-n by row hash."""
    others = [F.col(c) for c in df.columns if c != key]
    return df.orderBy(order_hash(seed, F.col(key), *others), *df.columns).limit(n)


def normalise_dates(dates: DataFrame) -> DataFrame:
    """Keep facts whose date has year, month and day, as ISO text."""
    return (
        dates.withColumn("cat_object", full_date("cat_object"))
        .filter(F.col("cat_object").isNotNull())
        .drop("num_object")
    )


def normalise_literals(literals: DataFrame) -> DataFrame:
    """The number as text where there is one, else the text."""
    return literals.withColumn(
        "cat_object", F.coalesce(F.col("num_object").cast("string"), F.col("cat_object"))
    ).drop("num_object")


def normalise_entities(facts: DataFrame) -> DataFrame:
    """Entity facts have no number."""
    return facts.drop("num_object")


def stack_raw(facts: DataFrame, literals: DataFrame, dates: DataFrame) -> DataFrame:
    """The three families on top of each other, untouched, numbers kept."""
    return facts.unionByName(literals).unionByName(dates)


def stack_facts(facts: DataFrame, literals: DataFrame, dates: DataFrame, keep_id: bool = True) -> DataFrame:
    """All facts in one table, every object as text."""
    stacked = (
        normalise_entities(facts)
        .unionByName(normalise_literals(literals))
        .unionByName(normalise_dates(dates))
    )
    return stacked if keep_id else stacked.drop("id")


def wordnet_subjects(types: DataFrame, prefix: str = WORDNET_PREFIX) -> DataFrame:
    """``(subject, type)`` of the types with the prefix."""
    return types.filter(F.col("cat_object").startswith(prefix)).select(
        "subject", F.col("cat_object").alias("type")
    )


def read_knowledge_base(
    spark: SparkSession,
    root: str,
    sample: bool = False,
    seed: int = 42,
    drop_last: bool = True,
    keep_id: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(facts, types)`` from the four triple files below ``root``.

    ``sample`` takes a fixed number of rows from each family of facts; types stay whole.
    """
    types = read_triples(spark, f"{root}/{TYPES_FILE}", drop_last)
    families = [
        read_triples(spark, f"{root}/{name}", drop_last) for name in (FACTS_FILE, LITERALS_FILE, DATES_FILE)
    ]
    if sample:
        families = [sample_rows(f, SAMPLE_ROWS, seed) for f in families]
    return stack_facts(*families, keep_id=keep_id), types


def labels_not_in(labels: DataFrame, suffix: str = "eng") -> DataFrame:
    """Labels whose text does not end with the language suffix."""
    return labels.filter(~F.col("cat_object").endswith(suffix))
