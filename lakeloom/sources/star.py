"""The triple tables as views over a star schema of customers, orders and parts.

The star tables stand in for a knowledge base: keys become entity names, columns
become predicates. Every view is a bag union of narrow projections, so a filter on
``predicate`` prunes whole branches and each scan reads two columns.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TYPE_PREDICATE = "rdf:type"


@cache
def _schema(spark: SparkSession, folder: str, name: str) -> StructType:
    return spark.read.parquet(f"{folder}/{name}.parquet").schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One star table; its footer is asked for the schema once, not by every view that reads it."""
    return spark.read.schema(_schema(spark, folder, name)).parquet(f"{folder}/{name}.parquet")


def entity(kind: str, c: str) -> Column:
    return F.concat(F.lit(f"<{kind}_"), F.col(c).cast("string"), F.lit(">"))


def named(c: str) -> Column:
    return F.concat(F.lit("<"), F.replace(F.col(c), F.lit(" "), F.lit("_")), F.lit(">"))


def _triples(df: DataFrame, subject: Column, predicate: str, text=None, number=None) -> DataFrame:
    return df.select(
        subject.alias("subject"),
        F.lit(predicate).alias("predicate"),
        (F.lit(None).cast("string") if text is None else text).alias("cat_object"),
        (F.lit(None).cast("double") if number is None else number.cast("double")).alias("num_object"),
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def entity_facts(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders, lineitem, supplier, nation, part = (
        table(spark, folder, n) for n in ("customer", "orders", "lineitem", "supplier", "nation", "part")
    )
    a_customer, an_order, a_part = (
        entity("customer", "c_custkey"),
        entity("order", "o_orderkey"),
        entity("part", "p_partkey"),
    )
    return _stack(
        [
            _triples(customer, a_customer, "<livesIn>", entity("nation", "c_nationkey")),
            _triples(customer, a_customer, "<hasMarketSegment>", named("c_mktsegment")),
            _triples(orders, entity("customer", "o_custkey"), "<placedOrder>", an_order),
            _triples(orders, an_order, "<hasStatus>", named("o_orderstatus")),
            _triples(orders, an_order, "<hasPriority>", named("o_orderpriority")),
            _triples(lineitem, entity("order", "l_orderkey"), "<containsPart>", entity("part", "l_partkey")),
            _triples(supplier, entity("supplier", "s_suppkey"), "<isLocatedIn>", entity("nation", "s_nationkey")),
            _triples(nation, entity("nation", "n_nationkey"), "<isLocatedIn>", entity("region", "n_regionkey")),
            _triples(part, a_part, "<hasBrand>", named("p_brand")),
            _triples(part, a_part, "<hasPartType>", named("p_type")),
        ]
    )


def literal_facts(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders, supplier, part = (
        table(spark, folder, n) for n in ("customer", "orders", "supplier", "part")
    )
    a_customer, a_part = entity("customer", "c_custkey"), entity("part", "p_partkey")
    return _stack(
        [
            _triples(customer, a_customer, "<hasAccountBalance>", number=F.col("c_acctbal")),
            _triples(supplier, entity("supplier", "s_suppkey"), "<hasAccountBalance>", number=F.col("s_acctbal")),
            _triples(orders, entity("order", "o_orderkey"), "<hasTotalPrice>", number=F.col("o_totalprice")),
            _triples(part, a_part, "<hasSize>", number=F.col("p_size")),
            _triples(part, a_part, "<hasRetailPrice>", number=F.col("p_retailprice")),
            _triples(customer, a_customer, "<hasName>", F.col("c_name")),
        ]
    )


def date_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates; every tenth order has no day, like dates in a knowledge base that are known in part."""
    orders = table(spark, folder, "orders")
    text = F.when(
        F.col("o_orderkey") % 10 == 0, F.date_format("o_orderdate", "yyyy-MM-'##'")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _triples(
        orders, entity("order", "o_orderkey"), "<wasCreatedOnDate>", F.concat(text, F.lit("^^xsd:date"))
    )


def types(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders, supplier, part, nation = (
        table(spark, folder, n) for n in ("customer", "orders", "supplier", "part", "nation")
    )
    a_customer, an_order = entity("customer", "c_custkey"), entity("order", "o_orderkey")
    segment = F.concat(F.lit("<wikicat_"), F.col("c_mktsegment"), F.lit(">"))

    def typed(df: DataFrame, subject: Column, name: Column | str) -> DataFrame:
        return _triples(df, subject, TYPE_PREDICATE, F.lit(name) if isinstance(name, str) else name)

    return _stack(
        [
            typed(customer, a_customer, "<wordnet_customer_100000001>"),
            typed(customer.filter("c_acctbal >= 5000"), a_customer, "<wordnet_premium_customer_100000002>"),
            typed(customer, a_customer, segment),
            typed(orders, an_order, "<wordnet_order_100000003>"),
            typed(orders.filter("o_orderstatus = 'F'"), an_order, "<wordnet_order_100000013>"),
            typed(supplier, entity("supplier", "s_suppkey"), "<wordnet_supplier_100000004>"),
            typed(part, entity("part", "p_partkey"), "<wordnet_part_100000005>"),
            typed(nation, entity("nation", "n_nationkey"), "<wordnet_country_100000006>"),
        ]
    )
