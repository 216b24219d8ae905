"""Name clean-up and entity keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the names in the knowledge base.
TYPE_NAME = r"(<)([a-zA-Z_]+)[_0-9]*>"
PLAIN_NAME = r"<{1}([a-zA-Z0-9_]+)>{1}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_type_name(c: Column | str) -> Column:
    """``<name_123>`` to ``name``; two types with one word and two numbers collide."""
    return F.regexp_replace(F.regexp_replace(_col(c), TYPE_NAME, "$2"), "_+$", "")


def clean_name(c: Column | str) -> Column:
    """``<abc_1>`` to ``abc_1``; a name with any other character stays as it is."""
    return F.regexp_replace(_col(c), PLAIN_NAME, "$1")


def strip_brackets(c: Column | str) -> Column:
    """Drop ``<`` at both ends, then ``>`` at the right end only."""
    return F.regexp_replace(F.regexp_replace(_col(c), "^<+|<+$", ""), ">+$", "")


def drop_brackets(c: Column | str) -> Column:
    """Remove every ``<`` and ``>``."""
    return F.translate(_col(c), "<>", "")


def title_case(c: Column | str) -> Column:
    """Capital letter after every non-letter, small letters elsewhere."""
    runs = F.regexp_extract_all(_col(c), F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def replace_first_space(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^([^ ]*) ", "$1_")


def first_piece(c: Column | str, separator: str) -> Column:
    """The text before the first ``separator``, the whole text if there is none."""
    return F.substring_index(_col(c), separator, 1)


def contains_any_case(c: Column | str, needle: str) -> Column:
    return F.lower(_col(c)).contains(needle.lower())


def place_key(city: Column | str, state: Column | str) -> Column:
    """``<City,_State>``"""
    return F.concat(F.lit("<"), _col(city), F.lit(",_"), _col(state), F.lit(">"))


def organisation_key(name: Column | str) -> Column:
    """``<lower_case name>``; only the first space becomes an underscore."""
    return F.concat(F.lit("<"), replace_first_space(F.lower(_col(name))), F.lit(">"))


def county_key(county: Column | str, state: Column | str, parish_state: str = "Louisiana") -> Column:
    """``<County_County,_State>``; the state that has parishes gets ``Parish``."""
    key = F.replace(
        F.concat(F.lit("<"), _col(county), F.lit("_County,_"), _col(state), F.lit(">")),
        F.lit(" "),
        F.lit("_"),
    )
    return F.when(_col(state) == parish_state, F.replace(key, F.lit("County"), F.lit("Parish"))).otherwise(key)


def lake_table_name(table: Column | str, columns: Column) -> Column:
    """File name of a combination table: seed name without its first two parts, then the columns."""
    parts = F.split(_col(table), "_")
    tail = F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0)))
    return F.concat(F.array_join(tail, "_"), F.lit("_"), F.array_join(columns, "_"))
