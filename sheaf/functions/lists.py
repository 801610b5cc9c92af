"""Multi-value helpers: every field value is an array of strings inside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.text import strip

STRINGS = "array<string>"
PAIRS = "array<struct<field:string,values:array<string>>>"
RECORD = "map<string,array<string>>"


def empty_strings() -> Column:
    return F.array().cast(STRINGS)


def strip_all(values: Column) -> Column:
    return F.transform(values, strip)


def scalar_or_list(values: Column) -> Column:
    """Output view: no value is null, one value stays plain, more become a JSON list in order."""
    return F.when(F.size(values) == 1, F.get(values, F.lit(0))).when(F.size(values) > 1, F.to_json(values))


def first_of(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where nested lambdas use it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kept(value: Column, test: Callable[[Column], Column]) -> Column:
    """Generator of ``value`` where ``test`` holds. A filter on a computed column is pushed
    below it and computes it twice; this computes it once."""
    return F.explode(F.filter(F.array(value), test))


def merge_pairs(pairs: Column, keep: str = "append") -> Column:
    """Fold ``(field, values)`` pairs of one record into a map without a shuffle.

    ``append`` joins the values of equal fields in order; ``last`` keeps the last pair.
    """

    def folded(present: Column) -> Column:
        def values_of(name: Column) -> Column:
            same = F.transform(F.filter(present, lambda p: p["field"] == name), lambda p: p["values"])
            return F.flatten(same) if keep == "append" else F.element_at(same, -1)

        names = F.array_distinct(F.transform(present, lambda p: p["field"]))
        entries = F.transform(names, lambda name: F.struct(name.alias("key"), values_of(name).alias("value")))
        return F.map_from_entries(entries)

    return let(F.filter(pairs, lambda p: p["field"].isNotNull() & (F.size(p["values"]) > 0)), folded)


def pairs_to_map(pairs: Column) -> Column:
    """Pairs whose field names differ, as a map; empty values are left out."""
    present = F.filter(pairs, lambda p: F.size(p["values"]) > 0)
    return F.map_from_entries(F.transform(present, lambda p: F.struct(p["field"].alias("key"), p["values"].alias("value"))))


def override(base: Column, winner: Column) -> Column:
    """Fields of ``winner`` replace fields of the same name in ``base``."""

    def merged(both: Column) -> Column:
        kept = F.map_filter(both["base"], lambda name, _: ~F.map_contains_key(both["winner"], name))
        return F.map_concat(kept, both["winner"])

    return let(F.struct(base.alias("base"), winner.alias("winner")), merged)
