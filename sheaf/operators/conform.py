"""Row rules: required values, allowed values, values required by another value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields every mapped record needs, and those that need an address.
REQUIRED_FIELDS = ("agg_preview", "agg_is_shown_at", "cho_dc_rights", "cho_edm_type", "cho_has_type")
ADDRESS_FIELDS = ("agg_preview", "agg_is_shown_at")


@dataclass(frozen=True)
class Rules:
    required: Sequence[str] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    required_when: Sequence[tuple[str, str, str]] = ()  # (column, other column, its value)


def violations(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """``key, rule`` for every broken rule; rules are plain row tests, so nothing is shuffled."""
    tests: list[Column] = []

    def test(name: str, broken: Column) -> None:
        tests.append(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)))

    for c in rules.required:
        test(f"required:{c}", F.col(c).isNull())
    for c, values in rules.allowed.items():
        test(f"allowed:{c}", F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
    for c, other, value in rules.required_when:
        test(f"required:{c}:when:{other}={value}", (F.col(other) == value) & F.col(c).isNull())
    return df.select(key, F.explode(F.array_compact(F.array(*tests))).alias("rule"))


def _falsy(v: Column) -> Column:
    empty = F.to_json(v).isin("null", '""', "0", "0.0", "[]", "{}", "false")
    return F.coalesce(empty, F.lit(True))


def missing_required(
    lines: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, addresses: Sequence[str] = ADDRESS_FIELDS
) -> DataFrame:
    """``collection_id, field, id`` of mapped records that lack a required field.

    One row per finding: a field that a third of all records lack is never one list.
    """
    doc = lines.select("collection_id", F.try_parse_json("value").alias("doc"))

    def lacks(name: str) -> Column:
        v = F.try_variant_get("doc", f"$['{name}']", "variant")
        bad = _falsy(v)
        if name in addresses:
            address = F.try_variant_get("doc", f"$['{name}']['wr_id']", "variant")
            bad = bad | _falsy(address)
        return F.when(bad, F.lit(name))

    found = F.array_compact(F.array(*[lacks(name) for name in required]))
    record_id = F.try_variant_get("doc", "$.id", "string")
    return doc.select("collection_id", F.explode(found).alias("field"), record_id.alias("id"))


def missing_counts(findings: DataFrame) -> DataFrame:
    """Findings per field with the first and last record id in text order."""
    return findings.groupBy("collection_id", "field").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
