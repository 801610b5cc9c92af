"""Records inside JSON pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import jsonpath
from sheaf.functions.lists import PAIRS, let, merge_pairs, override
from sheaf.functions.text import normalise_label
from sheaf.functions.variants import as_map, flatten_nested, opened, text_of
from sheaf.sources.payloads import json_fields, ok_pages
from sheaf.spec import CollectionSpec


def record_pairs(doc: Column, path: str = "metadata") -> Column:
    """Label and value pairs of a record's own list of them.

    An empty value is skipped; a list that starts with an object gives that object's ``@value``.
    """
    rows = let(jsonpath.find_nodes(doc, path), opened)

    def values(row: Column) -> Column:
        value = F.try_variant_get(row, "$.value", "variant")
        tagged = F.try_variant_get(row, "$.value[0]['@value']", "variant")
        chosen = F.when(as_map(F.try_variant_get(row, "$.value[0]", "variant")).isNotNull(), tagged).otherwise(value)
        return F.filter(F.transform(flatten_nested(F.array(chosen)), text_of), lambda x: x.isNotNull() & (x != ""))

    def label(row: Column) -> Column:
        return normalise_label(F.try_variant_get(row, "$.label", "string"), drop_slash=False)

    return F.transform(rows, lambda r: F.struct(label(r).alias("field"), values(r).alias("values"))).cast(PAIRS)


def json_records(payloads: DataFrame, spec: CollectionSpec) -> DataFrame:
    """``harvest_id, seq, pos, url, fields`` of all records on pages that answered 200.

    A spec with a field ``metadata`` asks for the label and value pairs at its path too.
    """
    pages = ok_pages(payloads).select("harvest_id", "seq", "url", F.try_parse_json("body").alias("doc"), "body")
    found = let(jsonpath.find_nodes(F.col("doc"), spec.record_selector, F.col("body")), opened)
    records = pages.select("harvest_id", "seq", "url", F.posexplode(found).alias("pos", "record"))
    fields = json_fields(F.col("record"), None, spec)
    if "metadata" in spec.fields:
        fields = override(fields, merge_pairs(record_pairs(F.col("record"), spec.fields["metadata"].path)))
    return records.select("harvest_id", "seq", F.col("pos").cast("bigint").alias("pos"), "url", fields.alias("fields"))
