"""MARC records: index table plus one landed document per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.lists import PAIRS, merge_pairs, override
from sheaf.functions.xmlpath import element_pattern, plain_markup
from sheaf.sources.payloads import ok_pages
from sheaf.sources.tabular import scan_csv

# Blanks are data in fixed-length fields.
OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}

# All text: inference would read tag 008 as a number.
MARC_XML = (
    "leader string, controlfield array<struct<_VALUE:string,_tag:string>>, "
    "datafield array<struct<_ind1:string,_ind2:string,_tag:string,"
    "subfield:array<struct<_VALUE:string,_code:string>>>>"
)


def scan_index(spark: SparkSession, path: str, id_column: str, template: str = "{id}") -> DataFrame:
    """Record ids of a tab separated collection index, and the address the template makes of each."""
    before, _, after = template.partition("{id}")
    record_id = F.col(f"`{id_column}`")
    address = F.concat(F.lit(before), record_id, F.lit(after))
    return scan_csv(spark, path, sep="\t").select(record_id.alias("record_id"), address.alias("url"))


def marc_pairs(record: Column, keep: str = "last") -> Column:
    """Control fields by tag; subfields by tag and code. A repeated data field replaces the
    earlier values of the same key (``last``) or joins them (``append``)."""
    none = F.array().cast(PAIRS)
    control = F.transform(
        record["controlfield"], lambda f: F.struct(f["_tag"].alias("field"), F.array(f["_VALUE"]).alias("values"))
    )

    def of_datafield(f: Column) -> Column:
        subfields = F.transform(
            F.filter(f["subfield"], lambda s: F.coalesce(s["_VALUE"], F.lit("")) != ""),
            lambda s: F.struct(F.concat_ws("_", f["_tag"], s["_code"]).alias("field"), F.array(s["_VALUE"]).alias("values")),
        )
        merged = F.map_entries(merge_pairs(subfields))
        return F.transform(merged, lambda e: F.struct(e["key"].alias("field"), e["value"].alias("values")))

    data = F.flatten(F.transform(F.filter(record["datafield"], lambda f: F.size(f["subfield"]) > 0), of_datafield))
    tags = merge_pairs(F.coalesce(control, none).cast(PAIRS))
    keyed = merge_pairs(F.coalesce(data, none).cast(PAIRS), keep)
    return override(keyed, tags)


def _parsed(payloads: DataFrame, index: DataFrame | None) -> DataFrame:
    docs = ok_pages(payloads)
    if index is not None:
        docs = docs.join(index.select("url"), "url", "left_semi")
    first = F.regexp_extract(plain_markup(F.col("body")), element_pattern("record"), 0)
    zero = F.lit(0).cast("bigint").alias("pos")
    return docs.select("harvest_id", "seq", zero, "url", F.from_xml(first, MARC_XML, OPTIONS).alias("record"))


def marc_records(payloads: DataFrame, index: DataFrame | None = None, keep: str = "last", raw: bool = False) -> DataFrame:
    """First MARC record of each landed document as ``leader`` and ``fields``; ``index`` keeps its addresses only.

    ``raw`` adds ``record``, all fields in their order, for steps that need repeated ones.
    """
    more = ["record"] if raw else []
    fields = marc_pairs(F.col("record"), keep).alias("fields")
    return _parsed(payloads, index).select("harvest_id", "seq", "pos", "url", F.col("record.leader").alias("leader"), fields, *more)


def split_issues(records: DataFrame, tag: str, keep: str = "last") -> DataFrame:
    """One row per data field ``tag`` of ``record``: ``issue_no`` and the ``fields`` of the record with that one alone.

    A record without such a field gives no row.
    """
    data = F.col("record.datafield")
    issue = F.filter(data, lambda f: F.coalesce(f["_tag"] == tag, F.lit(False)))
    others = F.filter(data, lambda f: F.coalesce(f["_tag"] != tag, F.lit(True)))
    rest = [c for c in records.columns if c != "record"]
    rows = records.select(*[F.col(f"`{c}`") for c in rest], F.col("record.controlfield").alias("_c"), others.alias("_o"), F.posexplode(issue).alias("issue_no", "_i"))
    one = F.struct(F.col("_c").alias("controlfield"), F.concat("_o", F.array("_i")).alias("datafield"))
    return rows.select(*[F.col(f"`{c}`") for c in rest], "issue_no", marc_pairs(one, keep).alias("fields"))
