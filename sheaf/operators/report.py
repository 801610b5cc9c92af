"""Coverage, language, resource and rights figures of mapped records.

One pass over the records makes a small ``collection_id, field, key, n`` table by
partial sums; every figure is read from that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.functions.lists import let
from sheaf.functions.variants import as_list, as_map
from sheaf.session import settle

# Fields that are not reported.
IGNORED_FIELDS = (
    "agg_data_provider",
    "agg_data_provider_collection",
    "agg_data_provider_country",
    "agg_provider",
    "agg_provider_country",
    "cho_type_facet",
    "id",
    "transform_version",
    "transform_timestamp",
)

# Keys of a field that are counted but not listed.
IGNORED_KEYS = ("wr_dc_rights", "wr_edm_rights", "wr_is_referenced_by", "fields_covered")

RECORDS = "*records*"


def ignored_fields(project_prefix: str | None = None) -> list[str]:
    """Unreported fields; a project's own ``<prefix>_collection`` and ``<prefix>_source_file`` too."""
    own = [f"{project_prefix}_collection", f"{project_prefix}_source_file"] if project_prefix else []
    return [*IGNORED_FIELDS, *own]


def field_counts(lines: DataFrame, ignored: list[str] | None = None) -> DataFrame:
    """``collection_id, field, key, n`` of NDJSON lines (``collection_id, value``).

    Every present field counts one ``fields_covered``; an object counts per key its list
    length, or one; anything else counts one ``values``. The number of records is kept
    under a row of its own, so that rates need no second pass.
    """
    skip = ignored_fields() if ignored is None else ignored
    members = F.map_entries(F.from_json("value", "map<string,variant>"))

    def counts_of(member: Column) -> Column:
        def per_key(inner: Column) -> Column:
            sized = F.transform(
                inner,
                lambda e: F.struct(
                    member["key"].alias("field"),
                    e["key"].alias("key"),
                    F.coalesce(F.size(as_list(e["value"])), F.lit(1)).alias("n"),
                ),
            )
            return F.concat(covered, F.when(inner.isNotNull(), sized).otherwise(one))

        one = F.array(F.struct(member["key"].alias("field"), F.lit("values").alias("key"), F.lit(1).alias("n")))
        covered = F.array(F.struct(member["key"].alias("field"), F.lit("fields_covered").alias("key"), F.lit(1).alias("n")))
        return let(F.map_entries(as_map(member["value"])), per_key)

    reported = F.filter(members, lambda m: ~m["key"].isin(skip))
    total = F.array(F.struct(F.lit(RECORDS).alias("field"), F.lit(RECORDS).alias("key"), F.lit(1).alias("n")))
    rows = lines.select("collection_id", F.inline(F.concat(total, F.flatten(F.transform(reported, counts_of)))))
    return rows.groupBy("collection_id", "field", "key").agg(F.sum("n").alias("n"))


def with_records(counts: DataFrame) -> DataFrame:
    """Field rows with the record count of their collection; the window runs on the small table."""
    whole = Window.partitionBy("collection_id")
    records = F.max(F.when(F.col("field") == RECORDS, F.col("n"))).over(whole)
    return counts.withColumn("records", records).where(F.col("field") != RECORDS)


def hundredths(n: Column, d: Column) -> Column:
    """``n / d`` to two digits, ties to even, in whole-number arithmetic."""
    scaled = n.cast("bigint") * 100
    q = F.floor(scaled / d)
    q = F.when(q * d > scaled, q - 1).when((q + 1) * d <= scaled, q + 1).otherwise(q)
    twice = 2 * (scaled - q * d)
    up = (twice > d) | ((twice == d) & (q % 2 == 1))
    return (q + F.when(up, 1).otherwise(0)) / F.lit(100.0)


def whole_percent(n: Column, d: Column) -> Column:
    """``100 n / d`` to a whole number, ties to even."""
    return (hundredths(n, d) * 100).cast("decimal(20,0)").cast("bigint")


def coverage(counts: DataFrame) -> DataFrame:
    """Records that hold a field, and their truncated percentage, sorted by field."""
    rows = with_records(counts).where(F.col("key") == "fields_covered")
    percent = F.floor(F.col("n") / F.col("records") * 100).cast("bigint")
    return rows.select("collection_id", "field", "n", "records", percent.alias("percent")).orderBy("collection_id", "field")


def averages(counts: DataFrame) -> DataFrame:
    """Average number of values per record, of plain values and of addresses."""
    rows = with_records(counts).where(F.col("key").isin("values", "wr_id"))
    return rows.select("collection_id", "field", "key", hundredths(F.col("n"), F.col("records")).alias("average"))


def language_averages(counts: DataFrame) -> DataFrame:
    """Average number of values per record, per language and (``*``) over all languages."""
    rows = with_records(counts).where(~F.col("key").isin(*IGNORED_KEYS, "values", "wr_id"))
    each = rows.select("collection_id", "field", F.col("key").alias("lang"), "n", "records")
    every = rows.groupBy("collection_id", "field").agg(F.sum("n").alias("n"), F.max("records").alias("records"))
    both = each.unionByName(every.withColumn("lang", F.lit("*")))
    return both.select("collection_id", "field", "lang", "n", hundredths(F.col("n"), F.col("records")).alias("average"))


def _count(field: str, key: str) -> Column:
    hit = (F.col("field") == field) & (F.col("key") == key)
    return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))


def resource_report(counts: DataFrame) -> DataFrame:
    """Records with thumbnails, resources and IIIF manifests."""
    return counts.groupBy("collection_id").agg(
        _count(RECORDS, RECORDS).alias("records"),
        _count("agg_preview", "wr_id").alias("thumbnails"),
        _count("agg_is_shown_at", "wr_id").alias("resources"),
        _count("agg_is_shown_at", "wr_is_referenced_by").alias("manifests"),
    )


def rights_report(counts: DataFrame) -> DataFrame:
    """Records with object rights, web resource rights (EDM, else DC) and aggregation rights."""
    edm, dc = _count("agg_is_shown_at", "wr_edm_rights"), _count("agg_is_shown_at", "wr_dc_rights")
    return counts.groupBy("collection_id").agg(
        _count(RECORDS, RECORDS).alias("records"),
        _count("cho_dc_rights", "fields_covered").alias("object_rights"),
        F.when(edm > 0, edm).otherwise(dc).alias("web_resource_rights"),
        _count("agg_edm_rights", "fields_covered").alias("aggregation_rights"),
    )


def report_document(counts: DataFrame, checked: DataFrame, quality: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Every section of the report in one table: figures in ``value``, sentences in ``text``.

    ``checked`` are links with their verdict, ``quality`` the thumbnail figures, ``crosswalk``
    the mapping rows with their ``collection_id``.
    """
    columns = ("collection_id", "section", "field", "key", "measure", "value", "text")
    no_text, no_value = F.lit(None).cast("string"), F.lit(None).cast("double")
    figures = report_sections(counts).withColumn("text", no_text)
    verdicts = checked.groupBy("collection_id", F.col("kind").alias("field")).agg(
        F.sum(F.when(F.col("resolved"), 0).otherwise(1)).cast("double").alias("value")
    )
    verdicts = verdicts.select(
        "collection_id", F.lit("links").alias("section"), "field", F.lit("").alias("key"),
        F.lit("unresolvable").alias("measure"), "value", no_text.alias("text"),
    )
    images = quality.select(
        "collection_id", F.lit("thumbnail quality").alias("section"), F.lit("").alias("field"), F.lit("").alias("key"),
        F.lit("good").alias("measure"), F.col("good").cast("double").alias("value"), F.col("message").alias("text"),
    )
    mapped = crosswalk.select(
        "collection_id", F.lit("crosswalk").alias("section"), F.col("to_field").alias("field"), F.col("from_field").alias("key"),
        F.lit("transforms").alias("measure"), no_value.alias("value"), F.col("transforms").alias("text"),
    )
    out = figures.select(*columns)
    for part in (verdicts, images, mapped):
        out = out.unionByName(part.select(*columns))
    return out


def report_sections(counts: DataFrame) -> DataFrame:
    """The figures of the report as one long table keyed by ``section``.

    The counter table is settled first: each section reads that, not the records again.
    """
    counts = settle(counts)

    def long(section: str, df: DataFrame, measures: list[str], field: Column, key: Column) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        named = df.select("collection_id", F.lit(section).alias("section"), field.alias("field"), key.alias("key"), F.inline(cells))
        return named

    none = F.lit("")
    parts = [
        long("coverage", coverage(counts), ["n", "percent"], F.col("field"), none),
        long("averages", averages(counts), ["average"], F.col("field"), F.col("key")),
        long("languages", language_averages(counts), ["n", "average"], F.col("field"), F.col("lang")),
        long("resources", resource_report(counts), ["records", "thumbnails", "resources", "manifests"], none, none),
        long("rights", rights_report(counts), ["object_rights", "web_resource_rights", "aggregation_rights"], none, none),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
