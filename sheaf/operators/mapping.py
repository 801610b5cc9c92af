"""Reading of mapping texts: crosswalk rows and the source fields a mapping names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Target fields of the crosswalk.
TARGET_FIELDS = (
    "cho_alternative", "cho_contributor", "cho_creator", "cho_date", "cho_dc_rights", "cho_description",
    "cho_edm_type", "cho_extent", "cho_format", "cho_has_part", "cho_has_type", "cho_identifier",
    "cho_is_part_of", "cho_language", "cho_medium", "cho_provenance", "cho_publisher", "cho_relation",
    "cho_same_as", "cho_source", "cho_spatial", "cho_subject", "cho_temporal", "cho_title", "cho_type",
)

# Macros that read a source, as (source, what they do).
EXTRACT_MACROS = {
    "cambridge_dimensions": ("/tei:extent/tei:dimensions", "Extracts height and width into formated string."),
    "extract_aub_description": ("/dc:description", "Ignores url values in the description field."),
    "generate_edm_type": (".Classification or .ObjectName", "Seperate values on ';', then downcase"),
    "json_title_plus": (
        ".title and one other field",
        "The title field was merged with the truncated value from the second field.",
    ),
    "princeton_title_and_lang": (".title", "The script of the title was programatically determined."),
    "scw_has_type": (
        "/*/mods:genre or /*/mods:typeOfResource or /*/mods:subject/mods:topic or "
        "/*/mods:extension/cdwalite:indexingMaterialsTechSet/cdwalite:termMaterialsTech",
        "The output value was mapped to a value in a controlled vocabulary.",
    ),
    "xpath_title_or_desc": (
        "/dc:title or /dc:description[3]",
        "If no title found in /dc:title, map in truncated description.",
    ),
    "xpath_title_plus": (
        "the title field and a second field such as id or description",
        "The title field was merged with the truncated value from the second field.",
    ),
}

# Macros that change a value, and what they do.
MODIFY_MACROS = {
    "prepend": "A literal value was prepended to provide context or to satisfy a consistent pattern requirement.",
    "translation_map": "The output value was mapped to a value in a controlled vocabulary.",
}


def _used(line: Column, macros: Mapping[str, Sequence[str]], part: int) -> Column:
    """Entry ``part`` of every macro named in the line, in table order."""
    hits = [F.when(F.contains(line, F.lit(name)), F.lit(entry[part])) for name, entry in macros.items()]
    return F.array_compact(F.array(*hits))


def crosswalk(
    lines: DataFrame,
    targets: Sequence[str] = TARGET_FIELDS,
    extract: Mapping[str, tuple[str, str]] = EXTRACT_MACROS,
    modify: Mapping[str, str] = MODIFY_MACROS,
) -> DataFrame:
    """``from_field, to_field, transforms`` of lines that fill a known target, with the lines' other columns."""
    line = F.col("line")
    to_field = F.regexp_extract(line, r"""\bto_field\s*\(?\s*['"]([^'"]+)['"]""", 1)
    sources = _used(line, extract, 0)
    literal = F.regexp_extract(line, r"^.*literal\((.*)$", 1)
    literal_text = F.concat(F.lit("Assigned literal value: '"), F.substring_index(literal, "),", 1), F.lit("'"))
    argument = F.trim(F.regexp_extract(line, r"\(([^()]*)", 1), F.lit("'"))
    from_field = F.when(F.size(sources) > 0, F.element_at(sources, -1)).when(
        F.contains(line, F.lit("literal(")), literal_text
    ).otherwise(argument)
    changes = F.concat(_used(line, extract, 1), _used(line, {k: (v,) for k, v in modify.items()}, 0))
    return lines.where(to_field.isin(list(targets))).select(
        *[c for c in lines.columns if c != "line"],
        from_field.alias("from_field"),
        to_field.alias("to_field"),
        F.concat_ws(" ", changes).alias("transforms"),
    )


def mapped_fields(lines: DataFrame) -> DataFrame:
    """``file_name, field`` named by ``extract_json('.x')`` or ``column('x')``; indexes and dots go."""
    json_paths = F.regexp_extract_all("line", F.lit(r"extract_json\('([^']*)'"), F.lit(1))
    names = F.transform(json_paths, lambda p: F.replace(F.substring_index(p, "[", 1), F.lit("."), F.lit("")))
    columns = F.regexp_extract_all("line", F.lit(r"\bcolumn\('([^']*)'"), F.lit(1))
    return lines.select("file_name", F.explode(F.concat(names, columns)).alias("field")).distinct()


def ignored_in_mapping(lines: DataFrame) -> DataFrame:
    """Fields a mapping sets aside with a ``## name`` line."""
    name = F.regexp_extract("line", r"^##\s?(.*?)\s*$", 1)
    return lines.where(F.startswith("line", F.lit("##"))).select("file_name", name.alias("field")).distinct()
