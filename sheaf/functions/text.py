"""String helpers over Columns. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a full-Unicode "strip" removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        "
    "        　"
)

# HTML names of the code points 160 to 255, in code point order.
LATIN1_ENTITIES = (
    "nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr "
    "deg plusmn sup2 sup3 acute micro para middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest "
    "Agrave Aacute Acirc Atilde Auml Aring AElig Ccedil Egrave Eacute Ecirc Euml Igrave Iacute Icirc Iuml "
    "ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash Ugrave Uacute Ucirc Uuml Yacute THORN szlig "
    "agrave aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml igrave iacute icirc iuml "
    "eth ntilde ograve oacute ocirc otilde ouml divide oslash ugrave uacute ucirc uuml yacute thorn yuml"
).split()

# Further named entities met in catalogue text.
OTHER_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "bull": "•",
    "hellip": "…", "euro": "€", "trade": "™",
}

# Elements whose whole content is dropped when markup becomes text.
DROPPED_ELEMENTS = ("script", "applet", "frameset", "button", "select", "textarea")

# Schemes a valid link may have, and the shape of host and path.
URL_SCHEMES = ("http", "https", "ftp", "ftps", "sftp", "ssh", "git", "irc", "rtmp", "rtmps", "rtsp", "telnet")
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(\.{_OCTET}){{3}}"
_HEX = "[0-9A-Fa-f]{1,4}"
_V6 = "|".join(
    [rf"({_HEX}:){{7}}{_HEX}", rf"({_HEX}:){{6}}{_V4}", "::"]
    # one run of zeros left out: n groups before it, at most 7 - n after it
    + [rf"({_HEX}:){{{n}}}(:{_HEX}){{1,{7 - n}}}" for n in range(1, 7)]
    + [rf"({_HEX}:){{1,7}}:", rf":(:{_HEX}){{1,7}}", rf"::({_HEX}:){{0,5}}{_V4}"]
    + [rf"({_HEX}:){{{n}}}:({_HEX}:){{0,{5 - n}}}{_V4}" for n in range(1, 6)]
)
_PORT = "(6553[0-5]|655[0-2][0-9]|65[0-4][0-9]{2}|6[0-4][0-9]{3}|[1-5][0-9]{4}|[1-9][0-9]{0,3}|0)"
URL_PATTERN = (
    r"^(" + "|".join(URL_SCHEMES) + r")://([^\s/?#@]+@)?"
    r"(([\p{L}\p{N}_]([\p{L}\p{N}_-]{0,61}[\p{L}\p{N}_])?\.)+\p{L}[\p{L}\p{N}-]{0,61}[\p{L}\p{N}]"
    rf"|{_V4}|\[({_V6})\])(:{_PORT})?([/?#][^\s<>\"{{}}|\\^`]*)?$"
)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def sanitize(c: Column) -> Column:
    """Strip, turn line feeds into blanks, drop carriage returns, in this order."""
    return F.replace(F.replace(strip(c), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))


def normalise_label(c: Column, drop_slash: bool = True) -> Column:
    """Label to column name: blanks to dashes, lower case, brackets (and slashes) dropped."""
    dashed = F.lower(F.replace(c, F.lit(" "), F.lit("-")))
    return F.translate(dashed, "()/" if drop_slash else "()", "")


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(URL_PATTERN), F.lit(False))


def code_point_text(code: Column) -> Column:
    """The character of a code point; ``char`` alone stops at 255."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def decode_entities(c: Column) -> Column:
    """Decode named and numeric character references, the ampersand last."""
    table = {name: chr(160 + i) for i, name in enumerate(LATIN1_ENTITIES)} | OTHER_ENTITIES
    names, characters = F.lit(",".join(table)), F.lit("".join(table.values()))

    def decoded(ref: Column) -> Column:
        place = F.find_in_set(F.regexp_extract(ref, "^&([A-Za-z0-9]+);$", 1), names)
        named = F.when(place > 0, F.substring(characters, place, F.lit(1)))
        decimal = F.regexp_extract(ref, r"^&#([0-9]+);$", 1).try_cast("int")
        hexadecimal = F.conv(F.regexp_extract(ref, r"^&#[xX]([0-9a-fA-F]+);$", 1), 16, 10).try_cast("int")
        code = F.coalesce(decimal, hexadecimal)
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.coalesce(named, F.when(valid, code_point_text(code)), ref)

    references = r"&(?!amp;|#38;|#x26;)(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(references), F.lit(0)))
    text = F.aggregate(found, c, lambda acc, ref: F.replace(acc, ref, decoded(ref)))
    return F.when(F.contains(c, F.lit("&")), F.regexp_replace(text, "&(?:amp|#38|#x26);", "&")).otherwise(c)


def markup_to_text(c: Column) -> Column:
    """Embedded HTML to its text: comments, dropped elements and tags go, references are decoded."""
    text = F.regexp_replace(c, r"(?s)<!--.*?-->|<\?.*?>|<![A-Za-z][^>]*>", "")
    text = F.regexp_replace(text, rf"(?is)<({'|'.join(DROPPED_ELEMENTS)})\b[^>]*>.*?</\1\s*>", "")
    text = F.regexp_replace(text, r"</?[A-Za-z][^>]*>", "")
    plain = F.get(F.transform(F.array(text), decode_entities), F.lit(0))
    return F.when(c.rlike("[<&]"), plain).otherwise(c)


def truthy(c: Column, data_type) -> Column:
    """Python truth of a cell by its column type; null is false."""
    kind = data_type.typeName()
    if kind in ("string", "varchar", "char"):
        test = c != ""
    elif kind in ("array", "map"):
        test = F.size(c) > 0
    elif kind == "boolean":
        test = c
    elif kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        test = c != 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))
