"""XPath of a field spec, rewritten for Spark's ``xpath``, which knows no namespaces."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.lists import empty_strings
from sheaf.functions.text import decode_entities

_TOKEN = re.compile(r"""'[^']*'|"[^"]*"|::|//|[@./\[\](),|=!<>+*\s-]|\d[\w.]*|[A-Za-z_][\w.-]*(?::[A-Za-z_][\w.-]*)?""")
_FUNCTIONS = ("text", "node", "comment", "processing-instruction")
_OPERATORS = ("and", "or", "div", "mod")


def local_path(path: str, namespaces: Mapping[str, str] | None = None) -> str:
    """Name tests match by local name, so that prefixes and default namespaces do not matter."""
    tokens = []
    at = 0
    while at < len(path):
        found = _TOKEN.match(path, at)
        if not found:
            raise ValueError(f"unsupported XPath: {path}")
        tokens.append(found.group())
        at = found.end()
    out = []
    for i, token in enumerate(tokens):
        following = next((t for t in tokens[i + 1 :] if t.strip()), "")
        before = next((t for t in reversed(tokens[:i]) if t.strip()), "")
        is_name = re.match(r"[A-Za-z_]", token) is not None
        if not is_name or following in ("(", "::") or (token in _OPERATORS and before not in ("", "/", "//", "@", "::", "[", "(")):
            out.append(token)
        else:
            prefix, _, local = token.rpartition(":")
            if prefix and namespaces and prefix not in namespaces and prefix != "xml":
                raise ValueError(f"undeclared prefix {prefix} in {path}")
            out.append(token if before == "@" and not prefix else f"*[local-name()='{local}']")
    compiled = "".join(out)
    # a prefixed attribute keeps its qualified name in a parser without namespaces
    return re.sub(r"@\*\[local-name\(\)='([^']+)'\]", r"@*[local-name()='\1' or name()='\1']", compiled)


def anchored(path: str) -> str:
    """A relative path starts at the record element, which is the root of the record's text."""
    if path.startswith(("/", "(")):
        return path
    if path.startswith(".//"):
        return f"/*//{path[3:]}"
    if path.startswith("./"):
        return f"/*/{path[2:]}"
    return "/*" if path == "." else f"/*/{path}"


def branches(path: str) -> list[str]:
    """The parts of a union, which are joined by bars outside of quotes, brackets and parentheses."""
    parts, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(path):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        else:
            depth += (c in "[(") - (c in "])")
            if c == "|" and not depth:
                parts.append(path[start:i].strip())
                start = i + 1
    return [*parts, path[start:].strip()]


def value_path(path: str, namespaces: Mapping[str, str] | None = None) -> str:
    """Path to the text of the selected elements, that is their first node if it is text;
    attributes and text nodes stay as they are. Each branch of a union is compiled by itself."""
    parts = branches(path)
    if len(parts) > 1:
        return " | ".join(value_path(p, namespaces) for p in parts)
    compiled = local_path(anchored(path.rstrip("/")), namespaces)
    last = re.split(r"/(?![^\[]*\])", compiled)[-1]
    if last.startswith("@") or last.startswith("text("):
        return compiled
    return f"{compiled}/node()[1][self::text()]"


def well_formed(body: Column) -> Column:
    """False for null, empty, non-XML and broken bodies; never throws."""
    parsed = F.from_xml(body, "_corrupt_record string, _none string")
    return F.coalesce(body.isNotNull() & parsed["_corrupt_record"].isNull(), F.lit(False))


def needed_name(path: str) -> str | None:
    """Name in the last step, which any document with a match must contain; a union has none."""
    if len(branches(path)) > 1:
        return None
    last = re.sub(r"\[[^\]]*\]", "", path).rstrip("/").rsplit("/", 1)[-1].rsplit(":", 1)[-1].lstrip("@")
    return last if re.fullmatch(r"[A-Za-z_][\w.-]*", last) else None


def _text(raw: Column) -> Column:
    """Source text of an element as its value: line ends and character references resolved."""
    lines = F.replace(F.replace(raw, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return decode_entities(lines)


def _scan(body: Column, local: str, tree: Column) -> Column:
    """Values of the descendant step ``//local`` by a scan of the source text, ``tree`` where that
    could err: in documents with comments, CDATA sections or a document type, and where the
    root itself has the name."""
    attributes = r"""(?:\s+[\w:.-]+\s*=\s*(?:"[^"]*"|'[^']*'))*"""
    start = rf"<(?:[\w.-]+:)?{re.escape(local)}{attributes}\s*>([^<]+)"
    plain = ~F.contains(body, F.lit("<!")) & ~body.rlike(rf"^[^<]*(?:<\?[^<]*)?<(?:[\w.-]+:)?{re.escape(local)}[\s/>]")
    return F.when(plain, F.transform(F.regexp_extract_all(body, F.lit(start), F.lit(1)), _text)).otherwise(tree)


def find_values(body: Column, path: str, namespaces: Mapping[str, str] | None = None) -> Column:
    """Text of all matches in document order. The body must be well formed.

    ``xpath`` builds a tree per call, which costs far more than anything else here. So a
    document without the wanted name is not parsed, and the common path of one descendant
    step is read off the source text.
    """
    found = F.xpath(body, F.lit(value_path(path, namespaces)))
    name = needed_name(path)
    if name and re.fullmatch(r"\.?//(?:[A-Za-z_][\w.-]*:)?[A-Za-z_][\w.-]*", path):
        found = _scan(body, name, found)
    if name:
        found = F.when(F.contains(body, F.lit(name)), found)
    return F.coalesce(found, empty_strings())


def element_pattern(selector: str) -> str:
    """Pattern of whole elements for a record selector such as ``.//oai:record``, where they do not nest."""
    local = selector.rstrip("/").rsplit("/", 1)[-1].rsplit(":", 1)[-1]
    if not re.fullmatch(r"[A-Za-z_][\w.-]*", local):
        raise ValueError(f"unsupported record selector: {selector}")
    return rf"(?s)<((?:[\w.-]+:)?{local})(?=[\s>/])(?:[^>]*/>|.*?</\1\s*>)"


def plain_markup(body: Column) -> Column:
    """The document without comments and with CDATA sections as escaped text, so that a tag in the text is a tag."""
    pieces = F.regexp_extract_all(body, F.lit(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|[^<]+|<"), F.lit(0))

    def plain(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(10), F.length(piece) - 12)
        for character, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            inner = F.replace(inner, F.lit(character), F.lit(name))
        return F.when(F.startswith(piece, F.lit("<!--")), "").when(F.startswith(piece, F.lit("<![CDATA[")), inner).otherwise(piece)

    marked = F.contains(body, F.lit("<!--")) | F.contains(body, F.lit("<![CDATA["))
    return F.when(marked, F.array_join(F.transform(pieces, plain), "")).otherwise(body)


def _nested(body: Column, local: str) -> Column:
    """Elements with others of their name inside, in document order: tags are matched by depth."""
    tag = rf"(?s)(.*?)(<(?:[\w.-]+:)?{local}(?=[\s>/])[^>]*>|</(?:[\w.-]+:)?{local}\s*>)"
    sizes = F.transform(F.regexp_extract_all(body, F.lit(tag), F.lit(1)), F.length)
    tags = F.regexp_extract_all(body, F.lit(tag), F.lit(2))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("open"), F.array().cast("array<struct<start:int,size:int>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        here = acc["at"] + x["before"]
        after = here + F.length(x["tag"])
        close, alone = F.startswith(x["tag"], F.lit("</")), F.endswith(x["tag"], F.lit("/>"))
        last = F.try_element_at(acc["open"], F.lit(-1))
        from_ = F.when(close, last).when(alone, here)
        done = F.struct(from_.alias("start"), (after - from_).alias("size"))
        opened = F.when(close, F.slice(acc["open"], F.lit(1), F.greatest(F.size(acc["open"]) - 1, F.lit(0))))
        return F.struct(
            after.alias("at"),
            opened.when(alone, acc["open"]).otherwise(F.concat(acc["open"], F.array(here))).alias("open"),
            F.when(from_.isNotNull(), F.concat(acc["found"], F.array(done))).otherwise(acc["found"]).alias("found"),
        )

    pairs = F.transform(F.arrays_zip(sizes.alias("before"), tags.alias("tag")), lambda x: F.struct(x["before"].alias("before"), x["tag"].alias("tag")))
    found = F.aggregate(pairs, start, step, lambda acc: F.array_sort(acc["found"]))
    return F.transform(found, lambda f: F.substring(body, f["start"], f["size"]))


def split_elements(body: Column, selector: str) -> Column:
    """Source text of every element the selector names, in document order; one inside another counts as well."""
    pattern = element_pattern(selector)
    local = selector.rstrip("/").rsplit("/", 1)[-1].rsplit(":", 1)[-1]
    open_tag = rf"<(?:[\w.-]+:)?{local}(?=[\s>/])(?![^>]*/>)"
    inside = rf"(?s){open_tag}(?:(?!</(?:[\w.-]+:)?{local}\s*>).)*{open_tag}"

    def split(text: Column) -> Column:
        return F.when(text.rlike(inside), _nested(text, local)).otherwise(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    return F.get(F.transform(F.array(plain_markup(body)), split), F.lit(0))
