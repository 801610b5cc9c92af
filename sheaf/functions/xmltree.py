"""Elements of an XML record by one pass over its tags, as SQL text.

``xpath`` builds a tree for each call. Here the tags of a record are folded once into a list of its elements, each with
its path, attributes and first text, and every field of a spec filters that list. Paths that this cannot say go to
``xpath``. The text must be well formed, and free of comments, CDATA sections, processing
instructions and document types (``is_plain``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions import xmlpath
from sheaf.functions.lists import PAIRS, RECORD
from sheaf.functions.sqltext import NO_STRINGS, applied, let, quoted, strip
from sheaf.functions.text import decode_entities

# the tag of a piece of text that starts behind "<", where an attribute may hold ">"
_HEAD = r"""^([^"'>]*(?:(?:"[^"]*"|'[^']*')[^"'>]*)*)>"""
_BETWEEN = "'\\u0001'"  # between paths on their way; no such character is in XML


def is_plain(body: str) -> str:
    return f"NOT (contains({body}, '<!') OR contains({body}, '<?'))"


def _tags(body: str, name: str) -> str:
    """``array<struct<kind, leaf, name, head, text>>`` of all tags: kind 1 for start, 0 for empty element, -1 for end;
    whether an end follows; ``name`` as made of the local name ``tn`` and the tag's source ``th``; the text behind."""
    quotes = f"contains(tt, '\"') OR contains(tt, '\\'')"
    head = f"CASE WHEN {quotes} THEN regexp_extract(tt, {quoted(_HEAD)}, 1) ELSE substring_index(tt, '>', 1) END"
    local = "substring_index(regexp_extract(th, '^[^\\\\s/]+', 0), ':', -1)"
    named = let(local, "tn", f"translate({name}, '/#', '\\u0002\\u0003')") if name != "tn" else local
    text = "CASE WHEN endswith(th, '/') THEN '' ELSE substring(tt, length(th) + 2) END"
    start = f"named_struct('kind', CASE WHEN endswith(th, '/') THEN 0 ELSE 1 END, 'leaf', startswith(get(tp, ti + 1), '/'), 'name', {named}, 'head', th, 'text', {text})"
    end = "named_struct('kind', -1, 'leaf', false, 'name', '', 'head', '', 'text', '')"
    each = f"CASE WHEN startswith(tt, '/') THEN {end} ELSE {let(head, 'th', start)} END"
    return let(f"filter(split({body}, '<'), (tz, tj) -> tj > 0)", "tp", f"transform(tp, (tt, ti) -> {each})")


_PARENT = "left({0}, length({0}) - length(substring_index({0}, '/', -1)) - 1)"


def elements(body: str, name: str = "tn") -> str:
    """``array<struct<path, head, text, leaf>>`` in document order: names from the root down, each with a number of its
    own, as ``/rss#0/item#9``; the source of the start tag; the text before the first child; whether there is none.

    The fold carries two strings, the open path and all paths so far, as what it carries is copied at every tag.
    """
    grown = "concat(es.path, '/', ex.name, '#', CAST(length(es.out) AS string))"
    step = (
        f"CASE WHEN ex.kind = -1 THEN named_struct('path', {_PARENT.format('es.path')}, 'out', es.out) "
        f"ELSE named_struct('path', CASE WHEN ex.kind = 1 THEN {grown} ELSE es.path END, 'out', concat(es.out, {_BETWEEN}, {grown})) END"
    )
    paths = f"aggregate(et, named_struct('path', '', 'out', ''), (es, ex) -> {step}, ee -> split(substring(ee.out, 2), {_BETWEEN}))"
    element = "named_struct('path', get(eq, ei), 'head', eo.head, 'text', eo.text, 'leaf', eo.leaf AND eo.kind = 1)"
    listed = let(paths, "eq", f"transform(filter(et, eo -> eo.kind >= 0), (eo, ei) -> {element})")
    return let(_tags(body, name), "et", listed)


@dataclass(frozen=True)
class Steps:
    """A path that ``elements`` can answer: a pattern of paths, tests of the last element, and an attribute to take."""

    pattern: str
    tests: tuple[tuple[str, str, str | None], ...]
    attribute: str | None


_STEP = re.compile(r"(//|/)(@?)((?:[\w.-]+:)?(?:[\w.-]+|\*))((?:\[[^\]]*\])*)")
_TESTS = {
    "position": re.compile(r"(\d+)"),
    "equal": re.compile(r"@((?:[\w.-]+:)?[\w.-]+)\s*=\s*(?:'([^']*)'|\"([^\"]*)\")"),
    "there": re.compile(r"@((?:[\w.-]+:)?[\w.-]+)"),
    "under": re.compile(r"ancestor::(?:[\w.-]+:)?([\w.-]+)"),
    "not under": re.compile(r"not\(\s*ancestor::(?:[\w.-]+:)?([\w.-]+)\s*\)"),
}


_ANYWHERE = {"^": "", r"^/[^/]+": r"\d"}


def compiled(path: str, namespaces: Mapping[str, str] | None = None) -> Steps | None:
    """The path for ``elements``, or None if it needs ``xpath``. Bad paths and prefixes are errors there as here."""
    xmlpath.value_path(path, namespaces)
    whole = path.strip().rstrip("/")
    if whole.startswith("/"):
        pattern, rest = "^", whole
    else:  # below the root
        pattern, rest = r"^/[^/]+", whole[1:] if whole.startswith("./") else "/" + whole
    at, tests, attribute = 0, [], None
    while at < len(rest):
        step = _STEP.match(rest, at)
        if not step or attribute:
            return None
        at = step.end()
        axis, mark, name, predicates = step.groups()
        local = name.rpartition(":")[2]
        if mark:
            if axis == "//" or predicates or local == "*":
                return None
            attribute = name
            continue
        if tests:  # only the last element may be tested
            return None
        own = "/" + ("[^/]+" if local == "*" else re.escape(local) + r"#\d+")
        if axis == "//" and pattern in _ANYWHERE:  # the start of the path says no more than this
            pattern = _ANYWHERE[pattern] + own
        else:
            pattern += ("(?:/[^/]+)*" if axis == "//" else "") + own
        for predicate in re.findall(r"\[([^\]]*)\]", predicates):
            found = next(((kind, m) for kind, form in _TESTS.items() if (m := form.fullmatch(predicate.strip()))), None)
            if not found:
                return None
            kind, m = found
            tests.append((kind, m[1], next((g for g in m.groups()[1:] if g is not None), None)))
    return Steps(pattern + "$", tuple(tests), attribute)


def _attribute(name: str) -> str:
    """Pattern of an attribute: a prefixed one by its local name, as parsers without namespaces see it."""
    local = name.rpartition(":")[2]
    own = rf"(?:[^\s=:]+:)?{re.escape(local)}" if ":" in name else re.escape(local)
    return rf"\s{own}\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"


def _attribute_value(head: str, name: str) -> str:
    """Source of an attribute's value, with line ends and tabs as blanks; null without the attribute."""
    pattern = quoted(_attribute(name))
    source = f"concat(regexp_extract({head}, {pattern}, 1), regexp_extract({head}, {pattern}, 2))"
    return f"CASE WHEN {head} RLIKE {pattern} THEN translate({source}, '\\n\\r\\t', '   ') END"


def values_of(listed: str, steps: Steps) -> str:
    """Source texts of a path's matches in ``listed`` elements, in document order."""
    found = f"filter({listed}, ve -> ve.path RLIKE {quoted(steps.pattern)})"
    for kind, name, value in steps.tests:
        if kind == "position":
            same = f"{_PARENT.format('vq.path')} = {_PARENT.format('ve.path')}"
            found = let(found, "vp", f"filter(vp, (ve, vi) -> size(filter(vp, (vq, vj) -> vj <= vi AND {same})) = {name})")
        elif kind in ("equal", "there"):
            test = "IS NOT NULL" if kind == "there" else f"= {quoted(value)}"
            found = f"filter({found}, ve -> {_attribute_value('ve.head', name)} {test})"
        else:
            under = f"ve.path RLIKE {quoted(f'/{re.escape(name)}#[0-9]+/')}"
            found = f"filter({found}, ve -> {under if kind == 'under' else f'NOT {under}'})"
    if steps.attribute:
        return f"array_compact(transform({found}, va -> {_attribute_value('va.head', steps.attribute)}))"
    return f"filter(transform({found}, vt -> vt.text), vs -> vs != '')"


def _scanned(body: str, steps: Steps) -> str | None:
    """Values of ``//name``, which a search for its start tags finds without the elements; None for other paths."""
    named = re.fullmatch(r"/((?:[^/[\]\\]|\\.)+)#\\d\+\$", steps.pattern)
    if not named or steps.tests or steps.attribute:
        return None
    tag = rf"""<(?:[^\s:/><=]+:)?{named[1]}(?:\s+[^\s=/><]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s*>([^<]+)"""
    return f"CASE WHEN contains({body}, {quoted(named[1].replace(chr(92), ''))}) THEN regexp_extract_all({body}, {quoted(tag)}, 1) ELSE {NO_STRINGS} END"


def _by_xpath(body: str, path: str, namespaces: Mapping[str, str] | None) -> str:
    name = xmlpath.needed_name(path)
    found = f"xpath({body}, {quoted(xmlpath.value_path(path, namespaces))})"
    return f"coalesce(CASE WHEN contains({body}, {quoted(name)}) THEN {found} END, {NO_STRINGS})" if name else f"coalesce({found}, {NO_STRINGS})"


def _mapped(values: Mapping[str, str]) -> str:
    pairs = ", ".join(f"named_struct('key', {quoted(n)}, 'value', {v})" for n, v in values.items())
    return f"map_from_entries(filter(array({pairs}), xp -> size(xp.value) > 0))" if values else f"CAST(map() AS {RECORD})"


def _resolved(values: Column) -> Column:
    """Source texts as values: line ends and character references resolved."""
    return F.transform(values, lambda v: decode_entities(F.replace(F.replace(v, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))))


def find_fields(body: Column, fields: Mapping[str, tuple[str, Mapping[str, str] | None]]) -> Column:
    """A map of the values of each named ``(path, namespaces)``; a name without a match is left out. The body must be
    well formed; it is read once for all paths that ``compiled`` takes, once more for each other path."""
    if not fields:
        return F.create_map().cast(RECORD)
    steps = {n: compiled(p, ns) for n, (p, ns) in fields.items()}
    scanned = {n: _scanned("xb", s) for n, s in steps.items() if s}
    alone = len(scanned) < 5 and all(scanned.values())  # then the list of elements is not worth its while
    listed = scanned if alone else {n: values_of("xe", s) for n, s in steps.items() if s}
    others = {n: _by_xpath("xb", *fields[n]) for n, s in steps.items() if not s}
    every = {n: _by_xpath("xb", *f) for n, f in fields.items()}
    slow = applied(body, lambda _: _mapped(every), "xb")
    if not listed:
        return slow
    found = _mapped(listed) if alone else let(elements("xb"), "xe", _mapped(listed))
    fast = F.transform_values(applied(body, lambda _: found, "xb"), lambda _, vs: _resolved(vs))
    if others:
        fast = F.map_concat(fast, applied(body, lambda _: _mapped(others), "xb"))
    return F.when(applied(body, lambda _: is_plain("xb"), "xb"), fast).otherwise(slow)


def leaf_pairs(body: Column, root: str, marc: bool = False, all_leaves: bool = False) -> Column:
    """Path keys and values of the leaves under the first element ``root``, as pairs.

    Each child of the root gives one pair, that of its first leaf with text, or with ``all_leaves`` all of them; a
    key that occurs again in a child has its last value. MARC fields and subfields are named by tag and code.
    """

    def attribute(name: str) -> str:
        return f"coalesce({_attribute_value('th', name)}, tn)"

    name = "tn"
    if marc:
        name = f"CASE WHEN tn IN ('controlfield', 'datafield') THEN {attribute('tag')} WHEN tn = 'subfield' THEN {attribute('code')} ELSE tn END"
    top = f"coalesce(get(filter(le, lr -> lr.path RLIKE {quoted(f'/{re.escape(root)}#[0-9]+$')}), 0).path, '-')"
    below = "substring(lx.path, length(lt) + 2)"
    key = f"translate(replace(regexp_replace({below}, '#[0-9]+', ''), '/', '_'), '\\u0002\\u0003', '/#')"
    leaf = f"named_struct('child', substring_index({below}, '/', 1), 'key', {key}, 'value', lx.text)"
    under = "lx.leaf AND lx.text != '' AND startswith(lx.path, concat(lt, '/'))"
    leaves = let(top, "lt", f"transform(filter(le, lx -> {under}), lx -> {leaf})")
    # children lie together, so each is a slice from its first leaf to the next child's
    firsts = "filter(sequence(0, size(ll) - 1), lf -> lf = 0 OR get(ll, lf).child != get(ll, lf - 1).child)"
    last = "element_at(filter(lc, lv -> lv.key = lk), -1).value"
    keys = "array_distinct(transform(lc, lv -> lv.key))"
    pairs = f"transform({keys if all_leaves else f'slice({keys}, 1, 1)'}, lk -> named_struct('field', lk, 'values', array({last})))"
    child = let(f"slice(ll, lf + 1, coalesce(get(ls, li + 1), size(ll)) - lf)", "lc", pairs)
    every = let(firsts, "ls", f"flatten(transform(ls, (lf, li) -> {child}))")
    found = let(leaves, "ll", f"CASE WHEN size(ll) > 0 THEN {every} ELSE CAST(array() AS {PAIRS}) END")
    source = applied(body, lambda _: let(elements("xb", name), "le", found), "xb")
    clean = F.transform(source, lambda p: F.struct(p["field"].alias("field"), _resolved(p["values"]).alias("values")))
    return applied(clean, lambda x: f"transform({x}, lp -> named_struct('field', lp.field, 'values', transform(lp.values, lv -> {strip('lv')})))").cast(PAIRS)
