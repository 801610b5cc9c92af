"""JSON paths of a field spec, turned into Columns over a parsed VARIANT.

A body is parsed once; every path then reads the binary value. Runs of plain
steps become one ``try_variant_get``; a wildcard opens a list level. The descendant
step ``..`` opens all levels below a node, one per round, until nothing is left to open. VARIANT
sorts the members of an object by name, so where their order in the text counts the
body is parsed once more with numbered names. Nothing leaves the JVM.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.sqltext import NO_VARIANTS, applied, as_list, as_map, let, quoted, texts

DEEPEST = 1000  # levels of a body that the parser takes
NUMBER = 8  # digits before a numbered name

_STEP = re.compile(
    r"""(?P<deep>\.\.)|\[(?P<index>\d+)\]|\[(?P<all>\*)\]|\['(?P<quoted>[^']+)'\]|\["(?P<quoted2>[^"]+)"\]"""
    r"""|\.?(?P<star>\*)|\.?'(?P<bare>[^']+)'|\.?(?P<name>[^.\[\]'"*$]+)"""
)


def parse_path(path: str) -> list[tuple[str, str | int | None]]:
    """Steps ``(kind, argument)``; an unsupported path is an error, never a silent null."""
    rest = path.strip()
    rest = rest[1:] if rest.startswith("$") else rest
    steps: list[tuple[str, str | int | None]] = []
    at = 0
    while at < len(rest):
        found = _STEP.match(rest, at)
        if not found:
            raise ValueError(f"unsupported JSON path: {path}")
        at = found.end()
        group = found.lastgroup
        if group == "deep":
            if steps and steps[-1][0] == "deep":
                raise ValueError(f"unsupported JSON path: {path}")
            steps.append(("deep", None))
        elif group in ("all", "star"):
            steps.append(("all" if group == "all" else "members", None))
        elif group == "index":
            steps.append(("index", int(found.group("index"))))
        else:
            steps.append(("name", found.group(group)))
    if not steps or steps[-1][0] == "deep":
        raise ValueError(f"unsupported JSON path: {path}")
    return steps


def _literal(steps: list[tuple[str, str | int | None]]) -> str:
    def step(what: str, arg: str | int | None) -> str:
        quote = '"' if "'" in str(arg) else "'"
        return f"[{arg}]" if what == "index" else f"[{quote}{arg}{quote}]"

    return "$" + "".join(step(what, arg) for what, arg in steps)


def _open(nodes: str, steps) -> str:
    if not steps:
        return nodes
    return f"array_compact(transform({nodes}, sn -> try_variant_get(sn, {quoted(_literal(steps))}, 'variant')))"


def _elements(nodes: str) -> str:
    """Elements of lists; anything else counts as a list of one."""
    return f"array_compact(flatten(transform({nodes}, en -> coalesce({as_list('en')}, array(en)))))"


# What stands in for an escaped backslash or quote while a body is cut into strings and the text between them. In
# the body itself these two characters are written as escapes first.
_BACKSLASH, _QUOTE = "\ue000", "\ue001"
_CHUNK = r'"[^"]*"\s*:?|[^"]+'


def _replaced(text: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        text = f"replace({text}, {quoted(old)}, {quoted(new)})"
    return text


def _each_name(body: str, changed: str) -> str:
    """JSON text with every member name, quotes and colon included, as the text ``changed`` makes it of the chunk
    ``ch`` and its number ``ci``."""
    escapes = [(c, f"\\u{ord(c):x}") for c in (_BACKSLASH, _QUOTE)]
    safe = _replaced(body, *escapes, ("\\\\", _BACKSLASH), ('\\"', _QUOTE))
    chunks = f"regexp_extract_all({safe}, {quoted(_CHUNK)}, 0)"
    each = f"CASE WHEN startswith(ch, '\"') AND endswith(ch, ':') THEN {changed} ELSE ch END"
    return _replaced(f"array_join(transform({chunks}, (ch, ci) -> {each}), '')", (_QUOTE, '\\"'), (_BACKSLASH, "\\\\"))


def _in_text_order(body: str) -> str:
    """The body as a variant whose member names start with a number, so that they are sorted as in the text."""
    numbered = f"concat('\"', lpad(CAST(ci AS string), {NUMBER}, '0'), substring(ch, 2))"
    return f"try_parse_json({_each_name(body, numbered)})"


def _without_numbers(node: str) -> str:
    """A node of ``_in_text_order`` with its own names."""
    plain = f"concat('\"', substring(ch, {2 + NUMBER}))"
    parsed = f"try_parse_json({_each_name('wt', plain)})"
    return let(f"to_json({node})", "wt", f"CASE WHEN contains(wt, '{{') THEN {parsed} ELSE {node} END")


def _same_name(members: str, name: str, numbered: bool) -> str:
    """Values of a map of members with this name, at most one."""
    key = f"substring(mk, {1 + NUMBER})" if numbered else "mk"
    return f"map_values(map_filter({members}, (mk, mv) -> {key} = {quoted(name)}))"


def _matched(what: str, arg, node: str, items: str, members: str, numbered: bool) -> str:
    """Matches of one step on a node, whose ``items`` or ``members`` are at hand and null if it has none."""
    if what == "name":
        return f"coalesce({_same_name(members, arg, numbered)}, {NO_VARIANTS})"
    if what == "members":
        return f"coalesce(map_values({members}), {NO_VARIANTS})"
    if what == "index":
        return f"coalesce(slice({items}, {arg + 1}, 1), {NO_VARIANTS})"
    return f"coalesce({items}, array({node}))"


def _below(nodes: str, levels: str, what: str, arg, numbered: bool) -> str:
    """Matches of a step on each node and on all nodes under it; a node comes before what lies under it."""

    def entries(found: str, to_open: str) -> str:
        return f"transform({found}, bn -> named_struct('node', bn, 'open', {to_open}))"

    here = entries(_matched(what, arg, "bx.node", "bp.items", "bp.members", numbered), "false")
    under = "coalesce(bp.items, map_values(bp.members))"
    parts = f"CASE WHEN bp.items IS NOT NULL OR bp.members IS NOT NULL THEN concat({here}, {entries(under, 'true')}) ELSE {here} END"
    own = f"named_struct('items', {as_list('bx.node')}, 'members', {as_map('bx.node')})"
    opened = f"CASE WHEN bx.open THEN {let(own, 'bp', parts)} ELSE array(bx) END"
    level = let(f"flatten(transform(st.nodes, bx -> {opened}))", "bf", "named_struct('nodes', bf, 'more', exists(bf, bo -> bo.open))")
    start = f"named_struct('nodes', {entries(nodes, 'true')}, 'more', true)"
    # each round opens one level; after the last one rounds only hand on what they get
    found = f"aggregate(sequence(1, {levels} + 1), {start}, (st, si) -> CASE WHEN st.more THEN {level} ELSE st END, se -> se.nodes)"
    return f"transform({found}, br -> br.node)"


def _walk(doc: str, steps, levels: str, numbered: bool) -> str:
    nodes, deep = f"array({doc})", False
    for what, arg in steps:
        if what == "deep":
            deep = True
        elif deep:
            nodes, deep = _below(nodes, levels, what, arg, numbered), False
        elif what == "all":
            nodes = _elements(nodes)
        elif what == "index" or (what == "name" and not numbered):
            nodes = _open(nodes, [(what, arg)])
        elif what == "name":
            nodes = f"array_compact(transform({nodes}, wn -> get({_same_name(as_map('wn'), arg, True)}, 0)))"
        else:
            nodes = f"flatten(array_compact(transform({nodes}, wm -> map_values({as_map('wm')}))))"
    return nodes


def _worth_reading(body: str, steps) -> str:
    """Whether the text can hold the last named key, as it is or with escapes."""
    names = [arg for what, arg in steps if what == "name"]
    if not names:
        return "true"
    return f"(contains({body}, {quoted(json.dumps(names[-1], ensure_ascii=False))}) OR contains({body}, {quoted(chr(92))}))"


def is_deep(path: str) -> bool:
    """Whether the order of the text counts for this path."""
    return any(what in ("deep", "members") for what, _ in parse_path(path))


def nodes_text(doc: str, path: str, raw: str | None = None, ordered: str | None = None) -> str:
    """``find_nodes`` as SQL text; ``ordered`` is the body read in the order of its text, where that is at hand."""
    steps = parse_path(path)
    if is_deep(path):
        body = raw or f"to_json({doc})"
        levels = f"least(regexp_count({body}, '[\\\\[{{]'), {DEEPEST})"
        if raw is None:
            found = _walk(doc, steps, levels, numbered=False)
        else:
            walked = let(ordered or _in_text_order(raw), "wd", _walk("wd", steps, levels, numbered=True))
            found = f"transform({walked}, un -> {_without_numbers('un')})"
        return f"coalesce(CASE WHEN {doc} IS NOT NULL AND {_worth_reading(body, steps)} THEN {found} END, {NO_VARIANTS})"
    nodes = f"array({doc})"
    run: list[tuple[str, str | int | None]] = []
    for what, arg in steps:
        if what == "all":
            nodes, run = _elements(_open(nodes, run)), []
        else:
            run.append((what, arg))
    return f"array_compact({_open(nodes, run)})"


def texts_text(doc: str, path: str, raw: str | None = None, ordered: str | None = None) -> str:
    """``find_texts`` as SQL text."""
    steps = parse_path(path)
    if all(what in ("name", "index") for what, _ in steps):
        return texts(f"try_variant_get({doc}, {quoted(_literal(steps))}, 'variant')")
    return f"flatten(transform({nodes_text(doc, path, raw, ordered)}, ft -> {texts('ft')}))"


def _for(doc: Column, raw: Column | None, text) -> Column:
    if raw is None:
        return applied(doc, lambda d: text(d, None))
    return applied(F.struct(doc.alias("doc"), raw.alias("raw")), lambda given: text(f"{given}.doc", f"{given}.raw"))


def find_nodes(doc: Column, path: str, raw: Column | None = None) -> Column:
    """Matches of ``path`` in the variant ``doc`` as an array of variants, in order.

    ``raw`` is the JSON text behind ``doc``, of which a descendant or member step takes the order of members; without
    it they come by name. A body that is no JSON has no matches; text after a body's end does not count.
    """
    return _for(doc, raw, lambda d, r: nodes_text(d, path, r))


def find_texts(doc: Column, path: str, raw: Column | None = None) -> Column:
    """Values of all matches as an array of strings; no match is an empty array."""
    return _for(doc, raw, lambda d, r: texts_text(d, path, r))


def find_fields(doc: Column, paths: dict[str, str], raw: Column | None = None) -> Column:
    """A map of the texts of each named path; a name without a match is left out. Paths for which the order of the
    text counts share one reading of it."""

    def pairs(d: str, r: str | None) -> str:
        deep = [n for n, p in paths.items() if r and is_deep(p)]
        pair = lambda n, o: f"named_struct('key', {quoted(n)}, 'value', {texts_text(d, paths[n], r, o)})"
        plain = f"array({', '.join(pair(n, None) for n in paths if n not in deep)})"
        if not deep:
            return plain
        wanted = " OR ".join(_worth_reading(r, parse_path(paths[n])) for n in deep)
        order = f"CASE WHEN {wanted} THEN {_in_text_order(r)} END"
        ordered = let(order, "od", f"array({', '.join(pair(n, 'od') for n in deep)})")
        return ordered if len(deep) == len(paths) else f"concat({plain}, {ordered})"

    if not paths:
        return F.create_map().cast("map<string,array<string>>")
    return _for(doc, raw, lambda d, r: f"map_from_entries(filter({pairs(d, r)}, fp -> size(fp.value) > 0))")
