"""Expressions as SQL text.

Every call on a Column is a round trip to the JVM, and a spec of many fields needs thousands of them before its plan
stands. An expression written as text takes one. Functions here take and return such text; ``applied`` makes
a Column of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.text import WHITESPACE


def quoted(text: str) -> str:
    """A string literal."""
    plain = text.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in plain) + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def applied(value: Column, body: Callable[[str], str], name: str = "given") -> Column:
    """The Column that ``body`` describes for ``value``."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body(name)}")), F.lit(0))


def strip(x: str) -> str:
    return f"trim(BOTH {quoted(WHITESPACE)} FROM {x})"


def as_list(v: str) -> str:
    return f"try_variant_get({v}, '$', 'array<variant>')"


def as_map(v: str) -> str:
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


def text_of(v: str) -> str:
    return f"try_variant_get({v}, '$', 'string')"


def present(v: str) -> str:
    return f"({v} IS NOT NULL AND NOT is_variant_null({v}))"


NO_VARIANTS = "CAST(array() AS array<variant>)"
NO_STRINGS = "CAST(array() AS array<string>)"


def listify(v: str) -> str:
    return f"coalesce({as_list(v)}, CASE WHEN {present(v)} THEN array({v}) END, {NO_VARIANTS})"


def flatten_nested(items: str) -> str:
    """See ``variants.flatten_nested``; ``items`` is used several times."""
    nested = lambda x: f"exists({x}, nv -> {as_list('nv')} IS NOT NULL)"
    once = lambda x: f"flatten(transform({x}, ol -> {listify('ol')}))"
    rounds = f"sequence(1, greatest(regexp_count(to_json({items}), '\\\\['), 1))"
    deeper = f"aggregate({rounds}, {once(items)}, (fx, fi) -> CASE WHEN {nested('fx')} THEN {once('fx')} ELSE fx END)"
    return f"CASE WHEN {nested(items)} THEN {deeper} ELSE {once(items)} END"


def opened(items: str) -> str:
    nested = f"exists({items}, oe -> {as_list('oe')} IS NOT NULL)"
    return f"CASE WHEN {nested} THEN {flatten_nested(items)} ELSE filter({items}, op -> {present('op')}) END"


def texts(v: str) -> str:
    """See ``variants.texts``."""
    alone = f"array_compact(array({text_of(v)}))"
    listed = f"transform({opened('ti')}, tx -> {strip(text_of('tx'))})"
    either = f"CASE WHEN ti IS NULL THEN {alone} ELSE {listed} END"
    return f"coalesce(CAST({let(as_list(v), 'ti', either)} AS array<string>), {NO_STRINGS})"
