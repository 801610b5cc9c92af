"""Shape tests and text views of VARIANT values.

A cast that does not fit gives null, so one cast answers both "is it a list" and "which
members"; the schema text of a value, which costs a walk over all of it, is never built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions import sqltext

VARIANTS = "array<variant>"


def as_list(v: Column) -> Column:
    """Members of a list, else null."""
    return F.try_variant_get(v, "$", VARIANTS)


def as_map(v: Column) -> Column:
    """Members of an object, else null."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def text_of(v: Column) -> Column:
    """Plain text of a scalar, JSON text of anything nested, null for null."""
    return F.try_variant_get(v, "$", "string")


def listify(v: Column) -> Column:
    """A list stays a list, anything else becomes a list of one; null is empty."""
    return sqltext.applied(v, sqltext.listify)


def flatten_nested(items: Column) -> Column:
    """Open lists inside lists down to the last one.

    Each pass opens one level, and there are no more levels than opening brackets in the text; the passes after
    the last level only see that nothing is left to open.
    """
    return sqltext.applied(items, sqltext.flatten_nested)


def opened(items: Column) -> Column:
    """``flatten_nested`` where there is any list inside, else the items that are not null."""
    return sqltext.applied(items, sqltext.opened)


def texts(v: Column) -> Column:
    """Values of one match: list elements are stripped text, a lone scalar is left as it is."""
    return sqltext.applied(v, sqltext.texts)
