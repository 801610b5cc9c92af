"""Post-harvest steps by the name a spec uses."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheaf.operators.enrich import add_thumbnails
from sheaf.operators.joins import join_on_id
from sheaf.operators.merge import merge_lists
from sheaf.operators.serials import split_serials
from sheaf.spec import CollectionSpec

Hook = Callable[..., DataFrame]

HOOKS: dict[str, Hook] = {
    "merge_records": merge_lists,
    "split_marc_serials": split_serials,
    "add_thumbnails": add_thumbnails,
    "merge_dataframes": join_on_id,
}


def run_hook(df: DataFrame, spec: CollectionSpec, arguments: Mapping[str, Any] | None = None) -> DataFrame:
    """The table after the spec's step; no step leaves it, an unknown one is an error.

    Arguments come from the spec, the caller's win. A merge that does not name them takes the spec's id, the
    harvest order the table has, and all its other list columns.
    """
    if not spec.post_harvest:
        return df
    if spec.post_harvest not in HOOKS:
        raise ValueError(f"unknown post-harvest step {spec.post_harvest}")
    given = {**spec.post_harvest_arguments, **(arguments or {})}
    if spec.post_harvest == "merge_records":
        given = {"id_column": spec.id_column, "order": [c for c in ("seq", "pos") if c in df.columns], **given}
        listed = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        given.setdefault("list_columns", [c for c in listed if c not in (given.get("locator"), given["id_column"])])
    return HOOKS[spec.post_harvest](df, **given)
