"""Declarative collection specs: what to read, which fields, which rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


def strict_bool(value: Any) -> bool:
    """Only a real ``True`` switches a flag on; the text "false" does not."""
    return value is True


@dataclass(frozen=True)
class FieldSpec:
    path: str
    namespaces: Mapping[str, str] = field(default_factory=dict)
    optional: bool = False
    name_in_table: str | None = None


@dataclass(frozen=True)
class FieldFilter:
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class CollectionSpec:
    collection_id: str
    driver: str
    fields: Mapping[str, FieldSpec] = field(default_factory=dict)
    record_selector: str | None = None
    metadata_prefix: str | None = None
    filters: Mapping[str, FieldFilter] = field(default_factory=dict)
    post_harvest: str | None = None
    record_count_formula: str | None = None
    record_limit: int | None = None
    full_harvest: bool = False
    paths: tuple[str, ...] = ()
    dtypes: Mapping[str, str] = field(default_factory=dict)
    post_harvest_arguments: Mapping[str, Any] = field(default_factory=dict)

    @property
    def id_column(self) -> str:
        """Column that identifies a record: the declared name of field ``id``, else ``id``."""
        declared = self.fields.get("id")
        return (declared.name_in_table if declared else None) or "id"

    @classmethod
    def from_dict(cls, collection_id: str, raw: Mapping[str, Any]) -> "CollectionSpec":
        args, meta = raw.get("args") or {}, raw.get("metadata") or {}
        selector = args.get("record_selector") or meta.get("record_selector")
        if isinstance(selector, Mapping):
            selector = selector.get("path")
        paths = args.get("urlpath") or ()
        fields = {
            name: FieldSpec(
                path=info.get("path", name),
                namespaces=dict(info.get("namespace") or {}),
                optional=strict_bool(info.get("optional")),
                name_in_table=info.get("name_in_dataframe"),
            )
            for name, info in (meta.get("fields") or {}).items()
        }
        filters = {
            name: FieldFilter(tuple(rule.get("include") or ()), tuple(rule.get("exclude") or ()))
            for name, rule in (meta.get("filters") or {}).items()
        }
        return cls(
            collection_id=collection_id,
            driver=raw["driver"],
            fields=fields,
            record_selector=selector,
            paths=(paths,) if isinstance(paths, str) else tuple(paths),
            metadata_prefix=args.get("metadata_prefix"),
            filters=filters,
            post_harvest=meta.get("post_harvest"),
            record_count_formula=meta.get("record_count_formula"),
            record_limit=meta.get("record_limit"),
            full_harvest=strict_bool(args.get("full_harvest")),
            dtypes=dict((args.get("csv_kwargs") or {}).get("dtype") or {}),
            post_harvest_arguments=dict(meta.get("post_harvest_arguments") or {}),
        )
