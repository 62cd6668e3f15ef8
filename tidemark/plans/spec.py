"""The ingestion specification: which tables, where to, with which overrides."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

# Names and keys of a specification.
SCD_TYPES = ("SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY")
RESERVED = ("scd_type", "primary_keys", "sequence_by", "cluster_by")
_TABLE_KEYS = {"source_table", "destination_catalog", "destination_schema", "destination_table", "table_configuration"}


def _text(value, what: str) -> str:
    if not isinstance(value, str):
        raise ValueError(f"{what} must be a string")
    return value


def _only(given: dict, allowed: set[str], what: str) -> None:
    extra = set(given) - allowed
    if extra:
        raise ValueError(f"unknown keys {sorted(extra)} in {what}")


@dataclass(frozen=True)
class TableSpec:
    source_table: str
    destination_catalog: str | None = None
    destination_schema: str | None = None
    destination_table: str | None = None
    table_configuration: dict[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, raw) -> TableSpec:
        if not isinstance(raw, dict) or "source_table" not in raw:
            raise ValueError("a table needs a source_table")
        _only(raw, _TABLE_KEYS, "table")
        config = raw.get("table_configuration")
        if config is not None and not isinstance(config, dict):
            raise ValueError("table_configuration must be a dictionary")
        # values become text, nested ones JSON text: that is what reader options can hold
        texts = {
            str(k): json.dumps(v) if isinstance(v, (dict, list)) else str(v) for k, v in (config or {}).items()
        }
        names = {
            k: None if raw.get(k) is None else _text(raw[k], k) for k in _TABLE_KEYS - {"table_configuration", "source_table"}
        }
        return cls(source_table=_text(raw["source_table"], "source_table"), table_configuration=texts, **names)

    @property
    def options(self) -> dict[str, str]:
        """Options for the source: everything but the reserved keys."""
        return {k: v for k, v in self.table_configuration.items() if k not in RESERVED}

    @property
    def scd_type(self) -> str | None:
        raw = self.table_configuration.get("scd_type")
        if raw is None:
            return None
        if raw.upper() not in SCD_TYPES:
            raise ValueError(f"scd_type {raw!r} of {self.source_table} is none of {SCD_TYPES}")
        return raw.upper()

    @property
    def primary_keys(self) -> list[str] | None:
        raw = self.table_configuration.get("primary_keys")
        if raw is None:
            return None
        return json.loads(raw) if raw.startswith("[") else [raw]

    @property
    def sequence_by(self) -> str | None:
        return self.table_configuration.get("sequence_by")

    @property
    def cluster_by(self) -> list[str] | None:
        """A JSON list, comma-separated names or one name; blank is none."""
        raw = (self.table_configuration.get("cluster_by") or "").strip()
        if not raw:
            return None
        if raw.startswith("["):
            return [str(x) for x in json.loads(raw)]
        return [x.strip() for x in raw.split(",") if x.strip()]

    @property
    def destination(self) -> str:
        """``catalog.schema.table`` in backticks when both are given, else the bare table."""
        table = self.destination_table or self.source_table
        if self.destination_catalog is None or self.destination_schema is None:
            return table
        return f"`{self.destination_catalog}`.`{self.destination_schema}`.`{table}`"


@dataclass(frozen=True)
class PipelineSpec:
    connection_name: str
    tables: list[TableSpec]

    @classmethod
    def parse(cls, raw) -> PipelineSpec:
        if not isinstance(raw, dict):
            raise ValueError("the specification must be a dictionary")
        _only(raw, {"connection_name", "objects"}, "specification")
        name = _text(raw.get("connection_name"), "connection_name")
        if not name.strip():
            raise ValueError("connection_name must not be empty")
        objects = raw.get("objects")
        if not isinstance(objects, list) or not objects:
            raise ValueError("objects must be a non-empty list")
        tables = []
        for o in objects:
            if not isinstance(o, dict) or "table" not in o:
                raise ValueError("an object must be a table")
            _only(o, {"table"}, "object")
            tables.append(TableSpec.parse(o["table"]))
        return cls(name, tables)

    def table(self, name: str) -> TableSpec:
        """The first table of that name."""
        for t in self.tables:
            if t.source_table == name:
                return t
        raise ValueError(f"table {name!r} is not in the specification")
