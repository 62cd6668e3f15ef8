"""Table metadata and the rules that go with it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

INGESTION_TYPES = ("snapshot", "cdc", "cdc_with_deletes", "append")


@dataclass(frozen=True)
class TableMeta:
    """What a source declares about one table."""

    primary_keys: list[str] = field(default_factory=list)
    cursor_field: str | None = None
    ingestion_type: str = "snapshot"


def _path_in(schema: T.StructType, path: str) -> bool:
    kind: T.DataType = schema
    for step in path.split("."):
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return False
        kind = kind[step].dataType
    return True


def check_metadata(meta: TableMeta, schema: T.StructType) -> list[str]:
    """Problems of the declaration, [] when it is sound; dotted paths are allowed."""
    out = []
    if meta.ingestion_type not in INGESTION_TYPES:
        out.append(f"unknown ingestion type {meta.ingestion_type}")
    if meta.ingestion_type != "append" and not meta.primary_keys:
        out.append("primary keys are required")
    if meta.ingestion_type in ("cdc", "cdc_with_deletes") and not meta.cursor_field:
        out.append("a cursor is required")
    out += [f"key {k} is not in the schema" for k in meta.primary_keys if not _path_in(schema, k)]
    if meta.cursor_field and not _path_in(schema, meta.cursor_field):
        out.append(f"cursor {meta.cursor_field} is not in the schema")
    return out


# Names of modification times that make a table incremental.
MODIFIED_NAMES = ["modified_time", "Modified_Time", "updated_at", "lastModifiedDateTime", "lastModified", "updatedAt"]


def infer_type(schema: T.StructType, override: str | None = None, cursor: str | None = None, name: str | None = None, append_tables: tuple[str, ...] = (), dimensions: tuple[str, ...] = ()) -> str:
    """Ingestion type: the override, named append tables, a cursor, a modification time or a
    ``date`` dimension make cdc; else snapshot."""
    if override:
        if override not in INGESTION_TYPES:
            raise ValueError(f"unknown ingestion type {override}")
        return override
    if name and name in append_tables:
        return "append"
    if cursor or "date" in dimensions or any(m in schema.names for m in MODIFIED_NAMES):
        return "cdc"
    return "snapshot"


def table_metadata(spark: SparkSession, tables: list[str], describe) -> DataFrame:
    """(tableName, primary_keys, cursor_field, ingestion_type) in the caller's order.

    ``describe(name) -> TableMeta`` holds the per-table options.
    """
    rows = [(i, n, list((m := describe(n)).primary_keys), m.cursor_field, m.ingestion_type) for i, n in enumerate(tables)]
    schema = "pos int, tableName string, primary_keys array<string>, cursor_field string, ingestion_type string"
    return spark.createDataFrame(rows, schema).orderBy("pos").drop("pos")
