"""FHIR R4 resources as typed rows.

A resource's JSON is parsed once with ``from_json`` under the schema its layout implies, and
the columns are projected from the parsed struct. Missing lists are empty lists; a struct
whose mapped parts are all missing is null.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import to_boolean, to_double, to_long, to_timestamp
from tidemark.functions.names import camel
from tidemark.sources.fhir_layouts import INTERPRETER, NHS_NUMBER, RESOURCES, TYPES, UK_EXTENSION

PROFILE_CHAIN = ["uk_core", "base_r4"]
_SCALARS = {"str": lambda c: c, "bool": to_boolean, "long": to_long, "double": to_double, "ts": to_timestamp}
_WORD = re.compile(r"^(\w+)(?:=([\w.\[\]]+))?(?::(\w+)(\*)?)?$")


def _key(name: str) -> str:
    return camel(name).replace("Datetime", "DateTime")


def parse_layout(text: str) -> list[tuple[str, str, str, bool]]:
    """(column, JSON path, type, is list) of a layout text."""
    out = []
    for word in text.split():
        name, path, kind, many = _WORD.match(word).groups()
        out.append((name, path or _key(name), kind or "str", bool(many)))
    return out


def _tree(fields: list[tuple[str, str, str, bool]]) -> dict:
    """JSON shape as nested dicts: key -> (is list, subtree or None for text)."""
    root: dict = {}
    for _, path, kind, many in fields:
        node = root
        steps = path.split(".")
        for i, step in enumerate(steps):
            key, listed = re.sub(r"\[\d+\]$", "", step), step.endswith("]")
            if i == len(steps) - 1:
                node[key] = (many, None if kind in _SCALARS else _tree(parse_layout(TYPES[kind])))
            else:
                node = node.setdefault(key, (listed, {}))[1]
    return root


def _struct_type(tree: dict) -> T.StructType:
    out = T.StructType()
    for key, (many, sub) in tree.items():
        kind: T.DataType = T.StringType() if sub is None else _struct_type(sub)
        out = out.add(key, T.ArrayType(kind) if many else kind)
    return out


def input_schema(resource: str, profile: str = "uk_core") -> T.StructType:
    """Schema under which the JSON of a resource is parsed."""
    return _struct_type(_tree(parse_layout(_resolve(resource, profile)[0])))


def _at(base: Column, path: str) -> Column:
    for step in path.split("."):
        m = re.match(r"^(\w+)(?:\[(\d+)\])?$", step)
        base = base.getField(m.group(1))
        if m.group(2) is not None:
            base = F.get(base, F.lit(int(m.group(2))))
    return base


def _value(c: Column, kind: str) -> Column:
    if kind in _SCALARS:
        return _SCALARS[kind](c)
    fields = parse_layout(TYPES[kind])
    parts = {p.split(".")[0].split("[")[0] for _, p, _, _ in fields}
    present = F.coalesce(*[F.when(c.getField(p).isNotNull(), F.lit(True)) for p in sorted(parts)])
    return F.when(present, F.struct(*[_column(c, f) for f in fields]))


def _column(base: Column, f: tuple[str, str, str, bool]) -> Column:
    name, path, kind, many = f
    raw = _at(base, path)
    if not many:
        return _value(raw, kind).alias(name)
    if kind == "str":
        return F.coalesce(raw, F.array().cast("array<string>")).alias(name)
    # a missing list is read as an empty one before it is mapped, which keeps its type
    present = F.coalesce(raw, F.from_json(F.lit("[]"), T.ArrayType(_struct_type(_tree(parse_layout(TYPES[kind]))))))
    items = F.transform(present, lambda x: _value(x, kind))
    return (F.array_compact(items) if kind == "Coding" else items).alias(name)


# --- profiles ---------------------------------------------------------------------------

_PROFILES: dict[tuple[str, str], tuple[str, Callable[[Column, Column], list[Column]] | None]] = {
    (name, "base_r4"): (text, None) for name, text in RESOURCES.items()
}


def register_profile(resource: str, profile: str, layout: str, extra: Callable[[Column, Column], list[Column]] | None = None) -> None:
    """Add a profile; ``extra(parsed, body)`` gives columns the layout text cannot express."""
    _PROFILES[(resource, profile)] = (layout, extra)


def _resolve(resource: str, profile: str):
    """The profile's own layout, else the next one of the chain; an unknown resource has none."""
    chain = PROFILE_CHAIN[PROFILE_CHAIN.index(profile):] if profile in PROFILE_CHAIN else [profile, *PROFILE_CHAIN]
    for p in chain:
        if (resource, p) in _PROFILES:
            return _PROFILES[(resource, p)]
    return "", None


def _uk_patient(_: Column, body: Column) -> list[Column]:
    concept = _struct_type(_tree(parse_layout(TYPES["Concept"])))
    shape = T.StructType().add("url", "string").add("valueCodeableConcept", concept).add("valueBoolean", "string").add(
        "extension", T.ArrayType(T.StructType().add("url", "string").add("valueCodeableConcept", concept))
    )
    ext = F.from_json(F.get_json_object(body, "$.extension"), T.ArrayType(shape))
    ids = F.from_json(F.get_json_object(body, "$.identifier"), "array<struct<system:string,value:string>>")

    def first(items: Column, test) -> Column:
        return F.get(F.filter(items, test), F.lit(0))

    def coded(name: str) -> Column:
        return _value(first(ext, lambda e: e["url"] == UK_EXTENSION + name).getField("valueCodeableConcept"), "Concept")

    death = first(ext, lambda e: e["url"] == UK_EXTENSION + "DeathNotificationStatus").getField("extension")
    status = first(death, lambda e: e["url"] == "deathNotificationStatus").getField("valueCodeableConcept")
    return [
        first(ids, lambda i: i["system"] == NHS_NUMBER).getField("value").alias("nhs_number"),
        coded("EthnicCategory").alias("ethnic_category"),
        coded("BirthSex").alias("birth_sex"),
        _value(status, "Concept").alias("death_notification_status"),
        to_boolean(first(ext, lambda e: e["url"] == INTERPRETER).getField("valueBoolean")).alias("interpreter_required"),
        coded("ResidentialStatus").alias("residential_status"),
    ]


register_profile("Patient", "uk_core", RESOURCES["Patient"], _uk_patient)


# --- rows -------------------------------------------------------------------------------


def bundle_to_resources(df: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """(keep..., resource): the resources of Bundle documents; any other document fails."""
    text = F.col(body)
    kind = F.get_json_object(text, "$.resourceType")
    entries = F.from_json(F.get_json_object(text, "$.entry"), "array<struct<resource:string>>")
    fail = F.raise_error(F.concat(F.lit("expected a Bundle, got "), F.coalesce(kind, F.lit("null")))).cast("array<struct<resource:string>>")
    rows = df.select(*keep, F.explode(F.when(kind.eqNullSafe("Bundle"), entries).otherwise(fail)).alias("__e"))
    return rows.select(*keep, F.col("__e.resource").alias("resource")).filter(F.col("resource").isNotNull())


def resource_table(df: DataFrame, body: str, resource: str, profile: str = "uk_core", keep: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """Typed rows of one resource type; an unknown type gets the common columns only.

    Common columns: id, resourceType, lastUpdated, raw_json, extension (JSON text).
    ``columns`` compiles only those layout columns.
    """
    layout, extra = _resolve(resource, profile)
    fields = parse_layout(layout)
    if columns is not None:
        fields = [f for f in fields if f[0] in columns]
    text = F.col(body)
    kind = F.get_json_object(text, "$.resourceType")
    rows = df.filter(F.coalesce(kind, F.lit(resource)) == resource)
    schema = _struct_type(_tree([*fields, ("id", "id", "str", False), ("m", "meta.lastUpdated", "str", False)]))
    parsed = rows.select(*keep, text.alias("__body"), F.from_json(text, schema).alias("__r"))
    r = F.col("__r")
    common = [
        r["id"].alias("id"), F.lit(resource).alias("resourceType"), to_timestamp(r["meta"]["lastUpdated"]).alias("lastUpdated"),
        F.col("__body").alias("raw_json"), F.coalesce(F.get_json_object("__body", "$.extension"), F.lit("null")).alias("extension"),
    ]
    more = extra(r, F.col("__body")) if extra and columns is None else []
    return parsed.select(*keep, *common, *[_column(r, f) for f in fields], *more)
