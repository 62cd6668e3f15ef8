"""Field descriptors of the sources as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.functions.names import sanitize

# Type words of the descriptor dialects.
GENERIC = {
    "string": T.StringType(), "integer": T.LongType(), "long": T.LongType(), "double": T.DoubleType(), "float": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(), "binary": T.BinaryType(),
}
EDM = {
    "Edm.String": T.StringType(), "Edm.Guid": T.StringType(), "Edm.Boolean": T.BooleanType(), "Edm.Byte": T.IntegerType(),
    "Edm.SByte": T.IntegerType(), "Edm.Int16": T.IntegerType(), "Edm.Int32": T.IntegerType(), "Edm.Int64": T.LongType(),
    "Edm.Single": T.FloatType(), "Edm.Double": T.DoubleType(), "Edm.Date": T.DateType(), "Edm.DateTime": T.TimestampType(),
    "Edm.DateTimeOffset": T.TimestampType(), "Edm.TimeOfDay": T.StringType(), "Edm.Duration": T.StringType(), "Edm.Binary": T.BinaryType(),
}
CRM = {
    "bigint": T.LongType(), "text": T.StringType(), "textarea": T.StringType(), "email": T.StringType(), "phone": T.StringType(),
    "website": T.StringType(), "picklist": T.StringType(), "integer": T.LongType(), "double": T.DoubleType(), "currency": T.DoubleType(),
    "percent": T.DoubleType(), "decimal": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "datetime": T.TimestampType(),
}
PROPERTY = {
    "string": T.StringType(), "enumeration": T.StringType(), "phone_number": T.StringType(), "number": T.DoubleType(),
    "bool": T.BooleanType(), "date": T.DateType(), "datetime": T.TimestampType(),
}
DIALECTS = {"generic": GENERIC, "edm": EDM, "crm": CRM, "property": PROPERTY}
MAX_PRECISION = 38


def edm_decimal(precision: int | None, scale: int | str | None) -> T.DecimalType:
    """Decimal facets: no precision is 38, no scale 0; ``variable`` scale keeps half the digits."""
    p = min(int(precision or MAX_PRECISION), MAX_PRECISION)
    s = p // 2 if scale in ("variable", "floating") else int(scale or 0)
    return T.DecimalType(p, min(s, p))


def field_type(d: dict, dialect: str) -> T.DataType:
    """Type of one descriptor: name of a simple type, or struct / array / map with parts."""
    word = d.get("type", "string")
    if dialect == "edm":
        if word == "Edm.Decimal":
            return edm_decimal(d.get("precision"), d.get("scale"))
        return EDM.get(word, T.StringType())  # complex, collections and enums arrive as JSON text
    if word == "struct":
        return schema_from_descriptors(d["fields"], dialect)
    if word == "array":
        return T.ArrayType(field_type(d.get("items", {}), dialect))
    if word == "map":
        return T.MapType(T.StringType(), field_type(d.get("values", {}), dialect))
    if word == "decimal" and "precision" in d:
        return edm_decimal(d["precision"], d.get("scale"))
    if word == "geopoint":
        return T.StructType().add("latitude", T.DoubleType()).add("longitude", T.DoubleType())
    return DIALECTS[dialect].get(word, T.StringType())


def schema_from_descriptors(fields: list[dict], dialect: str = "generic") -> T.StructType:
    """StructType of descriptor rows {name, type, nullable?, ...}."""
    return T.StructType([T.StructField(f["name"], field_type(f, dialect), bool(f.get("nullable", True))) for f in fields])


def schema_from_header(cells: list) -> T.StructType:
    """Row number plus one text column per header cell."""
    out = T.StructType().add("row_index", T.StringType())
    for i, c in enumerate(cells):
        out = out.add(sanitize(str(c) if c is not None else "", i), T.StringType())
    return out
