"""Raw values to typed columns, as native expressions.

Text rules work on string columns (CSV, extracted fields); JSON rules work on a VARIANT,
so they see whether a value was text, a number, a boolean, an object or a list.

Choices: text that is no known boolean word but not empty is true; an epoch number is in
seconds; binary text is base64 if it is valid base64, else hex, else its UTF-8 bytes (stray
characters are not skipped). Timestamps without offset are UTC.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERRORS = "_errors"
ERROR_TYPE = "array<struct<path:string,value:string,type:string>>"

# The boolean words and the date formats, in the order they are tried.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]
DATE_FORMATS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
]
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)?)?$"
FLOAT_TEXT = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"
# Report metric types that are whole numbers and floating numbers.
INTEGER_METRICS = ["TYPE_INTEGER", "TYPE_MILLISECONDS"]
FLOAT_METRICS = [
    "TYPE_FLOAT", "TYPE_CURRENCY", "TYPE_SECONDS", "TYPE_MINUTES", "TYPE_HOURS",
    "TYPE_FEET", "TYPE_MILES", "TYPE_METERS", "TYPE_KILOMETERS", "TYPE_STANDARD",
]


# --- text rules -------------------------------------------------------------------------


def to_long(text: Column, kind: str = "bigint") -> Column:
    """Whole-number text; with a point it is truncated; anything else is null."""
    cut = F.when(text.rlike(FLOAT_TEXT), text.try_cast("double")).try_cast(kind)
    plain = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast(kind))
    return F.when(F.contains(text, F.lit(".")), cut).otherwise(plain)


def to_double(text: Column, kind: str = "double") -> Column:
    return F.when(text.rlike(FLOAT_TEXT), F.trim(text).try_cast(kind))


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    return F.when(text.rlike(FLOAT_TEXT), F.trim(text).try_cast(f"decimal({precision},{scale})"))


def to_boolean(text: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(low.isin(TRUE_WORDS), True)
        .when(low.isin(FALSE_WORDS), False)
        .when(text.isNotNull(), text != "")
    )


def to_date(text: Column) -> Column:
    """The first format that fits; of an ISO date-time the date as written."""
    tries = [F.when(text.rlike(rx), F.try_to_timestamp(text, F.lit(fmt))) for rx, fmt in DATE_FORMATS]
    iso = F.when(
        text.rlike(ISO_TIMESTAMP) & to_timestamp(text).isNotNull(),
        F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")),
    )
    return F.coalesce(*tries, iso).cast("date")


def to_timestamp(text: Column) -> Column:
    iso = F.when(text.rlike(ISO_TIMESTAMP), F.try_to_timestamp(F.replace(text, F.lit(","), F.lit("."))))
    slashes = F.when(
        text.rlike(r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
        F.try_to_timestamp(text, F.lit("yyyy/M/d H:m:s")),
    )
    dashes = F.when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"),
        F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s")),
    )
    return F.coalesce(iso, dashes, slashes)


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * F.lit(1_000_000.0)).cast("bigint"))


def to_binary(text: Column) -> Column:
    dense = F.regexp_replace(text, r"\s", "")  # encoders may break lines
    valid64 = (F.length(dense) % 4 == 0) & dense.rlike(r"^[A-Za-z0-9+/]*+={0,2}$")
    valid16 = (F.length(dense) % 2 == 0) & dense.rlike(r"^[0-9A-Fa-f]*+$")
    return (
        F.when(valid64, F.try_to_binary(dense, F.lit("base64")))
        .when(valid16, F.try_to_binary(dense, F.lit("hex")))
        .otherwise(F.encode(text, "UTF-8"))
    )


def text_to(text: Column, kind: T.DataType) -> Column:
    """Typed value of a string column; null when the text does not fit."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return to_long(text, kind.simpleString())
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return to_double(text, kind.simpleString())
    if isinstance(kind, T.DecimalType):
        return to_decimal(text, kind.precision, kind.scale)
    if isinstance(kind, T.BooleanType):
        return to_boolean(text)
    if isinstance(kind, T.DateType):
        return to_date(text)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return to_timestamp(text).cast(kind)
    if isinstance(kind, T.BinaryType):
        return to_binary(text)
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(text)
    raise TypeError(f"unsupported type {kind.simpleString()}")


# --- lenient scalars --------------------------------------------------------------------


def try_float(text: Column) -> Column:
    return to_double(F.nullif(text, F.lit("")))


def try_long(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))


def as_bool(text: Column, default: bool = False) -> Column:
    """Known words only; everything else, null included, is ``default``."""
    low = F.lower(F.trim(text))
    return F.when(low.isin(TRUE_WORDS), True).when(low.isin(FALSE_WORDS), False).otherwise(F.lit(default))


def metric_value(text: Column, metric_type: str) -> Column:
    """A report value by its declared type; text that does not fit is null."""
    if metric_type in INTEGER_METRICS:
        return try_long(text)
    if metric_type in FLOAT_METRICS:
        return to_double(text)
    return text


# --- JSON rules -------------------------------------------------------------------------


def _no_errors() -> Column:
    return F.array().cast(ERROR_TYPE)


def _one_error(path: str, v: Column, kind: T.DataType) -> Column:
    return F.array(
        F.struct(
            F.lit(path).alias("path"), F.to_json(v).alias("value"), F.lit(kind.simpleString()).alias("type")
        )
    ).cast(ERROR_TYPE)


def _is_null(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


class _Fields:
    """The parts of one parsed record that sit at fixed paths, extracted once as columns.

    Two projections below the typed one: the variants, then their kind and text. The typed
    expressions refer to those columns instead of repeating the extraction.
    """

    def __init__(self, root: str):
        self.root, self.paths = root, []

    def at(self, path: str) -> int:
        self.paths.append(path)
        return len(self.paths) - 1

    def attach(self, df: DataFrame) -> DataFrame:
        v = F.col(self.root)
        subs = [F.try_variant_get(v, p, "variant").alias(f"__f{i}") for i, p in enumerate(self.paths)]
        out = df.select("*", *subs)
        for prefix, make in (("__k", _kind), ("__t", lambda c: F.try_variant_get(c, "$", "string"))):
            out = out.select("*", *[make(F.col(f"__f{i}")).alias(f"{prefix}{i}") for i in range(len(subs))])
        return out


class _Value:
    """A variant with its kind and text: columns for fixed paths, expressions in lambdas."""

    def __init__(self, v: Column | None = None, index: int | None = None):
        self.v = F.col(f"__f{index}") if v is None else v
        self.shape = F.col(f"__k{index}") if v is None else _kind(v)
        self.text = F.col(f"__t{index}") if v is None else F.try_variant_get(v, "$", "string")


def _scalar(x: _Value, kind: T.DataType) -> Column:
    """Typed value of a non-null variant, null when it does not fit."""
    v, shape, text = x.v, x.shape, x.text
    is_text, is_bool = shape == "STRING", shape == "BOOLEAN"
    nested = shape.startswith("OBJECT") | shape.startswith("ARRAY")
    if isinstance(kind, T.StringType):
        return F.when(nested, F.to_json(v)).otherwise(text)
    if isinstance(kind, T.VariantType):
        return F.when(is_text, F.try_parse_json(text)).otherwise(v)
    number = F.try_variant_get(v, "$", "double")
    if isinstance(kind, (T.IntegerType, T.LongType)):
        name = kind.simpleString()
        exact = F.when(shape == "BIGINT", F.try_variant_get(v, "$", "bigint")).try_cast(name)
        other = F.when(is_bool, F.try_variant_get(v, "$", "boolean").cast(name)).when(
            ~nested & (shape != "BIGINT"), number.try_cast(name)
        )
        return F.when(is_text, to_long(text, name)).otherwise(F.coalesce(exact, other))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        flag = F.try_variant_get(v, "$", "boolean").cast("double")
        value = F.when(is_text, to_double(text)).when(is_bool, flag).when(~nested, number)
        return value.cast(kind)
    if isinstance(kind, T.DecimalType):
        return F.when(~nested & ~is_bool, to_decimal(text, kind.precision, kind.scale))
    if isinstance(kind, T.BooleanType):
        empty = F.to_json(v).isin("{}", "[]")
        return (
            F.when(is_text, to_boolean(text))
            .when(is_bool, F.try_variant_get(v, "$", "boolean"))
            .when(nested, ~empty)
            .otherwise(number != 0)
        )
    if isinstance(kind, T.DateType):
        return F.when(is_text, to_date(text))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.when(is_text, to_timestamp(text)).when(
            ~nested & ~is_bool, epoch_to_timestamp(number)
        )
        return value.cast(kind)
    if isinstance(kind, T.BinaryType):
        octets = F.try_variant_get(v, "$", "array<int>")
        from_list = F.unhex(F.array_join(F.transform(octets, lambda b: F.lpad(F.hex(b), 2, "0")), ""))
        return (
            F.when(is_text, to_binary(text))
            .when(shape.startswith("ARRAY"), from_list)
            .otherwise(F.encode(F.coalesce(text, F.to_json(v)), "UTF-8"))
        )
    raise TypeError(f"unsupported type {kind.simpleString()}")


def _loose(kind: T.DataType) -> T.DataType:
    """The type with every nested part nullable: what the expressions produce."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _loose(kind.valueType), True)
    return kind


def _pair(v: Column, kind: T.DataType, path: str) -> Column:
    value, errs = _build(_Value(v), kind, path)
    return F.struct(value.alias("value"), errs.alias("errs"))


def _build(x: _Value, kind: T.DataType, path: str, json_path: str = "", fields: _Fields | None = None) -> tuple[Column, Column]:
    """(value, errors) expressions of one variant under its declared type."""
    v = x.v
    out = _loose(kind)
    none = F.lit(None).cast(out)
    if isinstance(kind, T.StructType):
        good = x.shape.startswith("OBJECT") & (x.shape != "OBJECT<>")
        members, errors = [], []
        for f in kind.fields:
            step = f'["{f.name}"]'
            if fields:
                sub = _Value(index=fields.at(json_path + step))
            else:
                sub = _Value(F.try_variant_get(v, "$" + step, "variant"))
            where = f"{path}.{f.name}" if path else f.name
            value, errs = _build(sub, f.dataType, where, json_path + step, fields)
            members.append(value.alias(f.name))
            if not f.nullable:
                errs = F.when(sub.v.isNull(), _one_error(where, v, f.dataType)).otherwise(errs)
            errors.append(errs)
        value = F.when(_is_null(v), none).when(good, F.struct(*members).cast(out)).otherwise(none)
        errs = F.when(_is_null(v), _no_errors()).when(good, F.concat(*errors)).otherwise(_one_error(path, v, kind))
        return value, errs
    if isinstance(kind, T.ArrayType):
        listed = x.shape.startswith("ARRAY")
        items = F.when(listed, F.try_variant_get(v, "$", "array<variant>"))
        if kind.containsNull:
            items = items.otherwise(F.array(v))
        pairs = F.transform(items, lambda e: _pair(e, kind.elementType, f"{path}[]"))
        value = F.transform(pairs, lambda p: p["value"])
        inner = F.flatten(F.transform(pairs, lambda p: p["errs"]))
        bad = ~listed if not kind.containsNull else F.lit(False)
    elif isinstance(kind, T.MapType):
        entries = F.when(x.shape.startswith("OBJECT"), F.try_variant_get(v, "$", "map<string,variant>"))
        keyed = F.transform_keys(entries, lambda k, _: text_to(k, kind.keyType))
        pairs = F.transform_values(keyed, lambda _, e: _pair(e, kind.valueType, f"{path}{{}}"))
        value = F.transform_values(pairs, lambda _, p: p["value"])
        inner = F.flatten(F.transform(F.map_values(pairs), lambda p: p["errs"]))
        bad = entries.isNull()
    else:
        value = F.when(~_is_null(v), _scalar(x, kind))
        return value, F.when(~_is_null(v) & value.isNull(), _one_error(path, v, kind)).otherwise(_no_errors())
    return (
        F.when(_is_null(v) | bad, none).otherwise(value.cast(out)),
        F.when(_is_null(v), _no_errors()).when(bad, _one_error(path, v, kind)).otherwise(inner),
    )


def coerce(df: DataFrame, body: str, schema: T.StructType, mode: str = "strict", keep: list[str] = ()) -> DataFrame:
    """Typed columns of the JSON text (or VARIANT) column ``body``.

    ``quarantine`` adds ``_errors`` (path, value, type of each misfit) and nulls the misfits;
    ``strict`` fails the query on the first row with an error. ``keep`` names extra columns.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"mode must be strict or quarantine, got {mode!r}")
    is_text = isinstance(df.schema[body].dataType, T.StringType)
    v = F.col("__v")
    parsed = df.select(
        *keep, F.col(body).alias("__raw"), (F.try_parse_json(F.col(body)) if is_text else F.col(body)).alias("__v")
    )
    bad_text = F.col("__raw").isNotNull() & v.isNull()
    fields = _Fields("__v")
    cols, errors = [], []
    for f in schema.fields:
        step = f'$["{f.name}"]'
        sub = _Value(index=fields.at(step))
        value, errs = _build(sub, f.dataType, f.name, step, fields)
        cols.append(value.alias(f.name))
        if not f.nullable:
            errs = F.when(sub.v.isNull(), _one_error(f.name, v, f.dataType)).otherwise(errs)
        errors.append(errs)
    parsed = fields.attach(parsed)
    raw_text = F.col("__raw") if is_text else F.to_json("__raw")
    whole = F.array(
        F.struct(F.lit("").alias("path"), raw_text.alias("value"), F.lit(schema.simpleString()).alias("type"))
    ).cast(ERROR_TYPE)
    # a JSON object starts with a brace: cheaper than the kind of the whole record
    is_object = F.ltrim("__raw").startswith("{") if is_text else _kind(v).startswith("OBJECT")
    found = F.when(bad_text | ~is_object, whole).otherwise(F.concat(*errors))
    out = parsed.select(*keep, *cols, found.alias(ERRORS))
    if mode == "quarantine":
        return out
    return _fail_on_error(out)


def _fail_on_error(df: DataFrame) -> DataFrame:
    """Drop ``_errors``; a row with an entry fails the query.

    The check guards the row as one struct. As a filter it would be pushed below the
    projections and every expression evaluated twice.
    """
    data = [c for c in df.columns if c != ERRORS]
    first = F.get(ERRORS, F.lit(0))
    text = F.concat(
        F.lit("cannot convert "), F.coalesce(first["value"], F.lit("null")), F.lit(" at "), first["path"], F.lit(" to "), first["type"]
    )
    row = F.struct(*[F.col(f"`{c}`") for c in data])
    kind = T.StructType([df.schema[c] for c in data])
    guarded = F.when(F.size(ERRORS) > 0, F.raise_error(text).cast(_loose(kind))).otherwise(row)
    return df.select(guarded.alias("__row")).select(*[F.col("__row").getField(c).alias(c) for c in data])


def coerce_text(df: DataFrame, types: dict[str, T.DataType], mode: str = "strict") -> DataFrame:
    """Typed versions of string columns, with the same two modes as ``coerce``."""
    cols, errors = [], []
    for name in df.columns:
        if name not in types:
            cols.append(F.col(name))
            continue
        value = text_to(F.col(name), types[name])
        cols.append(value.alias(name))
        entry = F.struct(
            F.lit(name).alias("path"), F.col(name).alias("value"), F.lit(types[name].simpleString()).alias("type")
        )
        errors.append(F.when(F.col(name).isNotNull() & value.isNull(), entry))
    out = df.select(*cols, F.array_compact(F.array(*errors)).cast(ERROR_TYPE).alias(ERRORS))
    if mode == "quarantine":
        return out
    return _fail_on_error(out)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
