"""Record shaping: semi-structured input to flat or nested columns, native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names
from tidemark.functions.dates import epoch_ms
from tidemark.operators import ordered

# Fixed value: the shape of an address.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# The same matches without retries: a match cannot start inside a word, and its first part
# cannot be shortened because the next character must be the at sign.
_EMAIL_ONCE = "(?<![A-Za-z0-9])" + EMAIL.replace("*@", "*+@")
REDACTED_EMAIL = "redacted@example.com"
REDACTED = "REDACTED"


# --- picking and flattening -------------------------------------------------------------


def flatten_paths(df: DataFrame, body: str, paths: dict[str, str] | list[str], keep: list[str] = ()) -> DataFrame:
    """Dotted paths of a JSON text as text columns; a list of paths names them ``a_b``."""
    if not isinstance(paths, dict):
        paths = {p.replace(".", "_"): p for p in paths}
    cols = [F.get_json_object(F.col(body), "$." + path).alias(name) for name, path in paths.items()]
    return df.select(*keep, *cols)


def jsonify_complex(df: DataFrame) -> DataFrame:
    """Struct, array, map and variant columns as compact JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(
        *[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema]
    )


def split_custom_props(df: DataFrame, body: str, standard: list[str], out: str = "custom_properties", keep: list[str] = ()) -> DataFrame:
    """Known keys of a JSON object to text columns, the others to one map."""
    props = df.select(*keep, F.from_json(F.col(body), "map<string,string>").alias("__m"))
    known = F.array(*[F.lit(k) for k in standard])
    return props.select(
        *keep,
        *[F.col("__m").getItem(k).alias(k) for k in standard],
        F.map_filter("__m", lambda k, _: ~F.array_contains(known, k)).alias(out),
    )


def pad_to_schema(df: DataFrame, schema: T.StructType, never_pad: list[str] = ()) -> DataFrame:
    """Missing columns as nulls in schema order; a missing key column is an error."""
    gone = [f.name for f in schema if f.name not in df.columns and f.name in set(never_pad)]
    if gone:
        raise ValueError(f"columns {gone} must come from the source")
    return df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    )


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty texts to null in string columns and in the values of string maps."""

    def fix(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return F.nullif(c, F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.MapType) and isinstance(f.dataType.valueType, T.StringType):
            return F.transform_values(c, lambda _, v: F.nullif(v, F.lit(""))).alias(f.name)
        return c

    return df.select(*[fix(f) for f in df.schema])


def empty_struct_to_null(c: Column, kind: T.DataType) -> Column:
    """Structs whose fields are all null become null, at any depth."""
    if isinstance(kind, T.StructType):
        parts = [empty_struct_to_null(c.getField(f.name), f.dataType) for f in kind.fields]
        made = F.struct(*[p.alias(f.name) for p, f in zip(parts, kind.fields)])
        filled = F.coalesce(*[F.when(p.isNotNull(), F.lit(True)) for p in parts])
        return F.when(c.isNotNull() & filled, made)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: empty_struct_to_null(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, x: empty_struct_to_null(x, kind.valueType))
    return c


def json_depth(df: DataFrame, body: str | Column) -> int:
    """How deep brackets nest in the JSON texts of a column: one aggregate over the table."""
    c = F.col(body) if isinstance(body, str) else body
    bare = F.regexp_replace(F.regexp_replace(c, r'"(?:[^"\\\\]|\\\\.)*+"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("top"))

    def step(s: Column, ch: Column) -> Column:
        at = s["at"] + F.when(ch.isin("[", "{"), 1).otherwise(-1)
        return F.struct(at.alias("at"), F.greatest(s["top"], at).alias("top"))

    deep = F.aggregate(F.filter(F.split(bare, ""), lambda x: x != ""), start, step, lambda s: s["top"])
    return df.agg(F.max(deep)).first()[0] or 0


def strip_meta_keys(body: Column, depth: int) -> Column:
    """JSON text without metadata: ``__*`` keys, keys with ``@``, deferred links.

    Nested objects that carry ``__metadata`` are entities and are cleaned too, ``depth``
    levels down; ``json_depth`` gives the levels that a column has. Result: JSON text.
    """

    def clean(v: Column, level: int) -> Column:
        entries = F.try_variant_get(v, "$", "map<string,variant>")
        kept = F.map_filter(
            entries,
            lambda k, x: ~(k.startswith("__") | F.contains(k, F.lit("@")))
            & F.try_variant_get(x, "$.__deferred", "variant").isNull(),
        )
        if level:
            kept = F.transform_values(
                kept,
                lambda _, x: F.when(
                    F.try_variant_get(x, "$.__metadata", "variant").isNotNull(), clean(x, level - 1)
                ).otherwise(x),
            )
        return F.to_variant_object(kept)

    return F.to_json(clean(F.try_parse_json(body), depth))


# --- keys and names ---------------------------------------------------------------------


def _snake_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(names.snake(f.name), _snake_type(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_snake_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _snake_type(kind.valueType), kind.valueContainsNull)
    return kind


def snake_case_keys(df: DataFrame) -> DataFrame:
    """Column and nested field names in snake_case; keys of string maps too."""

    def fix(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`").cast(_snake_type(f.dataType))
        if isinstance(f.dataType, T.MapType) and isinstance(f.dataType.keyType, T.StringType):
            c = F.transform_keys(c, lambda k, _: names.snake_column(k))
        return c.alias(names.snake(f.name))

    return df.select(*[fix(f) for f in df.schema])


def header_row_to_columns(df: DataFrame, position: str, cells: str, use_header: bool = True) -> DataFrame:
    """Sheet rows (0-based position, array of cells) as named text columns.

    The first row gives the names: it is the one row read while planning. Row numbers count
    from 1 with the header as row 1; short rows are padded with the empty text.
    """
    number = (F.col(position) + 1).cast("string").alias("row_index")
    texts = F.transform(cells, lambda x: F.coalesce(x.cast("string"), F.lit("")))
    if not use_header:
        return df.select(number, texts.alias("values"))
    head = df.filter(F.col(position) == 0).select(cells).first()
    if head is None:
        return df.select(number).limit(0)
    cols = [names.sanitize(str(h) if h is not None else "", i) for i, h in enumerate(head[0])]
    return df.filter(F.col(position) > 0).select(
        number, *[F.coalesce(F.get(texts, i), F.lit("")).alias(c) for i, c in enumerate(cols)]
    )


def zip_headers(df: DataFrame, headers: str, values: str, wanted: list[str], keep: list[str] = ()) -> DataFrame:
    """Parallel arrays of names and values as columns; a name that is absent gives null."""
    m = df.select(*keep, F.map_from_arrays(headers, values).alias("__m"))
    return m.select(*keep, *[F.col("__m").getItem(w).alias(w) for w in wanted])


def rename_map(df: DataFrame, body: str, columns: dict[str, str], nested: tuple[str, ...] = (), epoch: tuple[str, ...] = (), source: dict[str, str] | None = None, keep: list[str] = ()) -> DataFrame:
    """JSON objects with camelCase keys as snake_case columns of the given types.

    ``columns``: name -> type. A column that starts with a ``nested`` prefix is read from
    inside that object, ``epoch`` columns hold milliseconds, ``source`` names exceptions.
    """
    text = F.col(body)

    def path(name: str) -> str:
        if source and name in source:
            return "$." + source[name]
        for p in nested:
            if name.startswith(p + "_"):
                return f"$.{names.camel(p)}.{names.camel(name[len(p) + 1:])}"
        return "$." + names.camel(name)

    cols = []
    for name, kind in columns.items():
        raw = F.get_json_object(text, path(name))
        cols.append((epoch_ms(raw) if name in epoch else raw.try_cast(kind)).alias(name))
    return df.select(*keep, *cols)


# The flat columns of the time-tracking tables.
TIME_TRACKING_TABLES = {
    "customers": "id bigint, name string, description string, archived boolean, created timestamp, url string, allowed_actions_can_modify boolean, allowed_actions_can_delete boolean",
    "projects": "id bigint, name string, description string, customer_id bigint, archived boolean, created timestamp, workflow_enabled boolean, default_type_of_work_id bigint, url string, allowed_actions_can_modify boolean, allowed_actions_can_delete boolean",
    "tasks": "id bigint, name string, description string, project_id bigint, customer_id bigint, archived boolean, created timestamp, type_of_work_id bigint, workflow_status_id bigint, deadline string, estimated_time bigint, url string, allowed_actions_can_modify boolean, allowed_actions_can_delete boolean, allowed_actions_can_complete boolean",
    "timetrack": "user_id bigint, date string, task_id bigint, time bigint",
    "leavetime": "user_id bigint, date string, leave_type_id bigint, time bigint",
}


def time_tracking_rows(df: DataFrame, body: str, table: str) -> DataFrame:
    pairs = [p.strip().split(" ") for p in TIME_TRACKING_TABLES[table].split(",")]
    return rename_map(
        df, body, dict(pairs), nested=("allowed_actions",), epoch=("created",),
        source={"time": "leaveTime"} if table == "leavetime" else None,
    )


# --- arrays, maps, series ---------------------------------------------------------------


def series_matrix_to_rows(df: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """``series[s][d]`` x ``xValues[d]`` x ``seriesMeta[s]`` as (date, segment, value).

    Without a text label the segment is ``Totals``; a short series gives fewer rows. The
    object may sit below ``data``; a list there is already flat (date, count, segment).
    """
    text = F.coalesce(F.get_json_object(F.col(body), "$.data"), F.col(body))
    matrix = F.from_json(text, "series array<array<double>>, xValues array<string>, seriesMeta array<variant>")
    flat = F.from_json(text, "array<struct<date:string,count:double,segment:string>>")
    listed = F.ltrim(text).startswith("[")

    def label(i: Column) -> Column:
        entry = F.get(F.col("__x.seriesMeta"), i)
        name = F.when(F.schema_of_variant(entry) == "STRING", F.try_variant_get(entry, "$", "string"))
        return F.coalesce(name, F.lit("Totals"))

    base = df.select(*keep, F.when(~listed, matrix).alias("__x"), F.when(listed, flat).alias("__f"))
    lines = F.transform(
        F.col("__x.series"),
        lambda line, i: F.transform(
            F.slice(F.col("__x.xValues"), F.lit(1), F.least(F.size(line), F.size("__x.xValues"))),
            lambda day, d: F.struct(day.alias("date"), label(i).alias("segment"), F.get(line, d).alias("value")),
        ),
    )
    plain = F.transform(
        "__f", lambda r: F.struct(r["date"].alias("date"), F.coalesce(r["segment"], F.lit("Totals")).alias("segment"), r["count"].alias("value"))
    )
    rows = base.select(*keep, F.explode(F.coalesce(plain, F.flatten(lines))).alias("__r"))
    return rows.select(*keep, "__r.date", "__r.segment", "__r.value")


def normalize_answers(answers: Column, metadata: list[str]) -> Column:
    """Map question -> variant as map question -> (choiceText, choiceId, textEntry).

    A bare value becomes the textEntry; metadata keys are removed; no answers is null.
    """
    skip = F.array(*[F.lit(m) for m in metadata])
    kept = F.map_filter(answers, lambda k, _: ~F.array_contains(skip, k))

    def field(v: Column, name: str) -> Column:
        part = F.try_variant_get(v, f"$.{name}", "variant")
        nested = F.schema_of_variant(part).rlike("^(OBJECT|ARRAY)")
        return F.when(nested, F.to_json(part)).otherwise(F.try_variant_get(part, "$", "string"))

    def one(v: Column) -> Column:
        is_object = F.schema_of_variant(v).startswith("OBJECT")
        bare = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))
        return F.struct(
            F.when(is_object, field(v, "choiceText")).alias("choiceText"),
            F.when(is_object, field(v, "choiceId")).alias("choiceId"),
            F.when(is_object, field(v, "textEntry")).otherwise(bare).alias("textEntry"),
        )

    return F.when(F.size(kept) > 0, F.transform_values(kept, lambda _, v: one(v)))


def coalesce_from_map(top: Column, answers: Column, name: str) -> Column:
    """A field from the top level, else the textEntry of the entry of that name."""
    return F.coalesce(top, answers.getItem(name).getField("textEntry"))


def association_ids(body: Column, kinds: list[str]) -> list[Column]:
    """``associations.<kind>`` as an array of ids per expected kind; absent is empty."""
    cols = []
    for kind in kinds:
        at = F.get_json_object(body, f"$['associations']['{kind}']")
        results = F.get_json_object(at, "$.results")
        items = F.from_json(F.coalesce(results, at), "array<variant>")
        ids = F.transform(
            items,
            lambda x: F.when(
                F.schema_of_variant(x).startswith("OBJECT"),
                F.coalesce(F.try_variant_get(x, "$.id", "string"), F.lit("")),
            ).otherwise(F.try_variant_get(x, "$", "string")),
        )
        cols.append(F.coalesce(ids, F.array().cast("array<string>")).alias(kind))
    return cols


def links_to_rows(df: DataFrame, entity: str, key: str, links: str) -> DataFrame:
    """Map rel -> href unpivoted to (entity, id, rel, href); null links are dropped."""
    return df.select(F.lit(entity).alias("entity"), F.col(key).alias("id"), F.explode(links).alias("rel", "href")).filter(
        F.col("href").isNotNull()
    )


def hoist(df: DataFrame, fields: dict[str, str], template: dict[str, list] | None = None, constants: dict[str, object] | None = None) -> DataFrame:
    """Lift nested fields, build id texts from parts, stamp source constants."""
    cols = {name: F.col(path) for name, path in fields.items()}
    for name, parts in (template or {}).items():
        cols[name] = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    for name, value in (constants or {}).items():
        cols[name] = F.lit(value)
    return df.withColumns(cols)


def kind_dispatch(df: DataFrame, kind: str, layouts: dict[str, dict[str, Column]], common: dict[str, Column]) -> DataFrame:
    """Common columns plus the columns of the first layout whose name is in ``kind``."""
    wide: dict[str, Column] = {}
    taken: Column = F.lit(False)
    for part, layout in layouts.items():
        mine = F.contains(F.col(kind), F.lit(part)) & ~taken
        for name, expr in layout.items():
            value = F.when(mine, expr)
            wide[name] = F.coalesce(wide[name], value) if name in wide else value
        taken = taken | F.contains(F.col(kind), F.lit(part))
    return df.select(*[e.alias(n) for n, e in common.items()], *[e.alias(n) for n, e in wide.items()])


def as_string_list(v: Column) -> Column:
    """A variant as a list of texts: a list keeps its items, anything else is one item."""
    listed = F.schema_of_variant(v).startswith("ARRAY")
    items = F.transform(F.when(listed, F.try_variant_get(v, "$", "array<variant>")), variant_text)
    return F.when(~F.is_variant_null(v), F.when(listed, items).otherwise(F.array(variant_text(v))))


def variant_text(v: Column) -> Column:
    nested = F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
    return F.when(nested, F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))


def map_strings(m: Column) -> Column:
    """Map values as text, null as the empty text."""
    return F.transform_values(m, lambda _, v: F.coalesce(v.cast("string"), F.lit("")))


def singleton_row(df: DataFrame, known: list[str], key: str = "id") -> DataFrame:
    """A one-object table: constant key, and only if a known field is there."""
    seen = F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(True)) for k in known])
    return df.filter(seen).withColumn(key, F.lit(1).cast("bigint"))


def position_index(df: DataFrame, by: list[str], order: list[str], out: str = "position") -> DataFrame:
    """0-based result position in the group under a total order, as part of the key."""
    return ordered.row_index(df, by, order, out)


def redact_emails(text: Column) -> Column:
    """Email shapes replaced; texts without an at sign are passed through."""
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, _EMAIL_ONCE, REDACTED_EMAIL)).otherwise(text)


def has_email(text: Column) -> Column:
    return F.contains(text, F.lit("@")) & text.rlike(_EMAIL_ONCE)


def redact_headers(headers: Column, names_lower: list[str]) -> Column:
    """Values of sensitive keys replaced, whatever the case of the key."""
    secret = F.array(*[F.lit(n.lower()) for n in names_lower])
    return F.transform_values(headers, lambda k, v: F.when(F.array_contains(secret, F.lower(k)), F.lit(REDACTED)).otherwise(v))


def indexed_rows(df: DataFrame, table: str, items: str) -> DataFrame:
    """``items`` (array of (Index, Columns map)) as (table, row_index, columns) rows.

    A missing index falls back to the position; one that is no number is null.
    """
    x = df.select(table, F.posexplode(items).alias("__pos", "__row"))
    index = F.coalesce(F.col("__row.Index").cast("string"), F.col("__pos").cast("string"))
    return x.select(table, F.when(index.rlike(r"^\d+$"), index.cast("bigint")).alias("row_index"), map_strings(F.col("__row.Columns")).alias("columns"))


def attribute_rows(df: DataFrame, parent: str, attributes: str) -> DataFrame:
    """``attributes`` (array of (name, value, type)) as (parent, name, value text, type) rows."""
    x = df.select(parent, F.explode(attributes).alias("__a"))
    return x.select(parent, F.col("__a.name").alias("name"), F.col("__a.value").cast("string").alias("value"), F.col("__a.type").alias("type"))
