"""Data quality checks; each gives a small report as a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import ERRORS, coerce
from tidemark.operators.change import row_hash
from tidemark.plans.meta import TableMeta
from tidemark.session import checkpointed


def check_non_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, nulls) of the non-nullable (or given) columns, in one pass."""
    cols = columns if columns is not None else [f.name for f in df.schema if not f.nullable]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "nulls")


def leaf_paths(kind: T.DataType, c: Column, path: str) -> list[tuple[str, Column]]:
    """(path, is filled) of every leaf; lists and maps count when any element fills it."""
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in leaf_paths(f.dataType, c.getField(f.name), f"{path}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        out = []
        for name, _ in leaf_paths(kind.elementType, F.lit(None), path + "[]"):
            out.append((name, _any_filled(kind.elementType, c, name, path + "[]")))
        return out
    if isinstance(kind, T.MapType):
        return [(path + "{}", F.coalesce(F.exists(F.map_values(c), lambda x: x.isNotNull()), F.lit(False)))]
    return [(path, c.isNotNull())]


def _any_filled(kind: T.DataType, items: Column, name: str, path: str) -> Column:
    pick = lambda x: dict(leaf_paths(kind, x, path))[name]
    return F.coalesce(F.exists(items, pick), F.lit(False))


def check_population(df: DataFrame) -> DataFrame:
    """(path, filled): for every leaf whether any row has a value, nested paths too."""
    leaves = [x for f in df.schema for x in leaf_paths(f.dataType, F.col(f"`{f.name}`"), f.name)]
    row = df.agg(*[F.coalesce(F.bool_or(ok), F.lit(False)).alias(str(i)) for i, (_, ok) in enumerate(leaves)])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("path"), F.col(str(i)).alias("filled")) for i, (n, _) in enumerate(leaves)]))
    return row.select(pairs.alias("x")).select("x.*")


def check_records(df: DataFrame, body: str, schema: T.StructType, keys: list[str] = (), deleted: str | None = None) -> DataFrame:
    """One row: records, misfits (do not coerce), empty (all null), keyless."""
    typed = coerce(df, body, schema, "quarantine")
    cols = [f.name for f in schema]
    data = [c for c in cols if c != deleted]
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in data])
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    return typed.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.size(ERRORS) > 0).alias("misfits"),
        F.count_if(empty).alias("empty"), F.count_if(keyless).alias("keyless"),
    )


def check_pk_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that are null or occur more than once, with their row count."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return n.filter((F.col("rows") > 1) | null)


def declared_paths(kind: T.DataType, path: str = "") -> list[str]:
    """Field paths of a schema; arrays are looked through, map keys are ``*``."""
    if isinstance(kind, T.StructType):
        out = []
        for f in kind.fields:
            here = f"{path}.{f.name}" if path else f.name
            out += [here, *declared_paths(f.dataType, here)]
        return out
    if isinstance(kind, T.ArrayType):
        return declared_paths(kind.elementType, path)
    if isinstance(kind, T.MapType):
        here = f"{path}.*" if path else "*"
        return [here, *declared_paths(kind.valueType, here)]
    return []


_KINDS = {"VOID": "null", "BOOLEAN": "bool", "BIGINT": "int", "STRING": "str", "ARRAY<VOID>": "list", "OBJECT<>": "dict"}


def leaf_kind(v: Column) -> Column:
    """null, bool, int, float or str of a leaf, list or dict of an empty container."""
    known = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.schema_of_variant(v)), F.lit("float"))


#: Levels that one pass goes down.
LEVELS = 12
_PAIRS = "array<struct<path:string,kind:string>>"


def _descend(nodes: DataFrame) -> DataFrame:
    """One level down: every open node (path, v) is replaced by its members or items, each a row; an item keeps its list's path.

    ``found`` collects (path, kind) on the first of these rows only, so each node is told once. A container's kind shows from
    its children, so only leaves and empty containers are asked for their type. Rows without an open node stay as they are.
    """
    d = nodes.lateralJoin(nodes.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    kind = F.when(F.col("pos").isNull(), leaf_kind(F.col("v"))).when(F.col("key").isNotNull(), "dict").otherwise("list")
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    told = F.when(F.col("v").isNotNull() & F.col("named"), F.array_append("found", F.struct("path", kind.alias("kind")))).otherwise(F.col("found"))
    name = F.when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), "key"))
    return d.select(
        F.when(first, told).otherwise(F.array().cast(_PAIRS)).alias("found"), F.coalesce(name, F.col("path")).alias("path"),
        F.col("key").isNotNull().alias("named"), F.col("value").alias("v"),
    )


def data_paths(df: DataFrame, body: str) -> DataFrame:
    """Distinct (path, kind) pairs present in a JSON column; lists are looked through.

    A worklist of open nodes: one pass goes ``LEVELS`` levels down and writes the pairs it finds, a small table. Only
    if nodes are still open there, they alone are the next pass's input; so one deep document doesn't change what the others cost.
    """
    start = df.select(
        F.array().cast(_PAIRS).alias("found"), F.lit("").alias("path"), F.lit(False).alias("named"), F.try_parse_json(body).alias("v")
    )
    tables, open_ = [], start
    while True:
        for _ in range(LEVELS):
            open_ = _descend(open_)
        # a null pair marks open nodes, so the pass that finds the pairs also tells whether there is another
        more = F.when(F.col("v").isNotNull(), F.array_append("found", F.lit(None).cast("struct<path:string,kind:string>"))).otherwise(F.col("found"))
        pairs = open_.select(F.explode(more).alias("x")).select("x.path", "x.kind").distinct()
        tables.append(checkpointed(pairs, "paths"))
        if tables[-1].filter("path is null").isEmpty():
            break
        rest = open_.filter("v is not null").select(F.array().cast(_PAIRS).alias("found"), "path", "named", "v")
        open_ = checkpointed(rest, "nodes")
    return reduce(DataFrame.union, tables).filter("path is not null").distinct()


def schema_diff(df: DataFrame, body: str, schema: T.StructType) -> DataFrame:
    """(path, side): ``undeclared`` paths of the data and ``absent`` declared ones."""
    declared = declared_paths(schema)
    rows = [(p, "^" + "\\.".join("[^.]+" if s == "*" else _quote(s) for s in p.split(".")) + "$") for p in declared]
    found = data_paths(df, body).select("path").distinct()
    pattern = "|".join(r for _, r in rows) or "^$"
    undeclared = found.filter(~F.col("path").rlike(pattern)).select("path", F.lit("undeclared").alias("side"))
    flags = [F.coalesce(F.bool_or(F.col("path").rlike(r)), F.lit(False)).alias(str(i)) for i, (_, r) in enumerate(rows)]
    if not rows:
        return undeclared
    seen = found.agg(*flags).select(
        F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.col(str(i)).alias("hit")) for i, (p, _) in enumerate(rows)])).alias("x")
    )
    absent = seen.filter("not x.hit").select("x.path", F.lit("absent").alias("side"))
    return undeclared.unionByName(absent)


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"


def shape_diff(a: DataFrame, b: DataFrame, body: str) -> DataFrame:
    """(path, left, right): fields whose JSON kinds differ; null fits every kind."""
    def kinds(df: DataFrame, name: str) -> DataFrame:
        known = F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind"))))
        return data_paths(df, body).groupBy("path").agg(F.nullif(F.array_join(known, ","), F.lit("")).alias(name), F.lit(True).alias(f"in_{name}"))

    j = kinds(a, "left").join(kinds(b, "right"), "path", "full_outer")
    missing = F.col("in_left").isNull() | F.col("in_right").isNull()
    differ = F.col("left").isNotNull() & F.col("right").isNotNull() & (F.col("left") != F.col("right"))
    return j.filter(missing | differ).select("path", "left", "right")


def reconcile(written: DataFrame, visible: DataFrame, keys: list[str], deleted: DataFrame | None = None, delete_feed: DataFrame | None = None) -> DataFrame:
    """(keys..., problem): written rows that are missing or differ, deletes not in the feed."""
    attrs = [c for c in written.columns if c not in keys]
    a = written.select(*keys, row_hash(written, attrs).alias("__a"))
    b = visible.select(*written.columns).select(*keys, row_hash(written, attrs).alias("__b"))
    j = a.join(b, keys, "left")
    out = j.filter(F.col("__b").isNull() | (F.col("__a") != F.col("__b"))).select(
        *keys, F.when(F.col("__b").isNull(), "missing").otherwise("differs").alias("problem")
    )
    if deleted is not None and delete_feed is not None:
        lost = deleted.select(*keys).join(delete_feed.select(*keys), keys, "left_anti")
        out = out.unionByName(lost.withColumn("problem", F.lit("delete not delivered")))
    return out


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, checksum) of the multiset of rows, whatever their order."""
    h = row_hash(df, df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("checksum"))


def dealt_anew(df: DataFrame) -> DataFrame:
    """The same rows in other tasks and another order; their number follows the bytes, so no task reads more as the table grows."""
    return df.hint("rebalance")


def stable_read(read) -> bool:
    """Whether two calls of ``read()`` give the same rows."""
    return fingerprint(read()).first() == fingerprint(read()).first()


def table_profile(df: DataFrame, meta: TableMeta, name_filter: str | None = None) -> DataFrame:
    """(key, value) texts: keys, cursor, type, rows, nulls per column, cursor bounds."""
    c = meta.cursor_field
    nulls = [F.count_if(F.col(f"`{x}`").isNull()).cast("string").alias(f"nulls.{x}") for x in df.columns]
    bounds = [F.min(c).cast("string").alias("cursor_min"), F.max(c).cast("string").alias("cursor_max")] if c else []
    row = df.agg(F.count(F.lit(1)).cast("string").alias("rows"), *nulls, *bounds)
    row = row.select(
        F.lit(",".join(meta.primary_keys)).alias("primary_keys"), F.lit(c or "").alias("cursor_field"),
        F.lit(meta.ingestion_type).alias("ingestion_type"), *[F.col(f"`{x}`") for x in row.columns],
    )
    out = row.unpivot([], [F.col(f"`{x}`") for x in row.columns], "key", "value")
    return out.filter(F.contains(F.lower("key"), F.lit(name_filter.lower()))) if name_filter else out
