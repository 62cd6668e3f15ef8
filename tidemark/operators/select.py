"""Predicates, projection, ordering and paging."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ordered

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType, T.DecimalType)
OPS = ("EQ", "NE", "GT", "GTE", "LT", "LTE", "IN")


def _operand(raw: str, kind: T.DataType):
    """``raw`` in the type of the field; None when it does not fit. Decided while planning."""
    if isinstance(kind, T.BooleanType):
        return raw.lower() in ("true", "1", "yes")
    try:
        if isinstance(kind, _INTEGRAL):
            return int(raw)
        if isinstance(kind, _FLOATING):
            return float(raw)
    except ValueError:
        return None
    return raw


def predicate(schema: T.StructType, field: str, op: str, raw: str) -> Column:
    """One comparison. Null matches only NE; an operand that does not fit matches nothing;
    IN compares as text. The literal has the column's type, so the scan can use it."""
    op = op.upper()
    if op not in OPS:
        raise ValueError(f"unknown operator {op}")
    kind = schema[field].dataType
    c = F.col(field)
    if op == "IN":
        return c.cast("string").isin([x.strip() for x in raw.split(",")])
    value = _operand(raw, kind)
    if value is None:
        return (F.lit(op == "NE") & c.isNull()) if op == "NE" else F.lit(False)
    lit = F.lit(value)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        lit = F.lit(raw).try_cast(kind)
    test = {
        "EQ": c == lit, "NE": c != lit, "GT": c > lit, "GTE": c >= lit, "LT": c < lit, "LTE": c <= lit,
    }[op]
    return (c.isNull() | F.coalesce(test, F.lit(False))) if op == "NE" else test


def filter_ops(df: DataFrame, predicates: list[tuple[str, str, str]]) -> DataFrame:
    """Rows that satisfy all (field, operator, operand text) predicates."""
    for field, op, raw in predicates:
        df = df.filter(predicate(df.schema, field, op, raw))
    return df


def equality_options(df: DataFrame, options: dict[str, str], allowed: list[str]) -> DataFrame:
    """Table options such as ``category`` or ``status`` as equality filters; empty ones are unset."""
    wanted = [(k, "EQ", v) for k, v in options.items() if k in allowed and v not in (None, "")]
    return filter_ops(df, wanted)


def sort_nulls(df: DataFrame, field: str, order: str = "asc", tie: list[str] = ()) -> DataFrame:
    """Nulls last ascending, first descending; ``tie`` makes the order total."""
    c = F.col(field)
    head = c.desc_nulls_first() if order.lower() == "desc" else c.asc_nulls_last()
    return df.orderBy(head, *tie)


def page_offset(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` under a total order; beyond the end none."""
    if limit <= 0:
        return df.limit(0)
    return ordered.rows_between(df, order, max(offset, 0), max(offset, 0) + limit)


def page_number(df: DataFrame, order: list[str], page: int, size: int) -> DataFrame:
    """Page ``page`` (from 1) with ``next_page``: whether another page follows."""
    if page < 1:
        raise ValueError(f"page counts from 1, got {page}")
    rows = df.agg(F.count(F.lit(1))).scalar()
    return page_offset(df, order, (page - 1) * size, size).withColumn("next_page", rows > page * size)


def select_columns(df: DataFrame, columns: list[str], keys: list[str], cursor: str | None = None) -> DataFrame:
    """Projection. Unknown columns, or leaving out a key or the cursor, are errors."""
    if not columns or "*" in columns:
        return df
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    lost = [k for k in [*keys, *([cursor] if cursor else [])] if k not in columns]
    if lost:
        raise ValueError(f"the projection leaves out {lost}, which the change flow needs")
    return df.select(*columns)


def parse_filters_at(text: str | None, segments: list[str]) -> dict[int, str]:
    """JSON {segment name or index: predicate} as index -> predicate.

    An index wins over a name (a name covers all levels that bear it); an unknown one fails.
    """
    given = json.loads(text) if text else {}
    by_name: dict[int, str] = {}
    by_index: dict[int, str] = {}
    for key, expr in given.items():
        k = str(key)
        if k.lstrip("-").isdigit():
            if not 0 <= int(k) < len(segments):
                raise ValueError(f"no level {k} in {segments}")
            by_index[int(k)] = expr
        else:
            at = [i for i, s in enumerate(segments) if s == k]
            if not at:
                raise ValueError(f"no level {k!r} in {segments}")
            by_name.update({i: expr for i in at})
    return {**by_name, **by_index}


def filter_level(df: DataFrame, *exprs: str | None) -> DataFrame:
    """The given SQL predicates in parentheses, combined with AND."""
    parts = [f"({e})" for e in exprs if e]
    return df.filter(" AND ".join(parts)) if parts else df


def search_names(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
