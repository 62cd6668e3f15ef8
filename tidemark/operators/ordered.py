"""Ordered (window-like) operators that split a hot group over many tasks.

A plain ``Window.partitionBy(key)`` puts all rows of one key in one task. A bounded sample of keys and order values
tells which keys hold more rows than one of ``parts`` tasks should get (``parts``: the number of shuffle partitions) and where
to cut them. Without such keys the operators are plain windows. Otherwise the rows of hot keys are cut into chunks along
all order columns; the window runs inside each (key, chunk), and what must cross a chunk border (last value, next
value, running total) comes from a per-chunk summary. The sample decides borders only, never results.

A frame that already has ``__chunk`` (from ``with_chunk``) is used as it is and keeps it, so
several operators on one frame share one partitioning.

Group columns must be non-null (they are keys), order columns non-null and of a type with a literal.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, discard

CHUNK = "__chunk"
_TMP = "__w_"
FIRST = _TMP + "first"
#: Sampled rows for each part. The sample goes to the driver: this many times the parts, whatever the table's size.
SAMPLED = 40


def default_parts(df: DataFrame) -> int:
    """One part per shuffle partition: what the cluster is set up for is also the size one hot
    group must be cut down to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_cuts(df: DataFrame, by: list[str], order: list[str], parts: int) -> dict[int, list[tuple]]:
    """Hash of each hot key -> ascending order values at which its rows are cut.

    One count and one Bernoulli sample over the key and order columns alone.
    """
    narrow = df.select(_key(by).alias("__key"), *order)
    rows = narrow.count()
    if rows <= parts or parts <= 1:
        return {}
    wanted = SAMPLED * parts
    taken = narrow if rows <= wanted else narrow.sample(wanted / rows, seed=11)
    found: dict[int, list[tuple]] = defaultdict(list)
    seen = 0
    for r in taken.orderBy(*order).collect():
        found[r[0]].append(tuple(r[1:]))
        seen += 1
    cuts = {}
    for key, values in found.items():
        pieces = -(-len(values) * parts // max(seen, 1))
        if pieces > 1 and len(values) > SAMPLED / 2:
            cuts[key] = list(dict.fromkeys(values[len(values) * k // pieces] for k in range(1, pieces)))
    return cuts


def _key(by: list[str]) -> Column:
    return F.xxhash64(*by) if by else F.lit(0).cast("bigint")


def _position_of(df: DataFrame, order: list[str], values: tuple | None = None) -> Column:
    """The order columns, or a cut, as one comparable struct."""
    kinds = dict(df.dtypes)
    cols = [F.col(c) for c in order] if values is None else [F.lit(v).cast(kinds[c]) for c, v in zip(order, values)]
    return F.struct(*[x.alias(f"o{i}") for i, x in enumerate(cols)])


def with_chunk(df: DataFrame, by: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Add ``__chunk``: a number that never decreases along the order within a group; 0 for all rows of
    groups that are not hot."""
    if CHUNK in df.columns:
        return df
    return chunked(df, by, order, hot_cuts(df, by, order, parts or default_parts(df)))


def chunked(df: DataFrame, by: list[str], order: list[str], cuts: dict[int, list[tuple]]) -> DataFrame:
    if not cuts:
        return df.withColumn(CHUNK, F.lit(0))
    # constants: at most two cuts for each part
    entries = [x for k, v in cuts.items() for x in (F.lit(k).cast("bigint"), F.sort_array(F.array(*[_position_of(df, order, c) for c in v])))]
    own = F.element_at(F.create_map(*entries), _key(by))
    longest = max(map(len, cuts.values()))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))])
    here = _position_of(df, order)
    at = F.aggregate(
        steps, F.lit(0), lambda a, step: F.when(F.get(own, a + step - 1) <= here, a + step).otherwise(a)
    )  # binary search
    return df.withColumn(CHUNK, F.when(own.isNull(), F.lit(0)).otherwise(at))


def _cut(df: DataFrame, by: list[str], order: list[str], parts: int | None) -> tuple[DataFrame, bool]:
    """(frame with chunks, whether there can be more than one for a group)."""
    if CHUNK in df.columns:
        return df, True
    cuts = hot_cuts(df, by, order, parts or default_parts(df))
    return chunked(df, by, order, cuts), bool(cuts)


def _inside(by: list[str], order: list) -> Window:
    return Window.partitionBy(*by, CHUNK).orderBy(*order)


def _position(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _across(by: list[str]) -> Window:
    # one row per (group, chunk): at most as many rows as parts for any group
    return Window.partitionBy(*by).orderBy(CHUNK)


def _join_summary(df: DataFrame, summary: DataFrame, by: list[str]) -> DataFrame:
    return df.join(summary, [*by, CHUNK], "left")


def _finish(df: DataFrame, given: DataFrame, *temporary: str) -> DataFrame:
    drop = [*temporary] if CHUNK in given.columns else [*temporary, CHUNK]
    return df.drop(*drop)


def lead_value(
    df: DataFrame, by: list[str], order: list[str], value: str, out: str, parts: int | None = None, firsts: DataFrame | None = None
) -> DataFrame:
    """``out`` = ``value`` of the next row of the group; null on its last row.

    (by, order) must be unique. ``firsts`` may give the first value of each (group, chunk)
    as ``__w_first`` when there is a cheaper way to it than through ``df``.
    """
    d, hot = _cut(df, by, order, parts)
    if not hot:
        return df.withColumn(out, F.lead(value).over(Window.partitionBy(*by).orderBy(*order)))
    if firsts is None:
        firsts = d.groupBy(*by, CHUNK).agg(F.min_by(value, _position(order)).alias(FIRST))
    carry = firsts.select(
        *by, CHUNK, F.lead(FIRST).over(_across(by)).alias(_TMP + "carry")
    )
    w = _inside(by, order)
    d = d.select(
        "*",
        F.lead(value).over(w).alias(_TMP + "v"),
        F.lead(F.lit(True)).over(w).alias(_TMP + "has"),
    )
    res = F.when(F.col(_TMP + "has"), F.col(_TMP + "v")).otherwise(F.col(_TMP + "carry"))
    done = _join_summary(d, carry, by).withColumn(out, res)
    return _finish(done, df, _TMP + "v", _TMP + "has", _TMP + "carry")


def lag_value(
    df: DataFrame, by: list[str], order: list[str], value: str, out: str, parts: int | None = None
) -> DataFrame:
    """``out`` = ``value`` of the previous row of the group; null on its first row."""
    d, hot = _cut(df, by, order, parts)
    if not hot:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*by).orderBy(*order)))
    lasts = d.groupBy(*by, CHUNK).agg(F.max_by(value, _position(order)).alias(_TMP + "last"))
    carry = lasts.select(
        *by, CHUNK, F.lag(_TMP + "last").over(_across(by)).alias(_TMP + "carry")
    )
    w = _inside(by, order)
    d = d.select(
        "*",
        F.lag(value).over(w).alias(_TMP + "v"),
        F.lag(F.lit(True)).over(w).alias(_TMP + "has"),
    )
    res = F.when(F.col(_TMP + "has"), F.col(_TMP + "v")).otherwise(F.col(_TMP + "carry"))
    done = _join_summary(d, carry, by).withColumn(out, res)
    return _finish(done, df, _TMP + "v", _TMP + "has", _TMP + "carry")


def fill_value(
    df: DataFrame,
    by: list[str],
    order: list[str],
    value: str,
    out_last: str | None = None,
    out_next: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Nearest non-null ``value`` at or before (``out_last``) / at or after (``out_next``) a row.

    Rows of a group are ordered by all ``order`` columns; ``value`` may be a struct.
    """
    d, hot = _cut(df, by, order, parts)
    if not hot:
        w = Window.partitionBy(*by).orderBy(*order)
        if out_last:
            df = df.withColumn(out_last, F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        if out_next:
            back = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])  # a frame that grows is linear
            df = df.withColumn(out_next, F.last(value, True).over(back.rowsBetween(Window.unboundedPreceding, 0)))
        return df
    filled = d.filter(F.col(value).isNotNull())
    position = _position(order)
    summary = filled.groupBy(*by, CHUNK).agg(
        F.max_by(value, position).alias(_TMP + "end"),
        F.min_by(value, position).alias(_TMP + "start"),
    )
    # every (group, chunk) present needs the carry, also those without a value of their own
    present = d.groupBy(*by, CHUNK).agg(F.lit(1).alias(_TMP + "one"))
    across = _across(by)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across.rowsBetween(1, Window.unboundedFollowing)
    carry = present.join(summary, [*by, CHUNK], "left").select(
        *by,
        CHUNK,
        F.last(_TMP + "end", True).over(before).alias(_TMP + "prev"),
        F.first(_TMP + "start", True).over(after).alias(_TMP + "next"),
    )
    w = _inside(by, order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    onward = _inside(by, [F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)  # linear, as the frame grows
    extra = []
    if out_last:
        extra.append(F.last(value, True).over(upto).alias(_TMP + "l"))
    if out_next:
        extra.append(F.last(value, True).over(onward).alias(_TMP + "n"))
    d = _join_summary(d.select("*", *extra), carry, by)
    if out_last:
        d = d.withColumn(out_last, F.coalesce(_TMP + "l", _TMP + "prev"))
    if out_next:
        d = d.withColumn(out_next, F.coalesce(_TMP + "n", _TMP + "next"))
    return _finish(d, df, _TMP + "l", _TMP + "n", _TMP + "prev", _TMP + "next")


def running_total(
    df: DataFrame,
    by: list[str],
    order: list[str],
    value: Column,
    out: str,
    parts: int | None = None,
) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the group up to and including this one."""
    d, hot = _cut(df.withColumn(_TMP + "val", value), by, order, parts)
    if not hot:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    sums = d.groupBy(*by, CHUNK).agg(F.sum(_TMP + "val").alias(_TMP + "sum"))
    before = _across(by).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*by, CHUNK, F.sum(_TMP + "sum").over(before).alias(_TMP + "carry"))
    w = _inside(by, order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select("*", F.sum(_TMP + "val").over(w).alias(_TMP + "v"))
    res = F.col(_TMP + "v") + F.coalesce(F.col(_TMP + "carry"), F.lit(0))
    done = _join_summary(d, carry, by).withColumn(out, res)
    return _finish(done, df, _TMP + "val", _TMP + "v", _TMP + "carry")


def row_index(
    df: DataFrame, by: list[str], order: list[str], out: str, parts: int | None = None
) -> DataFrame:
    """``out`` = 0-based position of the row in its group under the total order ``order``; without groups see ``numbered``."""
    if not by and CHUNK not in df.columns:
        return numbered(df, order, out, parts)
    return running_total(df, by, order, F.lit(1).cast("bigint"), out, parts).withColumn(
        out, F.col(out) - 1
    )


# --- positions in a total order ---------------------------------------------------------

_IN_PART = 33  # bits of a row's place in its partition in Spark's ids


def numbered(df: DataFrame, order: list[str], out: str, parts: int | None = None) -> DataFrame:
    """``out`` = 0-based position of the row under the total order ``order``.

    The rows are dealt out by ranges of the order and written once, each with its partition and its place there; the
    partitions' row counts, one small row each, give what comes before. So ``df`` is computed once, no task holds more than a range.
    """
    laid = df.repartitionByRange(parts or default_parts(df), *order).sortWithinPartitions(*order)
    table = checkpointed(laid.withColumn(_TMP + "id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(_TMP + "id", _IN_PART).alias(_TMP + "part")
    counts = table.groupBy(part).agg(F.count(F.lit(1)).alias(_TMP + "n"))
    before = Window.orderBy(_TMP + "part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = counts.select(_TMP + "part", F.coalesce(F.sum(_TMP + "n").over(before), F.lit(0)).alias(_TMP + "start"))
    placed = table.withColumn(_TMP + "part", part).join(F.broadcast(starts), _TMP + "part")
    at = F.col(_TMP + "id").bitwiseAND(F.lit((1 << _IN_PART) - 1)) + F.col(_TMP + "start")
    return placed.withColumn(out, at).select(*df.columns, out)


def cutoff(df: DataFrame, c: str, n: int):
    """(value, rows at or before it, rows at it) of the ``n``-th row by ``c`` (nulls first); None if there are fewer.

    Rows are counted for each value, and the counts written once by ranges of the value. The sums of the ranges, one row each,
    tell the range that holds the row; the running total is over that range alone. No task gathers ``n`` rows.
    """
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias(_TMP + "n")).repartitionByRange(default_parts(df), c)
    table = checkpointed(counts.withColumn(_TMP + "part", F.spark_partition_id()), "counts")
    before, inside = 0, None
    for r in table.groupBy(_TMP + "part").agg(F.sum(_TMP + "n").alias("n")).orderBy(_TMP + "part").collect():
        if before + r.n >= n:
            inside = r[0]
            break
        before += r.n
    found = None
    if inside is not None:
        w = Window.partitionBy(_TMP + "part").orderBy(c)
        total = table.filter(F.col(_TMP + "part") == inside).withColumn(_TMP + "t", F.sum(_TMP + "n").over(w) + before)
        found = total.filter(F.col(_TMP + "t") >= n).agg(F.min(F.struct(_TMP + "t", c, _TMP + "n")).alias("x")).first()["x"]
    discard(table)
    return None if found is None else (found[1], found[0], found[2])


def up_to(df: DataFrame, c: str, value) -> DataFrame:
    """Rows at or before a cutoff's value."""
    if value is None:
        return df.filter(F.col(c).isNull())
    return df.filter(F.col(c).isNull() | (F.col(c) <= F.lit(value).cast(df.schema[c].dataType)))


def rows_between(df: DataFrame, order: list[str], start: int, stop: int | None) -> DataFrame:
    """Rows ``start`` (from 0) to before ``stop`` under the total order ``order`` (nulls first), in this order.

    Cutoffs of the first order column leave the rows in reach; these alone are numbered, split over the tasks.
    """
    start, c, skipped = max(start, 0), order[0], 0
    if stop is not None:
        if stop <= start:
            return df.limit(0)
        last = cutoff(df, c, stop)
        df = df if last is None else up_to(df, c, last[0])
    if start:
        first = cutoff(df, c, start + 1)
        if first is None:
            return df.limit(0)
        value, skipped = first[0], first[1] - first[2]
        if value is not None:
            df = df.filter(F.col(c) >= F.lit(value).cast(df.schema[c].dataType))
    number = F.col(_TMP + "i") + skipped
    keep = number >= start
    if stop is not None:
        keep = keep & (number < stop)
    return row_index(df, [], order, _TMP + "i").filter(keep).orderBy(_TMP + "i").drop(_TMP + "i")
