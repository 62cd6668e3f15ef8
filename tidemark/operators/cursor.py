"""Cursor reads: what part of a table one incremental run may read, and where it stops.

``since`` is exclusive and ``until`` inclusive everywhere. Bounds computed from the data
are scalar subqueries, so they are part of the plan and nothing is collected.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.digest import row_digest
from tidemark.operators import ordered


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# --- ranges -----------------------------------------------------------------------------


def cursor_range(df: DataFrame, c: str, since=None, until=None) -> DataFrame:
    """Rows with ``since < c <= until``; a missing bound is open."""
    if since is not None:
        df = df.filter(F.col(c) > _lit(since))
    if until is not None:
        df = df.filter(F.col(c) <= _lit(until))
    return df


def inclusive_to_exclusive(df: DataFrame, c: str, since) -> DataFrame:
    """For a source whose own filter is ``>=``: drop the rows at or before ``since`` again."""
    return df.filter(F.col(c) >= _lit(since)).filter(F.col(c) > _lit(since))


def apply_lookback(df: DataFrame, c: str, since, seconds: int, until=None) -> DataFrame:
    """Read from ``since - seconds``. Only the read floor moves; see ``advance_cursor``."""
    floor = _lit(since) - F.make_interval(secs=F.lit(seconds))
    return cursor_range(df, c, floor, until)


def advance_cursor(df: DataFrame, c: str, since) -> DataFrame:
    """One row (cursor): the greatest value read, never before the stored ``since``."""
    return df.agg(F.greatest(F.max(c), _lit(since)).alias("cursor"))


def auto_lookback(history: list, factor: float = 1.5, ceiling: int = 3600) -> int:
    """Look-back seconds from the durations of the last five finished walks.

    Entries that are no positive finite number are ignored; without any the result is 0.
    """
    good = [
        float(h) for h in history
        if isinstance(h, (int, float)) and not isinstance(h, bool) and 0 < h < float("inf")
    ]
    return int(min(max(good[-5:], default=0.0) * factor, ceiling))


def cap_at_init(df: DataFrame, c: str, since, init) -> DataFrame:
    """Never read past ``init``, the time frozen when the trigger started."""
    return cursor_range(df, c, since, init)


def no_regress(next_value, current):
    """The offset to store: never before ``current``; equal to it means the read is done."""
    if next_value is None:
        return current
    return next_value if current is None or next_value > current else current


def availability_lag(df: DataFrame, c: str, since, init: dt.datetime, hours: int) -> DataFrame:
    """Ceiling ``init - hours`` for data that its source publishes late."""
    return cursor_range(df, c, since, init - dt.timedelta(hours=hours))


def forward_bound(df: DataFrame, c: str, since, init: dt.datetime, days: int) -> DataFrame:
    """Ceiling ``init + days`` for tables that hold planned, future rows."""
    return cursor_range(df, c, since, init + dt.timedelta(days=days))


# --- windows ----------------------------------------------------------------------------


def window_slice(df: DataFrame, c: str, since: dt.datetime, size: dt.timedelta, ceiling: dt.datetime):
    """One window and the cursor after it: the window end, whether or not it held rows."""
    end = min(since + size, ceiling)
    if end <= since:
        return df.limit(0), since
    return cursor_range(df, c, since, end), end


def window_counts(df: DataFrame, c: str, since: dt.datetime, size: dt.timedelta, ceiling: dt.datetime) -> DataFrame:
    """(window, rows) for the non-empty windows ``(since + w*size, since + (w+1)*size]``."""
    part = cursor_range(df, c, since, ceiling)
    micros = F.unix_micros(F.col(c).cast("timestamp")) - F.unix_micros(F.lit(since).cast("timestamp"))
    width = int(size.total_seconds() * 1_000_000)
    index = F.floor((micros - 1) / F.lit(width)).cast("bigint")
    return part.groupBy(index.alias("window")).agg(F.count(F.lit(1)).alias("rows"))


def window_compact(
    df: DataFrame, c: str, since: dt.datetime, size: dt.timedelta, max_records: int, ceiling: dt.datetime
) -> DataFrame:
    """Chain windows until ``max_records`` rows are gathered or the ceiling is reached.

    Whole windows only: the window that reaches the cap is still read in full. The window
    runs over the per-window counts in one task: one row per window, so range / size rows however large the data.
    """
    counts = window_counts(df, c, since, size, ceiling)
    before = Window.orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    taken = counts.select(
        "window", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")
    ).filter(F.col("before") < max_records)
    secs = size.total_seconds()
    last = taken.agg(
        F.least(
            F.lit(since).cast("timestamp") + F.make_interval(secs=(F.max("window") + 1) * F.lit(secs)),
            F.lit(ceiling).cast("timestamp"),
        ).cast(df.schema[c].dataType).alias("end")
    )
    return cursor_range(df, c, since, ceiling).filter(F.col(c) <= last.scalar())


def inclusive_day_window(c: Column, start: dt.date, days: int) -> Column:
    """Index of the end-inclusive window of ``days`` days; the next one starts a day later."""
    return F.floor(F.datediff(F.to_date(c), F.lit(start)) / F.lit(days)).cast("bigint")


def inclusive_end_step(df: DataFrame, c: str, start: dt.date, days: int) -> DataFrame:
    """Rows per window with its inclusive first and last day; no day is in two windows."""
    w = inclusive_day_window(F.col(c), start, days)
    n = df.filter(F.col(c) >= F.lit(start)).groupBy(w.alias("window")).agg(F.count(F.lit(1)).alias("rows"))
    first = F.date_add(F.lit(start), (F.col("window") * days).cast("int"))
    return n.select("window", first.alias("first_day"), F.date_add(first, days - 1).alias("last_day"), "rows")


def day_chunks(df: DataFrame, c: str, start: dt.date, end: dt.date, days: int, max_days: int) -> DataFrame:
    """The chunks one batch reads: at most ``max_days`` from ``start``, with their row counts.

    Empty chunks are kept with 0 rows so that the cursor passes them.
    """
    stop = min(end, start + dt.timedelta(days=max_days - 1))
    spark = df.sparkSession
    starts = spark.range(0, (stop - start).days // days + 1).select(
        F.date_add(F.lit(start), (F.col("id") * days).cast("int")).alias("chunk_start")
    )
    chunks = starts.withColumn(
        "chunk_end", F.least(F.date_add("chunk_start", days - 1), F.lit(stop))
    )
    day = F.to_date(c)
    index = F.floor(F.datediff(day, F.lit(start)) / F.lit(days)).cast("int")
    n = (
        df.filter((F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(stop + dt.timedelta(days=1))))
        .groupBy(F.date_add(F.lit(start), index * days).alias("chunk_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return chunks.join(n, "chunk_start", "left").select(
        "chunk_start", "chunk_end", F.coalesce("n", F.lit(0)).alias("rows")
    )


# --- caps -------------------------------------------------------------------------------


def limit_batch(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows by a total order (cursor, then key): a cutoff by counts, then a filter."""
    return ordered.rows_between(df, order, 0, n)


def limit_keep_ties(df: DataFrame, n: int, c: str) -> DataFrame:
    """First ``n`` rows by cursor plus every row sharing the n-th row's cursor."""
    known = df.filter(F.col(c).isNotNull())
    last = ordered.cutoff(known, c, n)
    return known if last is None else ordered.up_to(known, c, last[0])


def trim_boundary_cohort(df: DataFrame, c: str, truncated: bool) -> DataFrame:
    """Drop the trailing rows that share the greatest cursor; the next read fetches them whole.

    When all rows share one cursor they are kept if the source is exhausted, and the query
    fails if it was truncated (the cap is too small to make progress). Null-cursor rows stay.
    """
    ends = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
    single = ends.getField("lo") == ends.getField("hi")
    whole: Column = F.lit(True)
    if truncated:
        whole = F.raise_error(F.lit("one cursor value fills the batch: raise the batch cap")).cast("boolean")
    keep = F.col(c).isNull() | F.when(single, whole).otherwise(F.col(c) < ends.getField("hi"))
    return df.filter(keep)


def keyset_resume(df: DataFrame, c: str, tie: str, since=None, since_tie=None, limit: int | None = None) -> DataFrame:
    """Rows after the position (since, since_tie) in (cursor, tie-break) order.

    Null cursors are skipped. A null tie-break would make the position ambiguous: error.
    """
    if not tie:
        raise ValueError("keyset resume needs a tie-break column")
    cur, brk = F.col(c), F.col(tie)
    after: Column = F.lit(True)
    if since is not None:
        after = cur > _lit(since)
        if since_tie is not None:
            after = after | ((cur == _lit(since)) & (brk > _lit(since_tie)))
    out = df.filter(cur.isNotNull() & after)
    if df.schema[tie].nullable:
        checked = F.when(
            brk.isNull(), F.raise_error(F.lit(f"null tie-break in {tie}")).cast(df.schema[tie].dataType)
        ).otherwise(brk)
        out = out.withColumn(tie, checked)
    return ordered.rows_between(out, [c, tie], 0, limit) if limit else out


def same_cluster_redrain(df: DataFrame, c: str, since, until, cap: int) -> DataFrame:
    """Capped window read that cannot stall.

    The first ``cap`` rows by cursor are taken; if their last cursor is the first cursor of
    the window, nothing would be left to resume from, so the whole window is read instead.
    """
    win = cursor_range(df, c, since, until)
    last = ordered.cutoff(win, c, cap)
    if last is None or last[1] == last[2]:  # fewer rows than the cap, or all up to it share the first cursor
        return win
    return ordered.up_to(win, c, last[0])


# --- probes -----------------------------------------------------------------------------


def cursor_bounds(df: DataFrame, c: str) -> DataFrame:
    """One row (oldest, newest): answered from parquet footers when the scan allows it."""
    return df.agg(F.min(c).alias("oldest"), F.max(c).alias("newest"))


def fence(prior, probed):
    """Upper bound of a read: the probed maximum, never before the prior fence."""
    return no_regress(probed, prior)


def skip_if_unchanged(newest, checkpoint) -> bool:
    """True when the newest cursor is before the checkpoint (equal still reads)."""
    return newest is not None and checkpoint is not None and newest < checkpoint


def start_position(option=None, oldest=None, default=None):
    """Where a first read begins: explicit option, else the oldest cursor, else the default."""
    return next((v for v in (option, oldest, default) if v is not None), None)


# --- per-group watermarks ---------------------------------------------------------------


def read_since_group(df: DataFrame, state: DataFrame, group: str, c: str, floor) -> DataFrame:
    """Rows newer than their own group's watermark; unknown groups start at ``floor``.

    ``state`` is (group, watermark): one row per group. The join is left to the optimizer.
    """
    marks = state.select(group, F.col("watermark").alias("__wm"))
    return (
        df.join(marks, group, "left")
        .filter(F.col(c) > F.coalesce("__wm", _lit(floor)))
        .drop("__wm")
    )


def advance_groups(emitted: DataFrame, state: DataFrame, group: str, c: str, failed: DataFrame | None = None) -> DataFrame:
    """New (group, watermark): the maximum emitted; failed groups keep their old value."""
    if failed is not None:
        emitted = emitted.join(failed.select(group), group, "left_anti")
    new = emitted.groupBy(group).agg(F.max(c).alias("__new"))
    return state.join(new, group, "full_outer").select(
        group, F.greatest("watermark", "__new").alias("watermark")
    )


def only_if_advanced(emitted: DataFrame, new_state: DataFrame, old_state: DataFrame) -> DataFrame:
    """``emitted`` when some watermark moved, else no rows."""
    moved = new_state.exceptAll(old_state.select(*new_state.columns)).limit(1).agg(F.count(F.lit(1)))
    return emitted.filter(moved.scalar() > 0)


def two_part_offset(watermark, resume, position, exhausted: bool) -> dict:
    """State after one page of a walk: the watermark only moves when the walk is finished.

    ``position`` is the last (cursor, tie) seen; accepted old shapes: a bare watermark.
    """
    if isinstance(watermark, dict):
        resume = watermark.get("resume", resume)
        watermark = watermark.get("watermark")
    if not exhausted:
        return {"watermark": watermark, "resume": position or resume}
    end = position[0] if position else (resume[0] if resume else None)
    return {"watermark": no_regress(end, watermark), "resume": None}


def skip_unmodified(df: DataFrame, state: DataFrame, key: str, modified: str) -> DataFrame:
    """Single-object tables: emit a row only if it changed after its stored cursor."""
    seen = state.select(key, F.col("watermark").alias("__wm"))
    return (
        df.join(seen, key, "left")
        .filter(F.col("__wm").isNull() | (F.col(modified) > F.col("__wm")))
        .drop("__wm")
    )


# --- null cursors -----------------------------------------------------------------------


def cursor_nulls(df: DataFrame, c: str, keys: list[str], mode: str | None = None, out: str = "__cursor") -> DataFrame:
    """Add ``out``, the cursor used for filtering; the emitted column keeps its nulls.

    ``coalesce[:YYYY]``: a typed floor below every real value, spread per key for
    timestamps. ``error``: fail on a null. ``ignore``: drop the row. A type without a floor
    (boolean, binary) falls back to ``error`` unless ``coalesce`` was asked for.
    """
    asked = mode is not None
    word, _, year = (mode or "coalesce").strip().lower().partition(":")
    if word not in ("coalesce", "error", "ignore"):
        raise ValueError(f"cursor_nulls must be coalesce, error or ignore, got {mode!r}")
    if year and (word != "coalesce" or not (year.isdigit() and len(year) == 4)):
        raise ValueError(f"a floor year is four digits and only for coalesce, got {mode!r}")
    if word == "ignore":
        return df.filter(F.col(c).isNotNull()).withColumn(out, F.col(c))
    kind = df.schema[c].dataType
    if not asked and isinstance(kind, (T.BooleanType, T.BinaryType)):
        word = "error"
    if word == "error":
        fail = F.raise_error(F.lit(f"null cursor in {c}")).cast(kind)
        return df.withColumn(out, F.when(F.col(c).isNull(), fail).otherwise(F.col(c)))
    return df.withColumn(out, F.coalesce(F.col(c), _null_floor(kind, int(year or 2000), keys)))


def _null_floor(kind: T.DataType, year: int, keys: list[str]) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys])
        head = F.conv(F.substring(F.sha1(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
        base = F.lit(dt.datetime(year, 1, 1)).cast(kind)
        return (base + F.make_interval(secs=F.pmod(head, F.lit(1_000_000)) / F.lit(1e6))).cast(kind)
    if isinstance(kind, T.DateType):
        return F.lit(dt.date(year, 1, 1))
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.lit(-(2**63)) if isinstance(kind, T.LongType) else F.lit(-(2**31)).cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.lit(-1.0e308).cast(kind) if isinstance(kind, T.DoubleType) else F.lit(-1.0e37).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    raise ValueError(f"no floor for a cursor of type {kind.simpleString()}")


# --- dedupe, checks, deletes ------------------------------------------------------------


def full_list_cdc(spark, read, offset: dict | None):
    """Sources without a modified-since filter: list everything once, then say done."""
    if offset and offset.get("done"):
        return None, offset
    return read(spark), {"done": True}


def lookback_dedup(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Drop overlap rows already delivered: same key and same full-row hash.

    ``seen`` is (keys..., row_hash). An exact anti-join: a changed row has a new hash and
    is emitted again.
    """
    hashed = df.withColumn("row_hash", row_digest(df.columns))
    return hashed.join(seen.select(*keys, "row_hash"), [*keys, "row_hash"], "left_anti").drop("row_hash")


def remember(df: DataFrame, keys: list[str], c: str, seen: DataFrame | None = None, horizon=None) -> DataFrame:
    """(keys..., row_hash, cursor) to remember, one entry per key: all those after ``horizon``, the start of
    the next read's lookback. Older rows are not read again, so nothing is forgotten that could come back."""
    mine = df.select(*keys, row_digest(df.columns).alias("row_hash"), F.col(c).alias("cursor"))
    both = mine if seen is None else mine.unionByName(seen)
    if horizon is not None:
        both = both.filter(F.col("cursor").isNull() | (F.col("cursor") > _lit(horizon)))
    newest = both.groupBy(*keys).agg(F.max(F.struct("cursor", "row_hash")).alias("e"))
    return newest.select(*keys, "e.row_hash", "e.cursor")


def filter_ignored(df: DataFrame, c: str, since) -> DataFrame:
    """One row (rows, newer, ignored): ``ignored`` when rows came back and none is newer."""
    return df.agg(
        F.count(c).alias("rows"), F.count_if(F.col(c) > _lit(since)).alias("newer")
    ).withColumn("ignored", (F.col("rows") > 0) & (F.col("newer") == 0))


def check_filter_honoured(df: DataFrame, c: str, since) -> None:
    """Fail when the source plainly ignored the modified-since filter."""
    if filter_ignored(df, c, since).first()["ignored"]:
        raise RuntimeError(f"all rows are at or before {since}: the source ignored the filter")


def history_dedupe(history: DataFrame, key: str, c: str, init) -> DataFrame:
    """A delete history as one tombstone per key, the first seen, none past ``init``."""
    return (
        history.filter(F.col(c) <= _lit(init))
        .groupBy(key)
        .agg(F.min(c).alias(c))
        .withColumn("_deleted", F.lit(True))
    )


def archived_to_deletes(df: DataFrame, archived: Column, archived_at: str, c: str, keys: list[str], since) -> DataFrame:
    """Archived rows after the checkpoint as deletes; the archive time becomes the cursor."""
    gone = df.filter(archived & (F.col(archived_at) > _lit(since)))
    return gone.select(*keys, F.col(archived_at).alias(c), F.lit(True).alias("_deleted"))


def date_cursor_report(df: DataFrame, c: str, last: dt.date, days: int, today: dt.date) -> DataFrame:
    """Re-read the last ``days`` days before the stored date, up to ``today``."""
    start = last - dt.timedelta(days=days)
    return df.filter(
        (F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(today + dt.timedelta(days=1)))
    )


def client_side_since(df: DataFrame, c: str, formats: list[str], since) -> DataFrame:
    """Text cursor in several formats: keep rows at or after ``since`` and unparseable ones.

    ``__cursor`` holds the parsed value; null there means the row must not move the cursor.
    """
    text = F.col(c)
    parsed = reduce(
        lambda a, b: F.coalesce(a, b), [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    ).cast("timestamp_ntz")
    return df.withColumn("__cursor", parsed).filter(
        F.col("__cursor").isNull() | (F.col("__cursor") >= _lit(since))
    )


# --- delta feeds ------------------------------------------------------------------------


def delta_feed(
    df: DataFrame, body: str, keys: dict[str, str], fields: dict[str, str], batch: int, position: str
) -> DataFrame:
    """Adds, changes and tombstones of one JSON feed as typed rows.

    ``keys``/``fields``: column -> type. A tombstone is an entry with ``@removed``; its keys
    come from the body or from the entity reference in ``@odata.id``/``id``, and every other
    column is null. ``_lc_sequence`` is the padded batch and source position, so it grows
    strictly within and across batches. An entry without a full key fails the query.
    """
    from tidemark.functions.keys import entity_key_value

    text = F.col(body)

    def at(name: str) -> Column:
        return F.get_json_object(text, f"$['{name}']")

    gone = F.array_contains(F.json_object_keys(text), "@removed")
    ref = F.coalesce(at("@odata.id"), at("id"))
    single = len(keys) == 1
    cols = []
    for name, kind in keys.items():
        raw = F.coalesce(at(name), F.when(gone, entity_key_value(ref, name, single)))
        value = raw.try_cast(kind)
        fail = F.raise_error(F.concat(F.lit(f"no key {name} in "), F.coalesce(text, F.lit("null"))))
        cols.append(F.when(value.isNull(), fail.cast(kind)).otherwise(value).alias(name))
    for name, kind in fields.items():
        cols.append(F.when(~gone, at(name).try_cast(kind)).alias(name))
    seq = F.concat(F.lit(f"{batch:012d}"), F.lpad(F.col(position).cast("string"), 12, "0"))
    return df.select(*cols, gone.alias("_deleted"), seq.alias("_lc_sequence"))


def reject_sparse(df: DataFrame, body: str, expected: list[str]) -> DataFrame:
    """Refuse delta entries that lack declared properties: they would null good values.

    Tombstones and link changes are not checked (link changes are dropped); text that is
    no JSON object fails.
    """
    text = F.col(body)
    names = F.json_object_keys(text)
    missing = F.array_except(F.array(*[F.lit(e) for e in expected]), names)
    link = F.coalesce(F.get_json_object(text, "$['@odata.context']"), F.lit("")).rlike(
        r"\$(link|deletedLink)$"
    )
    removed = F.array_contains(names, "@removed")
    fail = F.when(
        names.isNull(), F.raise_error(F.concat(F.lit("malformed entry: "), text)).cast("boolean")
    ).when(
        ~removed & (F.size(missing) > 0),
        F.raise_error(F.concat(F.lit("sparse entry lacks "), F.array_join(missing, ","))).cast("boolean"),
    )
    return df.filter(F.coalesce(~link, F.lit(True))).filter(F.coalesce(fail, F.lit(True)))


def refilter_fail_open(df: DataFrame, c: str, since: str) -> DataFrame:
    """Client-side re-filter on a text cursor of mixed renderings.

    A row is dropped only when it and the watermark are of one family (time, number, raw
    text) and the row is at or before it; rows of another family are kept.
    """
    from tidemark.functions.keys import cursor_key

    d = df.withColumns({"__k": cursor_key(F.col(c)), "__s": cursor_key(F.lit(since))})
    same = F.substring("__k", 1, 1) == F.substring("__s", 1, 1)
    return d.filter(~same | (F.col("__k") > F.col("__s")) | F.col(c).isNull()).drop("__k", "__s")


def group_tail(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """First ``n`` rows of every group under a total order, hot groups split."""
    return ordered.row_index(df, by, order, "__i").filter(F.col("__i") < n).drop("__i")
