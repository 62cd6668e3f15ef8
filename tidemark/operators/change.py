"""Change application: append, SCD type 1 and 2, deletes, snapshots.

Rules that hold for every operator here: the sequence is non-null (``split_null_sequence``
sets the others aside); on equal sequences a delete beats an upsert, then the greatest row
hash wins; the result does not depend on arrival order or batch borders. Tombstones are
part of the state, so a late upsert cannot bring a deleted key back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ordered

DELETED = "__deleted"
START_AT, END_AT = "__START_AT", "__END_AT"


def _comparable(df: DataFrame, name: str) -> Column:
    """Maps can be neither compared nor hashed; their sorted entries can."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.array_sort(F.map_entries(c))
    if "map<" in df.schema[name].dataType.simpleString() or isinstance(df.schema[name].dataType, T.VariantType):
        return F.to_json(c)
    return c


def row_hash(df: DataFrame, cols: list[str]) -> Column:
    return F.xxhash64(*[_comparable(df, c) for c in sorted(cols)])


def _seq_list(seq: str | list[str]) -> list[str]:
    return [seq] if isinstance(seq, str) else list(seq)


def split_null_sequence(feed: DataFrame, keys: list[str], seq: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows): a change needs all keys and a sequence."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, *_seq_list(seq)]])
    return feed.filter(ok), feed.filter(~ok)


def latest(feed: DataFrame, keys: list[str], seq: str | list[str], deleted: str | None = None, hashed: list[str] | None = None) -> DataFrame:
    """The winning row of every key, tombstones included.

    ``max_by`` is combined before the shuffle, so a key with most of the rows costs each
    task one row. ``hashed`` names the columns of the tie-breaking hash (default: all).
    """
    rest = [c for c in feed.columns if c not in keys]
    dead = [F.coalesce(F.col(deleted), F.lit(False)).cast("int")] if deleted else []
    rank = F.struct(*[F.col(c) for c in _seq_list(seq)], *dead, row_hash(feed, hashed or feed.columns))
    win = feed.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return win.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in feed.columns])


def apply_scd1(feed: DataFrame, keys: list[str], seq: str | list[str], deleted: str | None = None) -> DataFrame:
    """Latest row per key; keys whose latest change is a delete are gone."""
    state = latest(feed, keys, seq, deleted)
    if not deleted:
        return state
    return state.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def with_delete_flow(upserts: DataFrame, deletes: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """One feed from an upsert flow and a delete flow that holds keys and sequence only."""
    gone = deletes.select(*keys, *_seq_list(seq), F.lit(True).alias(DELETED))
    return upserts.withColumn(DELETED, F.lit(False)).unionByName(gone, allowMissingColumns=True)


def apply_scd1_deletes(upserts: DataFrame, deletes: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """Upsert and delete flows: a delete removes the key unless a later upsert exists."""
    return apply_scd1(with_delete_flow(upserts, deletes, keys, seq), keys, seq, DELETED)


def scd2_versions(feed: DataFrame, keys: list[str], seq: str, deleted: str | None = None) -> DataFrame:
    """One row per (key, sequence) with ``__START_AT`` and ``__END_AT`` (the next sequence of
    the key, deletes included). Repeats collapse, ties are decided.

    Copies collapse before the first shuffle, so a group of copies of any size costs each task one row. Rows of
    keys that are not hot are shuffled once, by key: the same partitioning serves the collapse and the interval window.
    """
    cuts = ordered.hot_cuts(feed, keys, [seq], ordered.default_parts(feed))
    if not cuts:
        events = latest(feed.repartition(*keys), [*keys, seq], seq, deleted, feed.columns)
        out = events.withColumn(END_AT, F.lead(seq).over(Window.partitionBy(*keys).orderBy(seq)))
        return out.withColumn(START_AT, F.col(seq))
    cut = ordered.chunked(feed, keys, [seq], cuts)
    chunk = [*keys, ordered.CHUNK]
    events = latest(cut, [*chunk, seq], seq, deleted, feed.columns)
    firsts = cut.groupBy(*chunk).agg(F.min(seq).alias(ordered.FIRST))
    out = ordered.lead_value(events, keys, [seq], seq, END_AT, firsts=firsts)
    return out.drop(ordered.CHUNK).withColumn(START_AT, F.col(seq))


def apply_scd2(feed: DataFrame, keys: list[str], seq: str, deleted: str | None = None) -> DataFrame:
    """All versions of every key. A delete closes the open version and yields no row."""
    out = scd2_versions(feed, keys, seq, deleted)
    if not deleted:
        return out
    return out.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def apply_scd2_deletes(upserts: DataFrame, deletes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return apply_scd2(with_delete_flow(upserts, deletes, keys, seq), keys, seq, DELETED)


def apply_inband_tombstones(
    feed: DataFrame, keys: list[str], seq: str, flag: str = "_deleted", mode: str = "soft", scd_type: int = 1
) -> DataFrame:
    """Tombstones in the same feed. ``soft`` keeps them as flagged rows, ``hard`` removes
    the key (type 1) or closes its open version (type 2)."""
    if mode not in ("soft", "hard"):
        raise ValueError(f"mode must be soft or hard, got {mode!r}")
    dead = flag if mode == "hard" else None
    if scd_type == 2:
        return apply_scd2(feed, keys, seq, dead)
    if dead:
        return apply_scd1(feed, keys, seq, dead)
    # the flag still decides ties, but the row stays
    return latest(feed, keys, seq, flag)


# --- snapshots --------------------------------------------------------------------------


def _same_attributes(schema: T.StructType, attrs: list[str]) -> Column:
    """Null-safe equality of every attribute of the ``__old`` and ``__new`` structs."""

    def pair(c: str) -> Column:
        old, new = F.col(f"__old.{c}"), F.col(f"__new.{c}")
        if isinstance(schema[c].dataType, T.MapType):
            old, new = F.array_sort(F.map_entries(old)), F.array_sort(F.map_entries(new))
        return old.eqNullSafe(new)

    return reduce(lambda a, b: a & b, [pair(c) for c in attrs], F.lit(True))


def snapshot_diff(prev: DataFrame, snap: DataFrame, keys: list[str]) -> DataFrame:
    """Change feed between two snapshots: ``op`` I, U or D with the new (D: old) values."""
    attrs = [c for c in snap.columns if c not in keys]
    old = prev.select(*keys, F.struct(*attrs).alias("__old"))
    new = snap.select(*keys, F.struct(*attrs).alias("__new"))
    joined = old.join(new, keys, "full_outer")
    had, has = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    op = F.when(~had, "I").when(~has, "D").otherwise("U")
    row = F.coalesce("__new", "__old")
    return joined.filter(~(had & has & _same_attributes(snap.schema, attrs))).select(
        *keys, *[row[c].alias(c) for c in attrs], op.alias("op")
    )


BUCKET = "__bucket"


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``df`` with ``__bucket``, a number from the key's hash; a frame that has it, as a table laid out by it, stays as it is."""
    return df if BUCKET in df.columns else df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def bucket_digests(df: DataFrame, keys: list[str], buckets: int = 4096) -> DataFrame:
    """(__bucket, rows, digest, other): small enough to be stored with a table. Two sums of different row hashes, so that a
    changed row goes unnoticed only if both agree by chance."""
    cols = [c for c in df.columns if c != BUCKET]
    d = with_bucket(df, keys, buckets).select(
        BUCKET, row_hash(df, cols).alias("__h"), F.xxhash64(F.lit(1), *[_comparable(df, c) for c in sorted(cols)]).alias("__g")
    )
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return d.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), total("__h").alias("digest"), total("__g").alias("other"))


def differing_buckets(prev: DataFrame, snap: DataFrame) -> DataFrame:
    """(__bucket) where two tables' ``bucket_digests`` differ: as many rows as buckets at most."""
    a, b = (d.select(BUCKET, F.struct("rows", "digest", "other").alias(n)) for d, n in ((prev, "__a"), (snap, "__b")))
    return a.join(b, BUCKET, "full_outer").filter(~F.col("__a").eqNullSafe(F.col("__b"))).select(BUCKET)


def snapshot_diff_by_digest(
    prev: DataFrame, snap: DataFrame, keys: list[str], buckets: int = 4096, prev_digests: DataFrame | None = None
) -> DataFrame:
    """The rows of ``snapshot_diff``, where only buckets of keys whose digests differ are shuffled and joined.

    ``prev_digests`` are those stored with ``prev``, of as many buckets. Where a side is a table partitioned by ``__bucket``, its
    scan reads the partitions that differ only.
    """
    before = prev_digests if prev_digests is not None else bucket_digests(prev, keys, buckets)
    differ = F.broadcast(differing_buckets(before, bucket_digests(snap, keys, buckets)))
    old, new = (with_bucket(d, keys, buckets).join(differ, BUCKET, "left_semi").drop(BUCKET) for d in (prev, snap))
    return snapshot_diff(old, new, keys)


def apply_snapshot_scd1(prev: DataFrame, snap: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new target, counts by op): the target becomes the snapshot."""
    counts = snapshot_diff(prev, snap, keys).groupBy("op").agg(F.count(F.lit(1)).alias("rows"))
    return snap, counts


def open_history(snap: DataFrame, version: Column) -> DataFrame:
    """A first snapshot as type 2 history: every row is open since ``version``."""
    return snap.withColumn(START_AT, version).withColumn(
        END_AT, F.lit(None).cast(snap.select(version.alias("v")).schema["v"].dataType)
    )


def apply_snapshot_scd2(history: DataFrame, snap: DataFrame, keys: list[str], version: Column) -> DataFrame:
    """Type 2 history after a snapshot: changed rows close and open, missing ones close,
    new ones open, the rest stays. One join of the open rows with the snapshot."""
    closed = history.filter(F.col(END_AT).isNotNull())
    live = history.filter(F.col(END_AT).isNull()).drop(END_AT)
    attrs = [c for c in snap.columns if c not in keys]
    old = live.select(*keys, F.struct(*attrs).alias("__old"), F.col(START_AT).alias("__since"))
    new = snap.select(*keys, F.struct(*attrs).alias("__new"))
    joined = old.join(new, keys, "full_outer")
    same = _same_attributes(snap.schema, attrs)
    had, has = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    end_type = history.schema[END_AT].dataType
    none = F.lit(None).cast(end_type)
    at = version.cast(end_type)

    def entry(row: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{row}.{c}").alias(c) for c in attrs], start.alias(START_AT), end.alias(END_AT)
        )

    since = F.col("__since")
    kept = F.when(had & has & same, entry("__old", since, none)).when(had, entry("__old", since, at))
    opened = F.when(has & ~(had & same), entry("__new", at, none))
    versions = joined.select(*keys, F.explode(F.array_compact(F.array(kept, opened))).alias("__v"))
    return closed.unionByName(versions.select(*keys, "__v.*"))


# --- layout and whole rows --------------------------------------------------------------


def clustered(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Rows laid out by range of the cluster columns.

    The row hash is the last range column, so one value with many rows spans several
    partitions instead of one.
    """
    spread = row_hash(df, df.columns)
    args = [*[F.col(c) for c in cols], spread]
    ranged = df.repartitionByRange(partitions, *args) if partitions else df.repartitionByRange(*args)
    return ranged.sortWithinPartitions(*cols)


def full_row_dedupe(df: DataFrame) -> DataFrame:
    """Identical rows collapse; maps are compared by their sorted entries."""
    odd = [f.name for f in df.schema if "map<" in f.dataType.simpleString()]
    if not odd:
        return df.dropDuplicates()
    plain = [c for c in df.columns if c not in odd]
    tagged = df.select("*", *[_comparable(df, c).alias(f"__k_{c}") for c in odd])
    keys = [*plain, *[f"__k_{c}" for c in odd]]
    kept = tagged.groupBy(*keys).agg(*[F.first(c).alias(c) for c in odd])
    return kept.select(*df.columns)
