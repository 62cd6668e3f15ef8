"""MinHash near-dedup (operator 9) with tensored banding, confirmed on full shingle sets.

Texts are lower-cased (A-Z), split at ASCII white space and turned into sets of five-word shingles. Two small
collections of ``GROUPS`` minhash groups are computed, ``2 * GROUPS * WIDTH`` minhashes in all; the keys of the
``GROUPS ** 2`` tables are the pairs of one group from each collection. A pair of similarity s meets in no table with probability
1 - (1 - (1 - s^WIDTH)^GROUPS)^2, below 4e-6 at 0.75.

Hot groups. Texts of equal sets are one class from the start. Group values that occur once are dropped before the
pairs are formed. In a table's bucket, members are compared with two pivots, not with each other. After the components of
these links are known, members outside the pivot's component are compared with members of other components where a
bound on the overlap, from the rare shingles that one has and the other doesn't, allows it. Every pair of a bucket is thus in one
component, compared, or bounded away.

Null and empty texts, and texts without words, have no shingle, are linked with nothing and kept. Rows of equal text
are one class whatever their ids; repeated ids get the component of their own text. A null id has a null component unless
its class has an id, and isn't kept. An empty table gives an empty table. Only doc_id and text are read. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, map_rows, release, removed, ship, written
from tidemark.llm.components import components

ship(__name__)

SHINGLE = 5
WIDTH, GROUPS = 2, 16
#: Least similarity in percent.
SIMILARITY = 75
REMEMBERED = 200_000
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Shingles:
    """Texts to sorted sets of 64-bit shingle hashes; remembers the hashes of words."""

    def __init__(self):
        self.words = _WordHashes()

    def read(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.array(list(map(self.words.__getitem__, words)), np.uint64)
        if len(h) < SHINGLE:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        z = h[: len(h) - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            z *= _MIX
            z += h[k : len(h) - SHINGLE + 1 + k]
        return np.unique(_mixed(z))


class _WordHashes(dict):
    def __missing__(self, word):
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def _mixed(z: np.ndarray) -> np.ndarray:
    z = z ^ (z >> np.uint64(29))
    z *= _MIX2
    return z ^ (z >> np.uint64(32))


def multipliers() -> np.ndarray:
    """Odd multipliers of the minhash functions."""
    return np.random.default_rng(20_011).integers(1, 1 << 63, 2 * GROUPS * WIDTH, dtype=np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Hashes of the ``2 * GROUPS`` minhash groups of a set that isn't empty."""
    low = np.array([(shingles * f).min() for f in factors]).reshape(2 * GROUPS, WIDTH)
    out = np.arange(2 * GROUPS, dtype=np.uint64) * _MIX2
    for k in range(WIDTH):
        out = _mixed(out * _MIX + low[:, k])
    return out


def row_key():
    """A hash of a row's id and text."""
    return F.xxhash64("doc_id", "text").alias("_key")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, n_shingles, class, groups): class is a hash of the set, null without shingles; groups the hashes
    of its minhash groups, those of the first collection first."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        reader, factors = Shingles(), multipliers()

        def fn(cols):
            sizes, names, groups = [], [], []
            for text in cols[1]:
                s = reader.read(text)
                sizes.append(len(s))
                names.append(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                groups.append(signature(s, factors).view(np.int64).tolist() if len(s) else None)
            return [cols[0], cols[2], sizes, names, groups]

        return fn

    return map_rows(
        docs.select("doc_id", "text", row_key()), make,
        f"doc_id {kind}, _key bigint, n_shingles bigint, class bigint, groups array<bigint>",
    )


def shared(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the rows whose ``key`` occurs more than once, the written table of these keys).

    Counts are combined before the shuffle. As the keys are a table of their own, adaptive execution can split a
    hot key's rows in the join, which it can't next to an aggregate.
    """
    keys = written(rows.groupBy(key).count().filter("count > 1").select(key), "keys")
    return rows.join(keys, key), keys


def buckets(found: DataFrame) -> DataFrame:
    """(class, n, bucket): memberships in table buckets of two classes or more, from (class, n, groups); written."""
    single = found.select("class", "n", F.posexplode("groups").alias("place", "value"))
    some, values = shared(single, "value")
    some = some.groupBy("class", "n").agg(
        F.collect_list(F.when(F.col("place") < GROUPS, F.col("value"))).alias("left"),
        F.collect_list(F.when(F.col("place") >= GROUPS, F.col("value"))).alias("right"),
    )  # at most GROUPS values each
    pairs = some.withColumn("u", F.explode("left")).withColumn("v", F.explode("right"))
    pairs = written(pairs.select("class", "n", F.xxhash64("u", "v").alias("bucket")), "pairs")
    members, keys = shared(pairs, "bucket")
    out = written(members, "buckets")
    removed(values, pairs, keys)
    return out


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, set) of the wanted classes (class, _key), each from one of its rows."""

    def make():
        reader = Shingles()

        def fn(cols):
            sets = [reader.read(t) for t in cols[2]]
            ok = [i for i, s in enumerate(sets) if len(s) and xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) == cols[1][i]]
            return [[cols[1][i] for i in ok], [sets[i].view(np.int64).tolist() for i in ok]]

        return fn

    rows = docs.select(row_key(), "text").join(wanted, "_key").select("_key", "class", "text")
    return map_rows(rows, make, "class bigint, set array<bigint>").dropDuplicates(["class"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) for the pairs (a, b), by the intersection of their full sets."""
    a, b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return pairs.join(a, "a").join(b, "b").select("a", "b", (100 * both >= SIMILARITY * union).alias("linked"))


def _possible(x: str, y: str):
    """Sizes that allow the similarity."""
    return 100 * F.least(x, y) >= SIMILARITY * F.greatest(x, y)


def links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b): links between classes, enough of them to connect every two classes that a chain of links connects.

    ``found`` is a written table of ``classes``."""
    spark = docs.sparkSession
    reps = found.filter("class is not null").groupBy("class").agg(
        F.max("n_shingles").alias("n"), F.min_by("groups", "n_shingles").alias("groups")
    )
    members = buckets(reps.select("class", "n", "groups"))
    release(spark)
    candidates = members.select("class").distinct()
    wanted = found.filter("class is not null").groupBy("class").agg(F.min("_key").alias("_key"))
    sets = written(sets_of(docs, wanted.join(candidates, "class")), "sets")
    release(spark)

    # two pivots for each bucket: the first by a hash of the class, and the largest set
    order = F.struct(F.xxhash64("class"), F.col("class"), F.col("n"))
    pivots = members.groupBy("bucket").agg(F.min(order).alias("p"), F.max(F.struct("n", F.xxhash64("class"), "class")).alias("q"))
    ends = pivots.select("bucket", F.explode(F.array(
        F.struct(F.col("p.class").alias("pivot"), F.col("p.n").alias("m")), F.struct(F.col("q.class").alias("pivot"), F.col("q.n").alias("m"))
    )).alias("e")).select("bucket", "e.*")
    ends = written(ends, "pivots")  # a table, so that the join can split a hot bucket
    star = members.join(ends, "bucket").filter(_possible("n", "m")).filter("class <> pivot").select(
        F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")
    ).distinct()
    tested = written(confirmed(star, sets), "tested")
    release(spark)
    linked = tested.filter("linked").select("a", "b")
    parts = written(components(linked), "parts")

    # what is left: buckets with members of several components, beyond pairs of two
    named = members.join(parts, members["class"] == parts["node"], "left").select(
        "bucket", "class", "n", F.coalesce("component", "class").alias("part")
    )
    mixed = named.groupBy("bucket").agg(
        F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("c"), F.min_by("part", F.xxhash64("class")).alias("main")
    ).filter("p <> q and c > 2").select("bucket", "main")
    mixed = written(mixed, "mixed")
    open_ = named.join(mixed, "bucket").groupBy("class").agg(
        F.first("n").alias("n"), F.first("part").alias("part"), F.max(F.col("part") != F.col("main")).alias("aside"),
        F.collect_set("bucket").alias("buckets"),
    )  # at most GROUPS ** 2 buckets
    open_ = written(open_, "open")
    rest = untested(open_, sets).join(tested, ["a", "b"], "left_anti")
    more = confirmed(rest, sets).filter("linked").select("a", "b")
    out = written(linked.union(more), "links")
    removed(members, sets, ends, tested, parts, mixed, open_)
    release(spark)
    return out


def untested(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): the pairs of open classes of different components that share a bucket and that no bound rules out.

    A set's shingles are put in order of how many open sets hold them, rare ones first. Of a similar pair, the first shingle in
    common is near the start of both; all that either has after it bounds the overlap. Only pairs that meet at a shingle
    where this bound allows the similarity are formed, so members of a large bucket that differ in shingles of their own
    don't meet at those that all have.
    """
    held = sets.join(open_.select("class", "n", "part", "aside"), "class").select(
        "class", "n", "part", "aside", F.explode("set").alias("shingle")
    )
    held = held.join(held.groupBy("shingle").agg(F.count("*").alias("c")), "shingle")
    order = Window.partitionBy("class").orderBy("c", "shingle")
    left = F.col("n") - F.row_number().over(order)  # shingles after this one
    early = held.withColumn("left", left).filter((F.col("c") > 1) & (100 * (F.col("left") + 1) >= SIMILARITY * F.col("n")))
    x, y = early.filter("aside").alias("x"), early.alias("y")
    pairs = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") != F.col("y.part")) & _possible("x.n", "y.n")
        & ((100 + SIMILARITY) * (F.least("x.left", "y.left") + 1) >= SIMILARITY * (F.col("x.n") + F.col("y.n"))),
    ).select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()
    a, b = open_.select("class", "buckets").toDF("a", "in_a"), open_.select("class", "buckets").toDF("b", "in_b")
    return pairs.join(a, "a").join(b, "b").filter(F.arrays_overlap("in_a", "in_b")).select("a", "b")


def _members(docs: DataFrame) -> DataFrame:
    found = written(classes(docs), "classes")
    parts = components(links(docs, found))
    least = found.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = least.join(parts, least["class"] == parts["node"], "left").select(
        "class", "least", F.coalesce("component", "class").alias("part")
    )
    ids = written(named.groupBy("part").agg(F.min("least").alias("component_id")), "ids")
    rows = found.join(named.join(ids, "part").select("class", "part", "component_id"), "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "_key", "part",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; component_id is the least id reachable by links."""
    return _members(docs).drop("_key", "part")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates: the one with the least id (null ids last), of rows with that id the one with the
    least hash of its text, of repeated rows the least by their other columns. All rows without shingles; all columns stay."""
    found = written(_members(docs), "members")
    ranked = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")
    chosen = found.filter("part is not null").groupBy("part").agg(F.min(ranked).alias("m")).select("m._key")
    several = found.filter("part is not null").groupBy("_key").count().filter("count > 1").select("_key")
    several = written(several.join(chosen, "_key", "left_semi"), "several")
    stays = written(chosen.union(found.filter("part is null").select("_key")).distinct(), "stays")
    key = fresh(docs, "_key")
    out = docs.withColumn(key, row_key()).join(stays.withColumnRenamed("_key", key), key, "left_semi")
    more = several.withColumnRenamed("_key", key)
    # rows of one key differ in other columns at most, so the order by all columns is one by these
    rest = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    once = out.join(more, key, "left_semi").groupBy(key, "text").agg(F.min_by(F.struct(*docs.columns), rest).alias(key + "_row"))
    return out.join(more, key, "left_anti").select(*docs.columns).unionByName(once.select(key + "_row.*"))


#: The rows of ``near_duplicates`` over ``documents``, in DuckDB's SQL: every two sets that share a shingle are compared.
ORACLE = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle from d
), n as (
  select doc_id, count(*) as n from s group by 1
), c as (
  select a.doc_id as x, b.doc_id as y, count(*) as same from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2
), l as (
  select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * same >= 75 * (p.n + q.n - same)
), r as (
  select doc_id, doc_id as other from d union select r.doc_id, l.y from r join l on l.x = r.other
)
select r.doc_id, cast(coalesce(max(n.n), 0) as bigint) as n_shingles, min(other) as component_id, r.doc_id = min(other) as kept
from r left join n on n.doc_id = r.doc_id group by r.doc_id
"""
