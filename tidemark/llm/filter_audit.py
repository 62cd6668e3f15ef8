"""Filter interaction audit (operator 13): sorted posting lists, unions and differences by galloping merges.

Five filters are tried on whole texts. A part's rows, in order of their ids, are cut into ranges; every range keeps, for each
filter, the sorted list of the rows that fail it, and the same of the rows that are labelled good or toxic. A galloping merge
of these lists gives the size of the union of every set of filters in a range; sizes are summed over ranges. What
a filter removes after others is the difference of two unions, so all orders follow from the sums: with k filters 2^k sizes a
part, whatever the number of rows.

A list holds places in the part's order by (doc_id, row number), so repeated ids and repeated rows are rows of their own and one
id with any number of rows spans several ranges. Null texts count as empty, null parts are the part ''. A null id is
greater than any id and no smaller than another null id, so a text fails E if an id that is smaller has the same text.
Labels of one id that disagree count as 1 if any is 1; null labels are none. An empty table gives an empty table.
Only doc_id, text, lang and the labels' doc_id, quality and toxic are read, so others may have any name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, removed, ship, small_batches, written

ship(__name__)

FILTERS = "ABCDE"
#: Rows of a part in one range of ids, at most.
RANGE = 16_384
#: What a list of a range can be restricted to: all rows, good rows, toxic rows.
KINDS = ("rows", "good", "toxic")
_SYMBOLS = frozenset(b"#$%&*|")
_CAPITALS = bytes(range(65, 91))


def failures(text: str | None) -> int:
    """Which of A to D the text fails, as bits in this order. ASCII white space and letters are the same bytes in UTF-8."""
    raw = (text or "").encode()
    words = raw.split()
    out = 1 if len(words) < 100 else 0
    if 100 * len(set(words)) < 80 * len(words):
        out |= 2
    if 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 10 * len(text or ""):
        out |= 4
    if not _SYMBOLS.isdisjoint(raw):
        out |= 8
    return out


def judged(documents: DataFrame) -> DataFrame:
    """(doc_id, part, row, fails, digest) of every row; ``fails`` has the bits of A to D, ``row`` is unique. Written."""

    def make():
        def fn(cols):
            return [cols[0], cols[2], [failures(t) for t in cols[1]], [xxhash.xxh3_128_digest((t or "").encode()) for t in cols[1]]]

        return fn

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text", F.coalesce(F.col("lang"), F.lit("")).alias("part"))
    found = map_rows(rows, make, f"doc_id {kind}, part string, fails int, digest binary")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "judged")


def repeats(rows: DataFrame) -> DataFrame:
    """(digest, first): the least id of every text that several rows have. Written, as a join can split a hot text's rows
    next to a table, which it can't next to an aggregate."""
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    return written(least.filter("n > 1 and first is not null").select("digest", "first"), "repeats")


def with_repeats(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``rows`` with the bit of E: a smaller id has the same text."""
    later = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    return rows.join(least, "digest", "left").withColumn("fails", F.col("fails") + F.when(later, 16).otherwise(0)).drop("digest", "first")


def marked(labels: DataFrame) -> DataFrame:
    """(doc_id, marks) of ids with a mark: bit 0 for quality = 1, bit 1 for toxic = 1. Written."""
    marks = labels.groupBy("doc_id").agg(
        (F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).alias("marks")
    )
    return written(marks.filter("doc_id is not null and marks > 0"), "marks")


def postings(rows: DataFrame, filters: int, per_range: int = RANGE) -> DataFrame:
    """(part, first_id, n, lists) for every range: ``lists[f]`` has the sorted places of rows that fail filter ``f``,
    ``lists[filters]`` and ``lists[filters + 1]`` those of good and toxic rows.

    ``rows`` has part, doc_id, row, fails, marks. Ranges come from Spark's range partitioning, whose last column is
    the row number, so neither a hot part nor a hot id is one task's.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    order = ["part", F.col("doc_id").asc_nulls_last(), "row"]
    laid = rows.select("part", "doc_id", "row", "fails", "marks").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut():
            types = (pa.string(), None, pa.int64(), pa.list_(pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=id_type if t is None else t) for v, t in zip((part, first, n, lists), types)],
                names=["part", "first_id", "n", "lists"],
            )

        part, first, n, lists = None, None, 0, []
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for p, i, fails, marks in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "fails", "marks"))):
                if n == per_range or p != part:
                    if n:
                        yield cut()
                    part, first, n, lists = p, i, 0, [[] for _ in range(filters + 2)]
                bits = fails | marks << filters
                while bits:
                    low = bits & -bits
                    lists[low.bit_length() - 1].append(n)
                    bits ^= low
                n += 1
        if n:
            yield cut()

    return laid.mapInArrow(run, f"part string, first_id {kind}, n bigint, lists array<array<int>>")


def gallop(ids: list[int], x: int, start: int) -> int:
    """The first place from ``start`` on whose id is ``x`` or more: doubling steps, then a binary search in the last."""
    step, n = 1, len(ids)
    while start + step < n and ids[start + step] < x:
        start += step
        step *= 2
    return bisect_left(ids, x, start, min(start + step + 1, n))


def union(lists: list[list[int]]) -> list[int]:
    """The sorted union of sorted lists: the list with the least head gives all its ids below the next head at once."""
    out: list[int] = []
    live = [[ids, 0] for ids in lists if ids]
    while len(live) > 1:
        heads = sorted((ids[at], k) for k, (ids, at) in enumerate(live))
        (least, k), (bound, _) = heads[0], heads[1]
        if least == bound:  # in several lists: all but one pass it
            ahead = [live[j] for head, j in heads[1:] if head == least]
            for entry in ahead:
                entry[1] += 1
        else:
            ids, at = live[k]
            end = gallop(ids, bound, at)
            out += ids[at:end]
            live[k][1] = end
        live = [entry for entry in live if entry[1] < len(entry[0])]
    for ids, at in live:
        out += ids[at:]
    return out


def difference(ids: list[int], taken: list[int]) -> list[int]:
    """The sorted ids that aren't in ``taken``; runs of either list that the other doesn't reach are passed by galloping."""
    out, i, j = [], 0, 0
    while i < len(ids):
        j = gallop(taken, ids[i], j) if j < len(taken) else j
        if j == len(taken):
            out += ids[i:]
            break
        if taken[j] == ids[i]:
            i += 1
        else:
            end = gallop(ids, taken[j], i)
            out += ids[i:end]
            i = end
    return out


def union_sizes(lists: list[list[int]], filters: int) -> list[tuple[int, list[int]]]:
    """(set of filters as bits, size of their union among all, good and toxic rows) for every set."""
    good, toxic = lists[filters:]
    own: list[list[int]] = [[]]
    out = [(0, [0, 0, 0])]
    for chosen in range(1, 1 << filters):
        low = chosen & -chosen
        ids = union([own[chosen ^ low], lists[low.bit_length() - 1]])
        own.append(ids)
        # what the union has of a label: the label's list less what is left of it outside the union
        out.append((chosen, [len(ids), len(good) - len(difference(good, ids)), len(toxic) - len(difference(toxic, ids))]))
    return out


def union_totals(lists: DataFrame, filters: int) -> DataFrame:
    """(part, chosen, rows, good, toxic): rows of the part that fail any of the chosen filters; the whole part's rows are
    ``n`` of every line. Sizes of ranges are added up in the task before they are shuffled."""

    def make():
        totals: dict[tuple[str, int], list[int]] = {}

        def fn(cols):
            for part, n, own in zip(*cols):
                for chosen, sizes in union_sizes(own, filters):
                    t = totals.setdefault((part, chosen), [0, 0, 0, 0])
                    for k, v in enumerate((n, *sizes)):
                        t[k] += v
            if len(totals) > 1 << 16:
                return fn.rest()
            return []

        def rest():
            keys, values = list(totals), list(totals.values())
            totals.clear()
            return [[k[0] for k in keys], [k[1] for k in keys], *[[v[i] for v in values] for i in range(4)]]

        fn.rest = rest
        return fn

    found = map_rows(lists.select("part", "n", "lists"), make, "part string, chosen int, n bigint, rows bigint, good bigint, toxic bigint")
    return found.groupBy("part", "chosen").agg(*[F.sum(c).alias(c) for c in ("n", *KINDS)])


def steps(spark, filters: str) -> DataFrame:
    """(filter_order, step, letter, own, before, others): every order's steps; the last three are sets of filters as bits."""
    rows = []
    for order in permutations(filters):
        before = 0
        for k, letter in enumerate(order):
            own = 1 << filters.index(letter)
            rows.append(("".join(order), k + 1, letter, own, before, (1 << len(filters)) - 1 - own))
            before |= own
    return spark.createDataFrame(rows, "filter_order string, step int, letter string, own int, before int, others int")


def orders(totals: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step, from ``union_totals``: 2^k rows a part meet the k! orders' steps."""
    sizes = totals.select("part", "n", "chosen", F.struct(*KINDS).alias("size"))
    of = F.map_from_entries(F.collect_list(F.struct("chosen", "size")))  # 2^k entries
    parts = sizes.groupBy("part").agg(F.max("n").alias("n"), of.alias("sizes"))
    plan = steps(totals.sparkSession, filters)
    before = parts.select("part", "n", "sizes", F.explode(F.map_keys("sizes")).alias("before"))
    every = before.join(F.broadcast(plan), "before")  # a constant table
    every = every.withColumns({
        "after_": F.element_at("sizes", F.col("before").bitwiseOR(F.col("own"))), "before_": F.element_at("sizes", F.col("before")),
        "own_": F.element_at("sizes", F.col("own")), "all_": F.element_at("sizes", F.col("others").bitwiseOR(F.col("own"))),
        "others_": F.element_at("sizes", F.col("others")),
    })
    removed = F.col("after_.rows") - F.col("before_.rows")
    every = every.select(
        "part", "filter_order", "step", "letter", (F.col("n") - F.col("after_.rows")).alias("kept"), removed.alias("removed"),
        (F.col("own_.rows") - removed).alias("redundant"), (F.col("all_.rows") - F.col("others_.rows")).alias("unique_fails"),
        (F.col("after_.good") - F.col("before_.good")).alias("good_lost"),
        (F.col("after_.toxic") - F.col("before_.toxic")).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return every.withColumn("shapley", shapley).drop("letter")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, order of
    the filters and step."""
    rows, marks = judged(documents), marked(labels)
    least = repeats(rows)
    full = with_repeats(rows, least).join(marks, "doc_id", "left").withColumn("marks", F.coalesce("marks", F.lit(0)))
    lists = written(postings(full, len(FILTERS)), "postings")
    totals = written(union_totals(lists, len(FILTERS)), "unions")
    removed(rows, marks, least, lists)
    return orders(totals)


#: The rows of ``audit``, in DuckDB's SQL.
ORACLE = r"""
with recursive d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), f as (
  select doc_id, part,
    (len(w) < 100)::int as a, (100 * len(list_distinct(w)) < 80 * len(w))::int as b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::int as c,
    regexp_matches(text, '[#$%&*|]')::int as d,
    (min(doc_id) over (partition by text) < doc_id)::int as e
  from d
), m as (
  select part, a + 2 * b + 4 * c + 8 * d + 16 * e as fails, count(*) as n, sum((l.quality = 1)::int) as good, sum((l.toxic = 1)::int) as toxic
  from f left join labels l on l.doc_id = f.doc_id group by 1, 2
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as own
), o as (
  select letter as filter_order, own as taken, [own] as bits from letters
  union all
  select filter_order || letter, taken + own, list_append(bits, own) from o join letters on taken & own = 0
), s as (
  select filter_order, unnest(range(1, 6)) as step, unnest(bits) as own, bits from o where len(bits) = 5
), t as (
  select filter_order, step, own, coalesce(list_sum(bits[1:step - 1]), 0)::int as before from s
), r as (
  select part, filter_order, step, own,
    sum(case when fails & (before | own) = 0 then n else 0 end) as kept,
    sum(case when fails & own > 0 and fails & before = 0 then n else 0 end) as removed,
    sum(case when fails & own > 0 and fails & before > 0 then n else 0 end) as redundant,
    sum(case when fails = own then n else 0 end) as unique_fails,
    sum(case when fails & own > 0 and fails & before = 0 then coalesce(good, 0) else 0 end) as good_lost,
    sum(case when fails & own > 0 and fails & before = 0 then coalesce(toxic, 0) else 0 end) as toxic_lost
  from m cross join t group by 1, 2, 3, 4
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""
