"""Ranked lexical search (operator 11) by hashed max-sketches: upper bounds first, exact scores in descending bounds.

The index holds a sketch of every document: an array of ``SLOTS`` cells for each distinct term, rounded up to a power of two, in which
a term's two hashed cells hold the greatest impact of all terms that fall there. A term's impact in a document grows with
its count there, so counts are what is folded (255 stands for that many or more). A query looks its terms up: the lesser of a term's
two cells bounds its count, the sum of weighted impacts bounds the score. A block of queries is looked up at once.

Documents are scored exactly in descending bounds, in rounds: the first ``FIRST`` of each query, then the first ``SECOND``, then
all whose bound reaches the k-th best score found; no other document can enter the first k, so results are exact. Each task
keeps as many as a round takes, so no task gathers a query's documents. Of equal texts with one bound in a batch, only the k
least ids go on.

The items of the query set are taken in blocks of about ``BLOCK``; an item's terms, their weights and one threshold are all that the
driver sees of a block. Texts of one item id are one item. Null and empty texts have no term and are never found; items without terms
find nothing; a null item id is an item. Repeated rows are documents of their own; null ids come after all others among
equal scores. Empty tables give an empty table. Only doc_id, text, item_id and the items' text are read, so other columns
may have any name. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, removed, scratch, ship

ship(__name__)

#: Cells of a sketch for each distinct term, at least, and its least size.
SLOTS, LEAST = 8, 64
FIRST, SECOND = 32, 512
BLOCK = 1024
#: Salts of the first of two steps that choose a query's leaders from those of all tasks.
SALTS = 64
REMEMBERED = 200_000
TOP = 255
#: Terms are runs of other bytes than these; A to Z become a to z.
_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_SPLIT).split()


class Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        value = xxhash.xxh64_intdigest(term)
        if len(self) < REMEMBERED:
            self[term] = value
        return value


def cells(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of every term in a sketch of ``width`` cells."""
    mask = np.uint64(width - 1)
    return (hashes & mask).astype(np.intp), ((hashes >> np.uint64(32)) & mask).astype(np.intp)


def sketch(counts: Counter, hashes: Hashes) -> bytes:
    width = 1 << max(SLOTS * len(counts) - 1, LEAST - 1).bit_length()
    tf = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), TOP).astype(np.uint8)
    h = np.array(list(map(hashes.__getitem__, counts)), np.uint64)
    order = np.argsort(tf, kind="stable")  # of the terms in one cell the greatest is written last
    out = np.zeros(width, np.uint8)
    for places in cells(h[order], width):
        out[places] = np.maximum(out[places], tf[order])
    return out.tobytes()


@dataclass
class Index:
    """``documents`` (doc_id, key, n, digest, sketch) of documents with terms, ``vocabulary`` (term, df)."""

    documents: DataFrame
    vocabulary: DataFrame
    table: DataFrame
    size: int
    tokens: int


def row_key():
    """Finds a row's text again; rows that share it by chance are scored too, which changes nothing."""
    return F.xxhash64("doc_id", "text")


def build(documents: DataFrame) -> Index:
    """The index of all documents, written in one pass. A task adds up its documents' terms before they are shuffled."""
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make():
        hashes, df = Hashes(), Counter()

        def flushed(ids, keys, sizes, digests, sketches):
            if len(df) > REMEMBERED or not ids:
                words, counts = list(df), list(df.values())
                df.clear()
            else:
                words, counts = [], []
            a, b = [None] * len(words), [None] * len(ids)
            return [ids + a, keys + a, sizes + a, digests + a, sketches + a, b + words, b + counts]

        def fn(cols):
            found = ([], [], [], [], [])
            for i, key, text in zip(*cols):
                all_terms = terms(text)
                if not all_terms:
                    continue
                counts = Counter(all_terms)
                df.update(counts.keys())
                for to, v in zip(found, (i, key, len(all_terms), xxhash.xxh3_128_digest(text), sketch(counts, hashes))):
                    to.append(v)
            return flushed(*found) if found[0] else []

        fn.rest = lambda: flushed([], [], [], [], [])
        return fn

    rows = documents.select("doc_id", row_key().alias("key"), "text")
    schema = f"doc_id {kind}, key bigint, n bigint, digest binary, sketch binary, term binary, df bigint"
    path = scratch(spark, "lexical-index")
    # cells are mostly zeros
    map_rows(rows, make, schema).write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table._scratch = path
    found = table.filter("term is null")
    size, tokens = found.agg(F.count("*"), F.sum("n")).first()
    vocabulary = table.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    return Index(found.drop("term", "df"), vocabulary, table, size, tokens or 0)


@dataclass
class Block:
    """Some items: their ids, the hashes, weights and bytes of their terms, and for each item the places of its terms."""

    items: list
    words: list[bytes]
    hashes: np.ndarray
    weights: np.ndarray
    places: np.ndarray
    starts: np.ndarray
    size: int
    tokens: int
    cells: dict = field(default_factory=dict)  # by the sketch's size

    def length(self, n: int) -> int:
        """The document's m."""
        return 10 + 90 * n * self.size // self.tokens

    def impacts(self, n: int) -> np.ndarray:
        """The impact of every count up to ``TOP``, whose entry bounds all counts from there on."""
        tf = np.arange(TOP + 1, dtype=np.int64)
        out = 1_000_000_000 * tf // (1000 * tf + 8 * self.length(n))
        out[TOP] = 1_000_000
        return out

    def bounds(self, data: bytes, n: int) -> np.ndarray:
        """Upper bounds of a document's scores for all items."""
        own = np.frombuffer(data, np.uint8)
        if len(own) not in self.cells:
            self.cells[len(own)] = cells(self.hashes, len(own))
        one, two = self.cells[len(own)]
        told = self.weights * self.impacts(n).take(np.minimum(own.take(one), own.take(two)))
        return np.add.reduceat(told.take(self.places), self.starts)

    def scores(self, counts: Counter, n: int, chosen: list[int]) -> list[int]:
        """Exact scores for the chosen items."""
        m, known, out = 8 * self.length(n), {}, []
        ends = [*self.starts[1:].tolist(), len(self.places)]
        for item in chosen:
            total = 0
            for p in self.places[self.starts[item]:ends[item]].tolist():
                if p not in known:
                    tf = counts.get(self.words[p], 0)
                    known[p] = int(self.weights[p]) * (1_000_000_000 * tf // (1000 * tf + m)) if tf else 0
                total += known[p]
            out.append(total)
        return out


def blocks(items: DataFrame, index: Index, per_block: int = BLOCK):
    """The items as blocks; rows of one id are in the same block."""

    def make():
        def fn(cols):
            pairs = [(i, t) for i, text in zip(*cols) for t in dict.fromkeys(terms(text))]
            return [[p[0] for p in pairs], [p[1] for p in pairs]]

        return fn

    kind = items.schema["item_id"].dataType.simpleString()
    found = map_rows(items.select("item_id", "text"), make, f"item_id {kind}, term binary").distinct()
    known = found.join(index.vocabulary, "term")
    parts = -(-items.select("item_id").distinct().count() // per_block)
    for part in range(parts):
        rows = known.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()  # about per_block items
        if not rows:
            continue
        df = {bytes(r.term): r.df for r in rows}
        words = sorted(df)
        at = {w: k for k, w in enumerate(words)}
        own: dict = {}
        for r in rows:
            own.setdefault(r.item_id, []).append(at[bytes(r.term)])
        ids = sorted(own, key=lambda i: (i is None, i))
        lists = [sorted(own[i]) for i in ids]
        yield Block(
            ids, words, np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64),
            np.array([math.floor(1000 * math.log((2 * index.size + 2) / (2 * df[w] + 1))) for w in words], np.int64),
            np.concatenate(lists).astype(np.intp), np.cumsum([0, *map(len, lists[:-1])]).astype(np.intp), index.size, index.tokens,
        )


def leaders(index: Index, block: Block, first: int, least: np.ndarray) -> DataFrame:
    """(item, key, bound): the ``first`` documents of greatest bound, of ``least`` or more, for each item (its number in the block)."""

    def make():
        best: list[np.ndarray] = [np.empty((0, len(block.items)), np.int64)] * 2

        def fn(cols):
            found = np.array([block.bounds(s, n) for s, n in zip(cols[2], cols[1])])
            found[found < least] = 0
            keys = np.broadcast_to(np.array(cols[0], np.int64)[:, None], found.shape)
            b, k = np.concatenate([best[0], found]), np.concatenate([best[1], keys])
            if len(b) > first:
                chosen = np.argpartition(b, len(b) - first, axis=0)[len(b) - first:]
                b, k = np.take_along_axis(b, chosen, 0), np.take_along_axis(k, chosen, 0)
            best[:] = b, k
            return []

        def rest():
            rows, items = np.nonzero(best[0])
            return [items.tolist(), best[1][rows, items].tolist(), best[0][rows, items].tolist()]

        fn.rest = rest
        return fn

    found = map_rows(index.documents.select("key", "n", "sketch"), make, "item int, key bigint, bound bigint")
    return first_of(found, first, [F.desc("bound"), "key"])


def first_of(rows: DataFrame, k: int, order: list) -> DataFrame:
    """The first ``k`` rows of each item, in two steps, so that one item's rows of all tasks don't meet in one."""
    for by in (["item", "_salt"], ["item"]):
        rows = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))) if len(by) > 1 else rows
        rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rank") <= k)
    return rows.drop("_salt")


def contenders(index: Index, block: Block, least: np.ndarray, k: int) -> DataFrame:
    """(item, key, bound): all documents whose bound reaches the item's threshold; of equal texts in a batch the k least ids."""

    def make():
        def fn(cols):
            out, copies = ([], [], []), {}
            order = sorted(range(len(cols[0])), key=lambda r: (cols[3][r] is None, cols[3][r]))
            for r in order:
                if (seen := copies.get(cols[4][r], 0)) >= k:
                    continue
                bounds = block.bounds(cols[2][r], cols[1][r])
                items = np.flatnonzero(bounds >= least)
                if len(items):
                    copies[cols[4][r]] = seen + 1
                    out[0].extend(items.tolist())
                    out[1].extend([cols[0][r]] * len(items))
                    out[2].extend(bounds[items].tolist())
            return list(out)

        return fn

    return map_rows(index.documents.select("key", "n", "sketch", "doc_id", "digest"), make, "item int, key bigint, bound bigint")


def rescored(documents: DataFrame, pairs: DataFrame, block: Block, k: int, few: bool) -> DataFrame:
    """(item, doc_id, key, score): the k best exact scores above 0 for each item among the pairs (item, key, bound).
    ``few`` pairs, as many as the block's items times a constant at most, are broadcast; others are a written table.

    A document's text is read once for all its items, in descending bounds; an item is skipped where its bound is below the
    k-th score that the task has found.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make():
        best: dict[int, list] = {}

        def fn(cols):
            for i, key, text, own in zip(*cols):
                open_ = [p["item"] for p in own if len(b := best.get(p["item"], ())) < k or p["bound"] >= b[-1][0]]
                if not open_:
                    continue
                all_terms = terms(text)
                if not all_terms:
                    continue
                for item, score in zip(open_, block.scores(Counter(all_terms), len(all_terms), open_)):
                    if score:
                        b = best.setdefault(item, [])
                        b.append((score, i, key))
                        b.sort(key=lambda x: (-x[0], x[1] is None, x[1], x[2]))
                        del b[k:]
            return []

        def rest():
            rows = [(item, i, key, score) for item, b in best.items() for score, i, key in b]
            return [[r[c] for r in rows] for c in range(4)]

        fn.rest = rest
        return fn

    wanted = pairs.groupBy("key").agg(
        F.collect_set(F.struct("item", "bound")).alias("own"), F.max("bound").alias("most")
    )  # a key's rows have equal bounds, so at most as many as the block has items
    wanted = F.broadcast(wanted) if few else wanted
    texts = documents.select("doc_id", row_key().alias("key"), "text").join(wanted, "key")
    texts = texts.sortWithinPartitions(F.desc("most")).select("doc_id", "key", "text", "own")
    found = map_rows(texts, make, f"item int, doc_id {kind}, key bigint, score bigint")
    return first_of(found, k, [F.desc("score"), F.col("doc_id").asc_nulls_last(), "key"])


def thresholds(found: DataFrame, block: Block, k: int) -> np.ndarray:
    """The k-th best score of every item, 1 where there are fewer."""
    out = np.ones(len(block.items), np.int64)
    for r in found.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k).collect():
        out[r["item"]] = r["least"]
    return out


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = documents.sparkSession
    id_kind, doc_kind = items.schema["item_id"].dataType.simpleString(), documents.schema["doc_id"].dataType.simpleString()
    schema = f"item_id {id_kind}, rank int, doc_id {doc_kind}, score bigint"
    index = build(documents)
    path = scratch(spark, "lexical-results")
    spark.createDataFrame([], schema).write.parquet(path)
    for block in blocks(items, index):
        least = np.ones(len(block.items), np.int64)
        for first in (FIRST, SECOND):
            found = rescored(documents, leaders(index, block, first, least), block, k, few=True)
            least = np.maximum(least, thresholds(found, block, k))
        pairs = contenders(index, block, least, k)
        best = rescored(documents, pairs, block, k, few=False)
        names = spark.createDataFrame(list(enumerate(block.items)), f"item int, item_id {id_kind}")
        out = best.join(F.broadcast(names), "item")  # as many rows as the block has items
        out.select("item_id", F.col("_rank").cast("int").alias("rank"), "doc_id", "score").write.mode("append").parquet(path)
    removed(index.table)
    return spark.read.schema(schema).parquet(path)


#: The rows of ``search`` over ``documents`` and ``benchmark``, in DuckDB's SQL.
ORACLE = r"""
with t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), c as (
  select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_terms from t where len(w) > 0
), i as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), d as (
  select doc_id, n, term, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from t) group by 1, 2, 3
), df as (
  select term, count(*) as df from d group by 1
), s as (
  select i.item_id, d.doc_id, cast(sum(
    cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df.df + 1)::double)) as bigint)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) as bigint) as score
  from i join d on i.term = d.term join df on df.term = d.term cross join c group by 1, 2
), r as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from r where rank <= 10
"""
