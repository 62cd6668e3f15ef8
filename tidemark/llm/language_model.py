"""Language-model scoring (operator 6): a hierarchical Pitman-Yor model with Gibbs-sampled seating.

The word before is the context: every word has a restaurant of its own. The totals of the most frequent words, at most ``CONTEXTS``,
are known to every task; those of rarer words are added up in parts of the word's hash
after each sweep and told to the pieces that meet the word. Rows on their way name known words by number, others by hash. All restaurants share
one parent, whose base spreads evenly over the V known words and one unknown word. A sweep seats each
restaurant's customers of a word anew, given the tables of the sweep before: up to ``SINGLY`` customers are seated one after
another, where the waiting time to the next new table is drawn at once (beta-geometric); the rest in blocks, by binomial draws. Tables send customers to the parent. Restaurants' totals are those of the last sweep while one runs. The
score averages the predictive probabilities of the sweeps after the first ones.

The model is the table of counts of (word, context), which grows with the corpus, in pieces of the word's hash. The cells of words with
at least 1 / ``HEAD`` of the tokens (at most ``HEAD`` words) are spread over all pieces by the hash of word and context, so no piece holds
a frequent word; the parent's part of these words is known to every task. A piece also lists the rarer contexts that its cells have,
and those that held-out texts will ask it for. Pairs with at least 1 / ``PAIRS`` of the tokens are scored where the texts are read; all others meet the texts in their piece.

Null texts count as empty and have one token, the end. Rows of equal id and text get equal scores. Rows with a null id are
training rows. An empty table gives an empty table. Without training rows every token is unknown and has probability 1.
Only doc_id and text are read, so others may have any name. Texts are read whole. Words are told apart by 64 bits of a hash,
rarer contexts by 63.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, map_rows, release, removed, ship, written

ship(__name__)

FOLDS, FOLD = 5, 1
#: Bounds of what every task knows: contexts, frequent words, frequent pairs.
CONTEXTS = 1 << 18
HEAD, PAIRS = 16_384, 1 << 20
#: Gibbs sweeps, and the first ones that aren't averaged.
SWEEPS, BURN = 4, 1
CONCENTRATION = 1.0
#: Customers of a cell that are seated one after another.
SINGLY = 256
#: Bytes of rows that go to a Python worker at once: rows of counts are large, and a task reads many.
BATCH_BYTES = 4 << 20
#: For tables of large rows: a page ends after any row, and no codec that holds whole pages outside the heap.
WRITING = {"parquet.page.size.row.check.min": "1", "spark.sql.parquet.compression.codec": "zstd"}
#: Documents of a shard, about, and the pieces in which a shard's counts are kept, so that no row is large.
SHARD_ROWS = 4_096
PIECES = 4
LEAST_SHARDS = 16
#: Characters and documents gathered by a task before they are sent on.
GATHERED, GATHERED_DOCS = 2_500_000, 60_000
END = b" end"  # no word holds a space
_X = np.uint64(32)  # bits below the word's number in a cell's key
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A context is a number if every task knows it, else the word's hash with this bit; in a row, the place in the row's list of these.
RARE, LISTED = np.uint64(1 << 63), 1 << 31


def pack(keys: np.ndarray) -> bytes:
    """Keys as differences, byte plane by byte plane, which compresses well where they are sorted."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


def planes(numbers: np.ndarray) -> bytes:
    numbers = np.ascontiguousarray(numbers)
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def squeezed(data: bytes) -> bytes:
    """A frame: its size, the size of ``data``, and ``data`` compressed."""
    body = pa.compress(data, "zstd", asbytes=True)
    return np.array([len(body), len(data)], "<i8").tobytes() + body


def frames(data: bytes) -> list[bytes]:
    """What was squeezed into each of the frames that ``data`` consists of."""
    out, at = [], 0
    while at < len(data):
        size, whole = map(int, np.frombuffer(data, "<i8", 2, at))
        out.append(pa.decompress(memoryview(data)[at + 16 : at + 16 + size], whole, "zstd", asbytes=True) if whole else b"")
        at += 16 + size
    return out


def shards_for(rows: int) -> int:
    return max(LEAST_SHARDS, 1 << max(0, (rows // SHARD_ROWS)).bit_length())


def bounds(parts: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` parts begins in sorted part numbers, and the end."""
    return np.searchsorted(parts, np.arange(count + 1))


def place(sorted_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted array, -1 where it isn't there."""
    if not len(sorted_):
        return np.full(len(keys), -1)
    order = np.argsort(keys) if len(sorted_) > BLOCK else slice(None)  # much faster in a large array
    out, keys = np.empty(len(keys), np.int64), keys[order]
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    out[order] = np.where(sorted_[at] == keys, at, -1)
    return out


def joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Numbers below 2^32 as the halves of one key."""
    keys = high.astype(np.uint64)
    keys <<= _X
    keys |= low.astype(np.uint64, copy=False)
    return keys


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, each key's number among them), as np.unique gives them, with 32-bit numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys[new], number


def pair(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """A hash of word and context."""
    h = (words ^ (contexts.astype(np.uint64) + np.uint64(1)) * _ODD) * _ODD
    return h ^ h >> np.uint64(29)


def pack_words(words: np.ndarray, known: np.ndarray) -> bytes:
    """Words of cells, neighbours that are equal once: the numbers of known ones (sorted hashes), the hashes of others."""
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1])[: len(words)])
    runs = words[first]
    at = place(known, runs)
    own = at >= 0
    head = np.array([len(runs), own.sum()], "<i8").tobytes() + np.packbits(own).tobytes()
    numbers = planes(np.diff(at[own].astype("<u4"), prepend=np.uint32(0)))
    return squeezed(head + planes(np.diff(np.append(first, len(words))).astype("<u4")) + numbers + pack(runs[~own]))


def unpack_words(data: bytes, known: np.ndarray) -> np.ndarray:
    data = frames(data)[0]
    n, m = map(int, np.frombuffer(data, "<i8", 2))
    edge = np.cumsum([16, (n + 7) // 8, 4 * n, 4 * m])
    own = np.unpackbits(np.frombuffer(data[edge[0] : edge[1]], np.uint8), count=n).astype(bool)
    runs = np.empty(n, np.uint64)
    runs[own] = known[np.cumsum(unplanes(data[edge[2] : edge[3]], "<u4"), dtype=np.uint32)] if m else 0
    runs[~own] = unpack(data[edge[3] :])
    return np.repeat(runs, unplanes(data[edge[1] : edge[2]], "<u4"))


def pack_contexts(ids: np.ndarray, more: np.ndarray | None = None) -> bytes:
    """Contexts of cells, and a list of the rarer ones (with ``more``, that no cell needs to have)."""
    rarer = ids >= RARE
    listed = np.unique(ids[rarer] if more is None else np.concatenate([ids[rarer], more]))
    numbers = ids.astype("<u4")
    numbers[rarer] = LISTED + np.searchsorted(listed, ids[rarer])
    return squeezed(np.array([len(numbers), len(listed)], "<i8").tobytes() + planes(numbers) + pack(listed))


def unpack_contexts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the cells' contexts, the list of the rarer ones, what has been told of them: customers, then tables of each sweep)."""
    data, *told = frames(data)
    n, m = map(int, np.frombuffer(data, "<i8", 2))
    at = 16 + 4 * n
    told = np.frombuffer(b"".join(told), "<u4").reshape(-1, m) if m else np.empty((0, 0), "<u4")
    return unplanes(data[16:at], "<u4"), unpack(data[at:]), told


def unlisted(numbers: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The contexts that ``pack_contexts`` was given."""
    ids, rarer = numbers.astype(np.uint64), numbers >= LISTED
    ids[rarer] = listed[numbers[rarer] - LISTED]
    return ids


class Gathered:
    """Texts, and in order of the words' hashes their tokens once they are drained."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.texts, self.size = [], 0

    def add(self, text: str | None) -> bool:
        """Whether enough is gathered."""
        self.texts.append(text or "")
        self.size += len(self.texts[-1])
        return self.size >= GATHERED or len(self.texts) >= GATHERED_DOCS

    def drain(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sorted hashes, each token's number, the number of the word before it, tokens of each text)."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(self.texts, pa.large_string())))
        self.clear()  # before more is made
        words, offsets = split.values, np.asarray(split.offsets)
        full = np.asarray(pc.greater(pc.binary_length(words), 0))  # around a text's words there are empty ones
        lengths = np.diff(np.append(0, np.cumsum(full))[offsets]) + 1  # with the end
        coded = words.filter(pa.array(full)).dictionary_encode()
        del split, words
        _, edge, data = coded.dictionary.buffers()
        edge, data = np.frombuffer(edge, "<i8")[: len(coded.dictionary) + 1].tolist(), data.to_pybytes() if data else b""
        hashes = [xxhash.xxh64_intdigest(END), *[xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(edge, edge[1:])]]
        hashes, number = np.unique(np.array(hashes, np.uint64), return_inverse=True)
        number = number.astype(np.int32)
        at = np.zeros(lengths.sum(), np.int32)
        token = np.ones(len(at), bool)
        token[np.cumsum(lengths) - 1] = False
        at[token] = np.asarray(coded.indices) + 1
        at = number[at]
        before = np.roll(at, 1)
        before[np.cumsum(lengths) - lengths] = number[0]
        return hashes, at, before, lengths


def gathering(make_rows, text_column: int, gather_row=None):
    """A function for ``map_rows``: texts are gathered, and ``make_rows(*drained)`` gives the columns to send on."""

    def make():
        texts = Gathered()

        def drain():
            return make_rows(*texts.drain()) if texts.texts else []

        def fn(cols):
            out = []
            for row in zip(*cols):
                if gather_row:
                    gather_row(row)
                if texts.add(row[text_column]):
                    out.append(drain())
            return out[0] if len(out) == 1 else [[x for o in out for x in o[i]] for i in range(len(out[0]))] if out else []

        fn.rest = drain
        return fn

    return make


class Totals:
    """What every task knows: contexts, frequent words, the vocabulary, discounts, and the tables of each sweep."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, vocabulary: int):
        self.words, self.tokens, self.vocabulary = words, tokens, vocabulary  # the words of the contexts that all tasks know, sorted
        self.count = counts.astype(np.float64)  # their customers
        frequent = counts >= max(tokens / HEAD, 1)
        self.head, self.head_count = words[frequent], counts[frequent].astype(np.int64)
        self.discount = self.discount0 = 0.5
        self.tables: list[np.ndarray] = []  # of each sweep: tables by context
        self.tables0: list[float] = []  # of each sweep: tables of the parent
        self.customers: list[float] = []  # of each sweep: customers of the parent
        self.head_customers: list[np.ndarray] = []  # of each sweep: the parent's customers of the frequent words
        self.head_tables0: list[np.ndarray] = []

    @property
    def base(self) -> float:
        return 1.0 / (self.vocabulary + 1)

    def contexts(self, hashes: np.ndarray) -> np.ndarray:
        """The restaurant of the followers of each word."""
        own = place(self.words, hashes)
        return np.where(own >= 0, own.astype(np.uint64), hashes | RARE)

    def route(self, words: np.ndarray, contexts: np.ndarray, parts: int) -> np.ndarray:
        """Which of ``parts`` (a power of two) holds the cell."""
        r = np.where(place(self.head, words) >= 0, pair(words, contexts), words)
        return (r >> np.uint64(64 - parts.bit_length() + 1)).astype(np.int64) if parts > 1 else np.zeros(len(r), np.int64)

    def parent(self, sweep: int, customers, tables):
        """The parent's probability of words with so many customers and tables."""
        fresh = (CONCENTRATION + self.discount0 * self.tables0[sweep]) * self.base
        return (customers - self.discount0 * tables + fresh) / (CONCENTRATION + self.customers[sweep])

    def head_parent(self, sweep: int) -> np.ndarray:
        return self.parent(sweep, self.head_customers[sweep], self.head_tables0[sweep])

    def weight0(self, sweep: int) -> float:
        """The weight of a new table in the parent."""
        return (CONCENTRATION + self.discount0 * self.tables0[sweep]) * self.base

    def close(self, tables: np.ndarray, head_customers: np.ndarray, tail_tables0: float, rarer_tables: float) -> None:
        """End a sweep; the frequent words, whose customers come from all pieces, are seated in the parent here."""
        sweep = len(self.tables)
        head_tables0 = (head_customers > 0).astype(np.int64)
        if sweep and len(self.head):
            rng = np.random.default_rng([1 << 31, sweep])
            head_tables0 = seat(head_customers, np.full(len(self.head), self.weight0(sweep - 1)), self.discount0, rng)
        self.tables.append(tables)
        self.customers.append(float(tables.sum() + rarer_tables))
        self.head_customers.append(head_customers)
        self.head_tables0.append(head_tables0)
        self.tables0.append(float(tail_tables0 + head_tables0.sum()))


def step(counts: np.ndarray) -> np.ndarray:
    """Counts rounded down to their first 8 bits, so that there are few steps (some thousands)."""
    low = np.maximum(np.frexp(counts.astype(np.float64))[1].astype(np.int64) - 8, 0)
    return counts >> low << low


def words_of(documents: DataFrame) -> Totals:
    """The totals before the first sweep, from the counts of all training tokens, which are written in pieces of the word's hash."""
    pieces = 16 * LEAST_SHARDS

    def rows(hashes, at, before, lengths):
        counts = np.bincount(at, minlength=len(hashes)).astype("<i8")
        edge = bounds((hashes >> np.uint64(64 - pieces.bit_length() + 1)).astype(np.int64), pieces)
        own = [i for i in range(pieces) if edge[i] < edge[i + 1]]
        cut = [slice(edge[i], edge[i + 1]) for i in own]
        return [own, [squeezed(pack(hashes[c])) for c in cut], [squeezed(planes(counts[c])) for c in cut]]

    def merge(table: pa.Table) -> pa.Table:
        words, at = np.unique(np.concatenate([unpack(*frames(x.as_py())) for x in table["words"]]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([unplanes(*frames(x.as_py()), "<i8") for x in table["counts"]]), len(words)).astype("<i8")
        words, counts = words[counts > 0], counts[counts > 0]
        row = [len(words), int(counts.sum())], [squeezed(pack(words))], [squeezed(planes(counts))]
        return pa.table([[row[0][0]], [row[0][1]], row[1], row[2]], names=["v", "n", "words", "counts"])

    parts = map_rows(documents.select("text"), gathering(rows, 0), "piece int, words binary, counts binary")
    merged = parts.groupBy("piece").applyInArrow(merge, "v bigint, n bigint, words binary, counts binary")
    table = written(merged, "words")
    all_ = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("v"), F.lit(0)).alias("words")).first()

    def steps():
        def fn(cols):
            low, n = np.unique(np.concatenate([step(unplanes(*frames(x), "<i8")) for x in cols[0]]), return_counts=True)
            return [low.tolist(), n.tolist()]

        return fn

    # the least count of a known word: words with as much or more are CONTEXTS at most, as are those with 1 / CONTEXTS of the tokens
    found = map_rows(table.select("counts"), steps, "low bigint, n bigint").groupBy("low").agg(F.sum("n").alias("n")).orderBy(F.desc("low")).collect()
    above, least = 0, max(all_.tokens / CONTEXTS, 1)
    for r in found:
        above += r.n
        if above > CONTEXTS:
            break
        least = min(least, r.low)

    def make():
        def fn(cols):
            own, n = [], []
            for a, b in zip(*cols):
                words, counts = unpack(*frames(a)), unplanes(*frames(b), "<i8")
                frequent = counts >= least
                own += words[frequent].view(np.int64).tolist()
                n += counts[frequent].tolist()
            return [own, n]

        return fn

    found = map_rows(table.select("words", "counts"), make, "word bigint, n bigint").toArrow()  # at most CONTEXTS rows
    removed(table)
    keys, n = np.asarray(found["word"], np.int64).view(np.uint64), np.asarray(found["n"], np.int64)
    order = np.argsort(keys)
    return Totals(keys[order], n[order], all_.tokens, all_.words)


def cells(documents: DataFrame, totals: Totals, shards: int) -> DataFrame:
    """(shard, piece, words, contexts, counts): the training counts of (word, context), written; ``PIECES`` rows a shard.

    ``documents`` has text and train. Cells of held-out texts with a rarer context count 0 until they are merged, so that their piece
    lists the context."""
    pieces = shards * PIECES
    sent = documents.sparkSession.sparkContext.broadcast(totals)

    def make():
        train = []

        def rows(hashes, at, before, lengths):
            t = sent.value
            contexts = t.contexts(hashes)
            own = np.repeat(np.array(train, bool), lengths)
            train.clear()
            keys, counts = np.unique(joined(at[own], before[own]), return_counts=True)
            asked = ~own & (contexts >= RARE)[before]
            asked = np.unique(joined(at[asked], before[asked]))
            keys = np.concatenate([keys, asked])
            counts = np.concatenate([counts.astype("<u4"), np.zeros(len(asked), "<u4")])
            words, contexts = hashes[(keys >> _X).astype(np.int64)], contexts[keys.astype(np.uint32)]
            part = t.route(words, contexts, pieces)
            order = np.argsort(part.astype(np.uint16 if pieces <= 1 << 16 else np.uint32), kind="stable")
            words, contexts, counts = words[order], contexts[order], counts[order]
            edge = bounds(part[order], pieces)
            own = [i for i in range(pieces) if edge[i] < edge[i + 1]]
            cut = [slice(edge[i], edge[i + 1]) for i in own]
            return [own, [pack_words(words[c], t.words) for c in cut], [pack_contexts(contexts[c]) for c in cut], [squeezed(planes(counts[c])) for c in cut]]

        return gathering(rows, 0, lambda row: train.append(row[1]))()

    parts = map_rows(documents.select("text", "train"), make, "piece int, words binary, contexts binary, counts binary")
    schema = pa.schema([("shard", pa.int32()), ("piece", pa.int32())] + [(n, pa.binary()) for n in ("words", "contexts", "counts")])

    def merge(table: pa.Table) -> pa.Table:
        words, number = np.unique(np.concatenate([unpack_words(x.as_py(), sent.value.words) for x in table["words"]]), return_inverse=True)
        contexts = np.concatenate([unlisted(*unpack_contexts(x.as_py())[:2]) for x in table["contexts"]])
        counts = np.concatenate([unplanes(*frames(x.as_py()), np.uint32) for x in table["counts"]])
        ids, context = np.unique(contexts, return_inverse=True)
        keys, at = np.unique(joined(number, context), return_inverse=True)
        total = np.bincount(at, counts, len(keys)).astype("<i8")
        keys, total = keys[total > 0], total[total > 0]
        piece = table["piece"][0].as_py()
        words = pack_words(words[(keys >> _X).astype(np.int64)], sent.value.words)
        columns = [words, pack_contexts(ids[keys.astype(np.uint32)], ids[ids >= RARE]), squeezed(planes(total))]
        return pa.table([[piece // PIECES], [piece], *[[c] for c in columns]], schema=schema)

    merged = parts.groupBy("piece").applyInArrow(merge, "shard int, piece int, words binary, contexts binary, counts binary")
    table = written(merged, "cells")
    sent.destroy()
    return table


def seat(customers: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``customers`` (1 or more) where a new table has the weight ``new``.

    Beyond ``SINGLY`` customers, blocks of a 16th of the seated ones are seated at once, with the tables at the block's start."""
    tables = np.ones(len(customers), np.int64)
    live = np.flatnonzero(customers > 1)
    seated = np.ones(len(live))
    stop = np.minimum(customers, SINGLY)
    while len(live):
        q = np.clip(rng.beta(new[live], np.maximum(seated - discount * tables[live], 1e-9)), 1e-300, 1 - 1e-16)
        wait = np.ceil(np.log(rng.random(len(live)) + 1e-300) / np.log1p(-q))
        seated = seated + np.maximum(wait, 1)
        on = seated <= stop[live]
        live, seated = live[on], seated[on]
        tables[live] += 1
    live = np.flatnonzero(customers > SINGLY)
    seated = np.full(len(live), SINGLY)
    while len(live):
        block = np.minimum(seated // 16, customers[live] - seated).astype(np.int64)
        tables[live] += rng.binomial(block, new[live] / (new[live] + seated + block / 2 - discount * tables[live]))
        seated = seated + block
        on = seated < customers[live]
        live, seated = live[on], seated[on]
    return tables


class Piece:
    """The restaurants' part for the cells of one piece. A word that isn't frequent has all its cells here."""

    def __init__(
        self, totals: Totals, piece: int, words: np.ndarray, contexts: np.ndarray, counts: np.ndarray,
        listed: np.ndarray = np.empty(0, np.uint64), told: np.ndarray = np.empty((0, 0), np.uint32), seated: list[bytes] = [],
    ):
        self.totals, self.piece, self.counts = totals, piece, counts
        self.listed, self.told = listed, told  # the rarer contexts; their customers, and tables of each sweep
        self.classes = contexts.astype(np.int64)
        new = np.append(True, words[1:] != words[:-1])[: len(words)]  # cells are sorted by word
        first, self.word = np.flatnonzero(new), np.cumsum(new) - 1
        self.words = words[first]
        self.keys = self.word.astype(np.uint64) << _X | contexts.astype(np.uint64)
        self.contexts = np.diff(np.append(first, len(words)))
        self.word_counts = np.bincount(self.word, counts, len(self.words)).astype(np.int64)
        self.frequent = place(totals.head, self.words)
        self.tail = self.frequent < 0
        # a count of one has one table in every sweep; ``multi`` are the cells with more
        self.multi = np.flatnonzero(counts > 1)
        self.singles = self.contexts - np.bincount(self.word[self.multi], minlength=len(self.words))
        # the tables of earlier sweeps
        self.seated = [np.split(unplanes(x, "<u4").astype(np.int64), [len(self.multi)]) for x in seated]

    def number(self, contexts: np.ndarray) -> np.ndarray:
        """The numbers by which this piece knows contexts."""
        numbers, rarer = contexts.astype(np.int64), contexts >= RARE
        at = place(self.listed, contexts[rarer])
        if (at < 0).any():
            raise ValueError("a text holds a context that its piece doesn't list: the texts have changed since they were counted")
        numbers[rarer] = LISTED + at
        return numbers

    def known(self, row: int, contexts: np.ndarray) -> np.ndarray:
        """Row 0: customers, row 1 + s: tables after sweep s, by the contexts' numbers."""
        own = self.totals.tables[row - 1] if row else self.totals.count
        if not len(self.listed):
            return own[contexts]
        out, rarer = np.empty(len(contexts)), contexts >= LISTED
        out[~rarer] = own[contexts[~rarer]]
        out[rarer] = self.told[row][contexts[rarer] - LISTED]
        return out

    def share(self, sweep: int, contexts: np.ndarray) -> np.ndarray:
        """The probability that contexts pass on to the parent."""
        return (CONCENTRATION + self.totals.discount * self.known(1 + sweep, contexts)) / (CONCENTRATION + self.known(0, contexts))

    def parents(self, sweep: int, customers: np.ndarray, tables0: np.ndarray) -> np.ndarray:
        """The parent's probability of this piece's words."""
        p = self.totals.parent(sweep, customers, tables0)
        p[~self.tail] = self.totals.head_parent(sweep)[self.frequent[~self.tail]]
        return p

    def chain(self, sweeps: int):
        """Yields (tables of ``multi``, customers sent to the parent from here, parent's tables) of the sweeps 0 (one table for each
        count) to ``sweeps``; the parent's tables hold for words that aren't frequent.

        Sweeps whose tables came with the piece aren't seated anew. Numbers are drawn from a seed of piece and sweep, so any task
        repeats the same chain."""
        t, multi = self.totals, self.multi
        word, counts, contexts = self.word[multi], self.counts[multi], self.classes[multi]
        several = np.flatnonzero(self.tail & (self.contexts + self.word_counts > 2))  # others have one customer
        tables, customers, tables0 = np.ones(len(multi), np.int64), self.contexts, np.ones(len(self.words), np.int64)
        yield tables, customers, tables0
        for s in range(1, sweeps + 1):
            if s <= len(self.seated):
                tables, tables0 = self.seated[s - 1]
                customers = self.singles + np.bincount(word, tables, len(self.words)).astype(np.int64)
                yield tables, customers, tables0
                continue
            rng = np.random.default_rng([self.piece, s])
            weight = (CONCENTRATION + t.discount * self.known(s, contexts)) * self.parents(s - 1, customers, tables0)[word]
            tables = seat(counts, weight, t.discount, rng)
            customers = self.singles + np.bincount(word, tables, len(self.words)).astype(np.int64)
            tables0 = np.ones(len(self.words), np.int64)
            tables0[several] = seat(customers[several], np.full(len(several), t.weight0(s - 1)), t.discount0, rng)
            yield tables, customers, tables0

    def sums(self, sweep: int) -> tuple[np.ndarray, list[np.ndarray], bytes]:
        """After a sweep: (tables by context that all tasks know, customers of the frequent words, parent's tables of the others,
        tables of the rarer contexts), by rarer context customers (before the first sweep only) and tables, and the sweep's seating."""
        *_, (tables, customers, tables0) = self.chain(sweep)
        t, k = self.totals, len(self.totals.count)
        head = np.bincount(self.frequent[~self.tail], customers[~self.tail], len(t.head))
        # the rarer contexts' places follow those that all tasks know
        at = np.where(self.classes >= LISTED, self.classes - LISTED + k, self.classes)
        by_context = np.bincount(at, minlength=k + len(self.listed)).astype(np.float64)
        by_context += np.bincount(at[self.multi], tables - 1, len(by_context))
        rarer = [by_context[k:]] if sweep else [np.bincount(at, self.counts, len(by_context))[k:], by_context[k:]]
        seated = squeezed(planes(np.concatenate([tables, tables0]).astype("<u4"))) if sweep else b""
        return np.concatenate([by_context[:k], head, [tables0[self.tail].sum(), by_context[k:].sum()]]), rarer, seated

    def ones(self) -> np.ndarray:
        """What discounts are taken from: counts of one and two, and words (that aren't frequent) with one and two contexts."""
        own = self.contexts[self.tail]
        return np.array([(self.counts == 1).sum(), (self.counts == 2).sum(), (own == 1).sum(), (own == 2).sum()], np.float64)

    def averaged(self) -> tuple[np.ndarray, np.ndarray]:
        """(the counts less the discounts of the averaged sweeps' tables, the parent's probabilities: sweep by word)."""
        kept, parents = self.counts - self.totals.discount, []
        for s, (tables, customers, tables0) in enumerate(self.chain(SWEEPS)):
            if s > BURN:
                kept[self.multi] -= self.totals.discount * (tables - 1) / (SWEEPS - BURN)
                parents.append(self.parents(s, customers, tables0))
        return kept, np.array(parents)

    def logs(self, words: np.ndarray, contexts: np.ndarray, ready) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of the predictive probability, training count of the word) for any cells of this piece, by the contexts' numbers."""
        t, (kept, parents) = self.totals, ready
        sweeps, contexts = range(BURN + 1, SWEEPS + 1), contexts.astype(np.int64)
        count, own = np.zeros(len(words), np.int64), np.zeros(len(words))
        at, head = place(self.words, words), place(t.head, words)
        here, frequent = at >= 0, head >= 0
        count[here] = self.word_counts[at[here]]
        count[frequent] = t.head_count[head[frequent]]
        passed = np.zeros(len(words))
        for i, s in enumerate(sweeps):
            p = np.full(len(words), float(t.parent(s, 0.0, 0.0)))
            p[here] = parents[i][at[here]]
            p[frequent] = t.head_parent(s)[head[frequent]]
            passed += self.share(s, contexts) * p / len(sweeps)
        cell = place(self.keys, at[here].astype(np.uint64) << _X | contexts[here].astype(np.uint64))
        own[here] = np.where(cell >= 0, kept[cell], 0.0) if len(kept) else 0.0
        return np.log10(own / (CONCENTRATION + self.known(0, contexts)) + passed), count


def piece_of(totals: Totals, piece: int, words: bytes, contexts: bytes, counts: bytes) -> Piece:
    numbers, listed, told = unpack_contexts(contexts)
    counts, *seated = frames(counts)  # the seatings of earlier sweeps follow
    return Piece(totals, piece, unpack_words(words, totals.words), numbers, unplanes(counts, "<i8"), listed, told, seated)


_ROW = ("piece", "words", "contexts", "counts")
#: Numbers of a vector that are a row on their way to the sum.
BLOCK = 16_384


def _swept(rows: DataFrame, totals: Totals, vectors, size: int, shards: int, sweep: int) -> tuple[np.ndarray, DataFrame]:
    """The sum over all pieces of the ``size`` numbers that ``vectors(piece)`` gives first (a task sends one sum), and what the pieces are
    told of their rarer contexts, written: (row, part, piece, value), the sums of what it gives second; what it gives third is part -1."""
    sent = rows.sparkSession.sparkContext.broadcast(totals)

    def make():
        total = np.zeros(size)

        def fn(cols):
            out = [[], [], [], [], [], []]
            for row in zip(*cols):
                p = piece_of(sent.value, *row)
                sums, rarer, seated = vectors(p)
                total[:] += sums
                if seated:
                    for x, v in zip(out, (0, -1, p.piece, 0, None, seated)):
                        x.append(v)
                edge = bounds((p.listed << np.uint64(1) >> np.uint64(65 - shards.bit_length())).astype(np.int64), shards)
                for i in np.flatnonzero(np.diff(edge)):
                    c = slice(edge[i], edge[i + 1])
                    for x, v in zip(out, (0, int(i), p.piece, len(rarer), pack(p.listed[c]), np.array([v[c] for v in rarer], "<u4").tobytes())):
                        x.append(v)
            return out

        def rest():
            start = list(range(0, size, BLOCK))
            none = [None] * len(start)
            return [start, none, none, none, none, [squeezed(planes(total[i : i + BLOCK])) for i in start]]

        fn.rest = rest
        return fn

    def add(table: pa.Table) -> pa.Table:
        total = sum(unplanes(*frames(x.as_py()), "<f8") for x in table["value"])
        return pa.table([[table["start"][0].as_py()], [total.tobytes()]], schema=pa.schema([("start", pa.int64()), ("value", pa.binary())]))

    schema = pa.schema([("row", pa.int32()), ("part", pa.int32()), ("piece", pa.int32()), ("value", pa.binary())])

    def tell(table: pa.Table) -> pa.Table:
        ids = [unpack(x.as_py()) for x in table["ids"]]
        number = np.unique(np.concatenate(ids), return_inverse=True)[1]
        edge = np.cumsum([0, *map(len, ids)])
        values = [np.frombuffer(x.as_py(), "<u4").reshape(n.as_py(), -1) for x, n in zip(table["value"], table["n"])]
        sums = [np.bincount(number, v)[number].astype("<u4") for v in np.concatenate(values, axis=1)]
        first, part = sweep + 2 - len(sums), table["part"][0].as_py()
        out = [(first + r, part, p.as_py(), v[edge[i] : edge[i + 1]].tobytes()) for r, v in enumerate(sums) for i, p in enumerate(table["piece"])]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    sent_out = written(map_rows(rows.select(*_ROW), make, "start bigint, part int, piece int, n int, ids binary, value binary"), "sweep")
    kind = "start bigint, value binary"
    out = np.zeros(size)
    for r in sent_out.filter("part is null").select("start", "value").groupBy("start").applyInArrow(add, kind).collect():  # at most CONTEXTS + HEAD + 6 numbers
        out[r.start : r.start + BLOCK] = np.frombuffer(r.value)
    told = sent_out.filter("part >= 0").drop("start").groupBy("part").applyInArrow(tell, "row int, part int, piece int, value binary")
    told = written(told.unionAll(sent_out.filter("part < 0").select(F.lit(sweep).alias("row"), "part", "piece", "value")), "told")
    removed(sent_out)
    sent.destroy()
    return out, told


def _informed(table: DataFrame, told: list[DataFrame]) -> DataFrame:
    """The cells with what has been told of their rarer contexts behind ``contexts``, and the seatings of the sweeps behind ``counts``."""
    schema = pa.schema([("piece", pa.int32()), ("told", pa.binary()), ("seated", pa.binary())])

    def join(rows: pa.Table) -> pa.Table:
        part = np.asarray(rows["part"])
        order = np.lexsort([part, np.asarray(rows["row"])])
        told, seated = (b"".join(rows["value"][int(i)].as_py() for i in order[which]) for which in (part[order] >= 0, part[order] < 0))
        return pa.table([[rows["piece"][0].as_py()], [squeezed(told)], [seated]], schema=schema)

    all_ = told[0]
    for t in told[1:]:
        all_ = all_.unionAll(t)
    all_ = all_.groupBy("piece").applyInArrow(join, "piece int, told binary, seated binary")
    behind = [F.concat(c, F.coalesce(x, F.lit(b""))).alias(c) for c, x in (("contexts", "told"), ("counts", "seated"))]
    return table.join(all_, "piece", "left").select("shard", "piece", "words", *behind)


@contextlib.contextmanager
def _large_rows(spark):
    """``WRITING`` holds meanwhile."""
    before = {k: spark.conf.get(k, None) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def fit(documents: DataFrame, shards: int) -> tuple[DataFrame, Totals]:
    """The table of counts and the totals after all sweeps, from the training rows of ``documents``."""
    documents.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    with _large_rows(documents.sparkSession):
        return _fit(documents, shards)


def _fit(documents: DataFrame, shards: int) -> tuple[DataFrame, Totals]:
    spark = documents.sparkSession
    documents = documents.select("text", (~held_out(F.col("doc_id"), FOLDS, FOLD)).alias("train"))
    totals = words_of(documents.filter("train"))
    table = cells(documents, totals, shards)
    release(spark)
    k, h = len(totals.count), len(totals.head)

    def start(p: Piece):
        sums, *rest = p.sums(0)
        return np.concatenate([sums, p.ones()]), *rest

    first, told = _swept(table, totals, start, k + h + 6, shards, 0)
    one, two, one0, two0 = first[-4:]
    head = first[k : k + h]
    one0, two0 = one0 + (head == 1).sum(), two0 + (head == 2).sum()
    totals.discount = float(np.clip(one / max(one + 2 * two, 1), 0.05, 0.95))
    totals.discount0 = float(np.clip(one0 / max(one0 + 2 * two0, 1), 0.05, 0.95))
    totals.close(first[:k], head, *first[k + h : k + h + 2])
    told = [told]
    for sweep in range(1, SWEEPS + 1):
        found, more = _swept(_informed(table, told), totals, lambda p: p.sums(sweep), k + h + 2, shards, sweep)
        totals.close(found[:k], found[k : k + h], *found[-2:])
        told.append(more)
        release(spark)  # the shuffled cells
    model = written(_informed(table, told), "model")
    removed(table, *told)
    release(spark)
    return model, totals


def frequent_pairs(table: DataFrame, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted hashes, log10 probabilities, the words' training counts) of the cells with a share of 1 / PAIRS or more: at most PAIRS."""
    least = max(totals.tokens / PAIRS, 1)
    sent = table.sparkSession.sparkContext.broadcast(totals)

    def make():
        def fn(cols):
            keys, logs, counts = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
            for row in zip(*cols):
                p = piece_of(sent.value, *row)
                at = np.flatnonzero(p.counts >= least)
                if len(at):
                    words, contexts = p.words[p.word[at]], p.classes[at]
                    keys.append(pair(words, unlisted(contexts, p.listed)).view(np.int64))
                    for found, x in zip((logs, counts), p.logs(words, contexts, p.averaged())):
                        found.append(x)
            return [np.concatenate(keys), np.concatenate(logs), np.concatenate(counts)]

        return fn

    found = map_rows(table.select(*_ROW), make, "pair bigint, logs double, count bigint").toArrow()
    sent.destroy()
    keys = np.asarray(found["pair"], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.asarray(found["logs"], np.float64)[order], np.asarray(found["count"], np.int64)[order]


_ROWS = "shard int, flush bigint, words binary, contexts binary, per binary, at binary, times binary, docs binary, sums binary, ids binary"


def requests(documents: DataFrame, totals: Totals, frequent, shards: int) -> DataFrame:
    """What each shard gets of a flush, the texts that a task has gathered: the occurrences of pairs that aren't frequent (cells, documents of
    each, places in ``docs``, times), or with ``ids`` its documents' ids and sums over their frequent pairs (tokens, known, log10 of
    count + 0.5, log10 probability). ``docs`` are the numbers of documents in the flush."""
    sent = documents.sparkSession.sparkContext.broadcast((totals, *frequent))

    def make():
        ids, at_task = [], [TaskContext.get().partitionId(), 0]

        def rows(hashes, at, before, lengths):
            t, pairs, logs, counts = sent.value
            missing = np.array([i is None for i in ids])
            named = np.array([i or 0 for i in ids], "<i8").tobytes() + missing.tobytes()
            # of its place and what it holds, so that rows of different runs of a task never meet
            flush = int(np.uint64(xxhash.xxh64_intdigest(np.array(at_task, "<i8").tobytes() + named + hashes.tobytes() + at.tobytes())).view(np.int64))
            at_task[1] += 1
            keys, cell = numbered(joined(at, before))
            words, contexts = hashes[(keys >> _X).astype(np.int64)], t.contexts(hashes)[keys.astype(np.uint32)]
            known = place(pairs, pair(words, contexts))
            n = len(lengths)
            doc = np.repeat(np.arange(n, dtype=np.int32), lengths)
            common = (known >= 0)[cell]
            d, c = doc[common], cell[common]
            sums = np.zeros((n, 4))
            sums[:, 0] = lengths
            if len(d):
                sums[:, 1] = np.bincount(d, minlength=n)
                sums[:, 2] = np.bincount(d, np.log10(counts[known[c]] + 0.5), n)
                sums[:, 3] = np.bincount(d, logs[known[c]], n)
            out = [(flush % shards, flush, None, None, None, None, None, None, squeezed(planes(sums.ravel())), squeezed(named))]
            # the other cells in the order of their shards, and their documents
            rest = np.flatnonzero(known < 0)
            part = t.route(words[rest], contexts[rest], shards * PIECES)
            order = np.argsort(part, kind="stable")
            rest, part = rest[order], part[order]
            rank = np.zeros(len(keys), np.uint32)
            rank[rest] = np.arange(len(rest), dtype=np.uint32)
            found, times = np.unique(joined(rank[cell[~common]], doc[~common]), return_counts=True)
            del cell, doc, common, d, c, rank, at, before
            cell_of, doc_of = (found >> _X).astype(np.uint32), found.astype(np.uint32)
            times = times.astype("<u4")
            edge = bounds(part // PIECES, shards)
            cut = np.searchsorted(cell_of, edge)
            per = np.bincount(cell_of, minlength=len(rest)).astype("<u4")
            for i in range(shards):
                a, b, x, y = edge[i], edge[i + 1], cut[i], cut[i + 1]
                if a < b:
                    few, where = np.unique(doc_of[x:y], return_inverse=True)
                    out.append((
                        i, flush, pack_words(words[rest[a:b]], t.words), pack_contexts(contexts[rest[a:b]]), squeezed(planes(per[a:b])),
                        squeezed(planes(where.astype("<u2"))), squeezed(planes(times[x:y])), numbers(few), None, None,
                    ))
            ids.clear()
            return [list(c) for c in zip(*out)]

        return gathering(rows, 1, lambda row: ids.append(row[0]))()

    return map_rows(documents.select("doc_id", "text"), make, _ROWS)


def numbers(sorted_: np.ndarray) -> bytes:
    return squeezed(planes(np.diff(sorted_.astype("<u4"), prepend=np.uint32(0))))


def unnumbers(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(*frames(data), "<u4"))


def score(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shards = shards_for(docs.count())
    table, totals = fit(docs, shards)
    asked = requests(docs, totals, frequent_pairs(table, totals), shards)
    sent = docs.sparkSession.sparkContext.broadcast(totals)
    ddl = "flush bigint, shard int, docs binary, sums binary, ids binary"
    schema = pa.schema([("flush", pa.int64()), ("shard", pa.int32())] + [(n, pa.binary()) for n in ("docs", "sums", "ids")])

    def answer(have: pa.Table, want: pa.Table) -> pa.Table:
        out, tails, totals = [], [], sent.value
        shard = want["shard"][0].as_py() if want.num_rows else 0
        first = shard * PIECES
        for i in range(want.num_rows):
            row = {c: want[c][i].as_py() for c in want.column_names}
            if row["ids"] is not None:
                out.append((row["flush"], -1, None, row["sums"], row["ids"]))
                continue
            words, contexts = unpack_words(row["words"], totals.words), unlisted(*unpack_contexts(row["contexts"])[:2])
            per, at, times = (unplanes(*frames(row[c]), kind) for c, kind in (("per", "<u4"), ("at", "<u2"), ("times", "<u4")))
            # where the cells of each piece begin, and their places
            cut = np.searchsorted(totals.route(words, contexts, shards * PIECES), np.arange(first, first + PIECES + 1))
            start = np.append(0, np.cumsum(per, dtype=np.int64))[cut]
            count = len(unnumbers(row["docs"]))
            tails.append((row["flush"], row["docs"], words, contexts, per, cut, start, at, times, np.zeros((3, count))))
        # the pieces one after another, each with the cells asked for
        known = {have["piece"][i].as_py(): i for i in range(have.num_rows)}
        for piece in range(first, first + PIECES):
            if piece in known:
                p = piece_of(totals, *(have[c][known[piece]].as_py() for c in _ROW))
            else:
                p = Piece(totals, piece, np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64))
            cut = [slice(*t[5][piece - first : piece - first + 2]) for t in tails]
            edge = np.cumsum([0, *(c.stop - c.start for c in cut)])
            if not edge[-1]:
                continue
            words, contexts = (np.concatenate([t[i][c] for t, c in zip(tails, cut)]) for i in (2, 3))
            logs, count = p.logs(words, p.number(contexts), p.averaged())
            values = (count > 0).astype(np.float64), np.log10(count + 0.5), logs
            for (_, _, _, _, per, _, start, at, times, sums), c, a, b in zip(tails, cut, edge, edge[1:]):
                x, y = start[piece - first : piece - first + 2]
                for total, v in zip(sums, values):
                    total += np.bincount(at[x:y], np.repeat(v[a:b], per[c]) * times[x:y], len(total))
        out += [(flush, shard, docs, squeezed(planes(sums.ravel())), None) for flush, docs, *_, sums in tails]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table()

    last = pa.schema([("doc_id", pa.int64())] + [(n, pa.float64()) for n in ("n_tokens", "n_known", "base", "score")])

    def add(rows: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(rows["shard"]))  # equal texts are summed in the same order
        own = int(order[0])
        if rows["ids"][own].as_py() is None:
            raise ValueError("texts came in another order when they were read again")
        total = unplanes(*frames(rows["sums"][own].as_py()), "<f8").reshape(-1, 4).T.copy()
        named, n = frames(rows["ids"][own].as_py())[0], total.shape[1]
        for i in map(int, order[1:]):
            at = unnumbers(rows["docs"][i].as_py())
            total[1:, at] += unplanes(*frames(rows["sums"][i].as_py()), "<f8").reshape(3, -1)
        ids = pa.array(np.frombuffer(named, "<i8", n), mask=np.frombuffer(named, bool, n, 8 * n))
        return pa.table([ids, *map(pa.array, total)], schema=last)

    parts = table.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(answer, ddl)
    found = parts.groupBy("flush").applyInArrow(add, "doc_id bigint, n_tokens double, n_known double, base double, score double")
    n = totals.tokens
    level = float(np.log10(n + 0.5 * (totals.vocabulary + 1)))
    tokens, value = F.col("n_tokens"), F.col("score")
    return found.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), F.round(tokens).cast("bigint").alias("n_tokens"),
        F.round("n_known").cast("bigint").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") - tokens * F.lit(level)).alias("base_score"), value.alias("score"),
        F.pow(F.lit(10.0), -value / tokens).alias("perplexity"),
    )
