"""Substring deduplication (operator 7): content-defined chunks of a gear rolling hash, deduplicated by digest.

A text is cut before a word where the gear hash of the 16 bytes before it is the least of some ``WINDOW`` words in a row, so cuts
depend on nearby bytes alone, an insertion moves no far cut, and no ``WINDOW`` words in a row lack a cut, whatever the text. Words of more
than ``LONG`` bytes (scripts without spaces, encoded data) are cut inside in the same way, by ``WINDOW_CHARS`` characters. Every chunk but its first occurrence (smallest doc_id, then smallest row
key, then earliest in the text) is repeated. Runs of repeated chunks of at least ``MIN_WORDS`` words are taken out of
the text; shorter runs are phrases that recur by chance or short stock lines, and stay.

Null and empty texts have no chunk and stay as they are. Rows of equal id and text are one row for the comparison and stay
alike. Null ids come first. An empty table gives an empty table. Only doc_id and text are read; other columns pass
through, and input columns named like the new ones are replaced. Texts are read whole; a text shorter than a window is one chunk.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, map_rows, ship, written

ship(__name__)

#: Words of repeated text in a row from which it is taken out. Chunks at the ends of a repeated passage differ, as they
#: reach beyond it. At most 9 words have less than 16 bytes of the passage before them, and the first and the last window after
#: those hold a cut each, so 9 + 16 + 2 * (WINDOW - 1) + 1 = 44 words show this many or more.
MIN_WORDS = 16
#: Words of which one starts a chunk at least; (WINDOW + 1) / 2 words are a chunk on average.
WINDOW = 10
#: Bytes from which a word is cut inside, the characters of which one starts a chunk there, and the bytes that count as a word.
LONG, WINDOW_CHARS, WORD_BYTES = 128, 40, 6
#: Multiplier and offset from which the gear table is made.
GEAR_SEED = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def gear_table() -> np.ndarray:
    """A random number for every byte."""
    return np.random.default_rng(GEAR_SEED & 0xFFFFFFFF).integers(0, 1 << 16, 256, dtype=np.uint16)


_GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: sum of gear[b] << age over the last 16 bytes, modulo 2^16."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):  # each step doubles the window
        older = np.zeros_like(h)
        older[k:] = h[:-k] << np.uint16(k)
        h = h + older
    return h


def minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """The places that are least (the first of equals) in some ``window`` places in a row."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    least, size = hashes.astype(np.uint64) << np.uint64(40) | np.arange(len(hashes), dtype=np.uint64), 1
    while size < window:
        step = min(size, window - size)
        least, size = np.minimum(least[:-step], least[step:]), size + step
    found = np.zeros(len(hashes), bool)
    found[(least & np.uint64((1 << 40) - 1)).astype(np.int64)] = True
    return np.flatnonzero(found)


def chunks(text: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(byte starts and the end, words of each chunk, digest of each chunk) of a text that isn't empty."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    space = _SPACES[data]
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1  # first bytes of words but a word at the start
    hashes = gear_hashes(data)
    cuts = [np.zeros(1, np.int64), starts[minima(hashes[starts - 1], WINDOW)]]
    first = np.concatenate([[not space[0]], ~space[1:] & space[:-1]])
    # words of more than LONG bytes: between white space that far apart
    edges = np.concatenate([[-1], np.flatnonzero(space), [len(data)]])
    long = np.flatnonzero(np.diff(edges) - 1 > LONG)
    inside = np.zeros(len(data), np.int64)
    for a, b in zip((edges[long] + 1).tolist(), edges[long + 1].tolist()):
        inside[a:b] = 1
        places = a + 1 + np.flatnonzero((data[a + 1 : b] & 0xC0) != 0x80)  # first bytes of characters
        cuts.append(places[minima(hashes[places - 1], WINDOW_CHARS)])
    cuts = np.concatenate(cuts)
    if len(long):
        cuts = np.unique(cuts)
    words = np.add.reduceat(first.astype(np.int64), cuts)
    if len(long):
        words += np.add.reduceat(inside, cuts) // WORD_BYTES
    cuts = np.append(cuts, len(data))
    view = memoryview(raw)
    edges = cuts.tolist()
    digests = [hashlib.blake2b(view[a:b], digest_size=8).digest() for a, b in zip(edges, edges[1:])]
    return cuts, words, digests


def _signed(digests: list[bytes]) -> list[int]:
    return np.frombuffer(b"".join(digests), "<i8").tolist()


def repeated_runs(numbers: list[int], words: np.ndarray, elsewhere: set[int]) -> list[tuple[int, int]]:
    """Runs (first chunk, chunk after the last) of repeated chunks with enough words."""
    seen: set[int] = set()
    runs, start, total = [], 0, 0
    for i, d in enumerate([*numbers, None]):
        if d is not None and (d in elsewhere or d in seen):
            total += int(words[i])
        else:
            if total >= MIN_WORDS:
                runs.append((start, i))
            start, total = i + 1, 0
        seen.add(d)
    return runs


def repeated_chunks(keyed: DataFrame) -> DataFrame:
    """(_key, _digests): for each row, the digests of its chunks that occur in an earlier row."""
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def make():
        def fn(cols):
            ids, keys, digests = [], [], []
            for doc, key, text in zip(*cols):
                if text:
                    own = sorted(set(_signed(chunks(text)[2])))
                    digests += own
                    ids += [doc] * len(own)
                    keys += [key] * len(own)
            return [digests, ids, keys]

        return fn

    rows = map_rows(keyed.select("doc_id", "_key", "text"), make, f"digest bigint, doc_id {kind}, _key bigint")
    own = F.min(F.struct("doc_id", "_key")).alias("first")
    first = rows.groupBy("digest").agg(own, F.min("_key").alias("least"), F.max("_key").alias("most")).filter("least <> most")
    # a table of its own: both sides of the join are then shuffled for it alone, and a digest that many texts hold can be split
    first = written(first.select("digest", F.col("first._key").alias("_first")), "repeated")
    return (
        rows.join(first, "digest").filter("_key <> _first").groupBy("_key").agg(F.collect_set("digest").alias("_digests"))
    )


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, and ``removed_chars``, ``removed_words``, ``removed``: their
    ranges in code points of the old text."""
    docs = docs.drop("removed_chars", "removed_words", "removed")
    key, found = fresh(docs, "_key"), fresh(docs, "_digests")
    row = F.xxhash64("doc_id", "text")
    repeated = repeated_chunks(docs.select("doc_id", "text", row.alias("_key"))).toDF(key, found)
    joined = docs.withColumn(key, row).join(repeated, key, "left")
    names = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def make():
        def cut(text: str | None, elsewhere: list[int] | None):
            if not text:
                return text, 0, 0, []
            edges, words, digests = chunks(text)
            runs = repeated_runs(_signed(digests), words, set(elsewhere or ()))
            if not runs:
                return text, 0, 0, []
            raw, kept, gone, at, chars = text.encode(), [], [], 0, 0
            for a, b in runs:
                before, passage = raw[at : edges[a]].decode(), raw[edges[a] : edges[b]].decode()
                kept.append(before)
                chars += len(before)
                gone.append({"start": chars, "end": chars + len(passage)})
                chars += len(passage)
                at = int(edges[b])
            kept.append(raw[at:].decode())
            return "".join(kept), sum(g["end"] - g["start"] for g in gone), sum(int(words[a:b].sum()) for a, b in runs), gone

        def fn(cols):
            return [*cols[:-2], *map(list, zip(*map(cut, cols[-2], cols[-1])))]

        return fn

    out = map_rows(
        joined.select(*names, "text", found), make,
        f"{schema}, text string, removed_chars bigint, removed_words bigint, removed array<struct<start:bigint,end:bigint>>",
    )
    return out.select(*docs.columns, "removed_chars", "removed_words", "removed")
