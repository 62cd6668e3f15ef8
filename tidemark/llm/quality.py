"""Quality classifier (operator 10): a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its distinct words hashed into ``WORDS`` slots with the value sqrt(count / words), summed over words that
share a slot, and the buckets
of statistics of its structure and size, one slot each. The score is the logistic of
w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2), which takes time linear in the features.
Weights are fitted by AdaGrad on a bounded sample of labelled rows.

Null and empty texts have the structure features of an empty text and get a score like any other; repeated rows give
repeated rows; an empty table gives an empty table; without usable labels every score is 0.5. Only the columns named are
read, so others may have any name. Texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, labelled_rows, labelled_sample, map_rows, ship

ship(__name__)

FOLDS, FOLD = 5, 0
#: Labelled rows used for fitting, at most.
SAMPLE = 8_192
#: Slots of hashed words; structure buckets follow them.
WORDS = 1 << 15
BUCKETS = 12
FACTORS = 8
EPOCHS = 12
THRESHOLD = 0.3
REMEMBERED = 200_000
STATISTICS = (
    "size", "words", "word_length", "upper", "digit", "symbol", "space", "wide", "distinct_words", "top_word", "lines",
    "repeated_lines", "line_length", "stops", "one_letter",
)
SLOTS = WORDS + len(STATISTICS) * BUCKETS
_SYMBOLS = re.compile(r"[#$%&*|<>{}\[\]=+~^@!\\/_]")


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """The structure statistics, each between 0 and 1."""
    n, k = max(len(text), 1), max(len(words), 1)
    lines = text.split("\n")
    letters = sum(map(len, words))
    ascii_only = len(text.encode())
    return [
        min(np.log1p(len(text)) / 14, 1), min(np.log1p(len(words)) / 12, 1), min(letters / k / 16, 1),
        min(3 * sum(map(text.count, "ETAOINSRHL")) / n, 1), min(4 * sum(map(text.count, "0123456789")) / n, 1),
        min(4 * len(_SYMBOLS.findall(text)) / n, 1), 1 - min(letters / n, 1), min(4 * (ascii_only - len(text)) / n, 1),
        len(counts) / k, min(2 * max(counts.values(), default=0) / k, 1), min(np.log1p(len(lines)) / 10, 1),
        1 - len(set(lines)) / len(lines), min(np.log1p(len(text) / len(lines)) / 10, 1),
        min(8 * text.count(".") / k, 1), min(4 * sum(v for w, v in counts.items() if len(w) == 1) / k, 1),
    ]


class Reader:
    """Texts to features; remembers the slots of words."""

    def __init__(self):
        self.slots: dict[str, int] = {}

    def slot(self, word: str) -> int:
        s = self.slots.get(word)
        if s is None:
            s = zlib.crc32(word.encode()) % WORDS
            if len(self.slots) < REMEMBERED:
                self.slots[word] = s
        return s

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(slots, values) of one text; no slot occurs twice."""
        text = text or ""
        words = text.split()
        counts = Counter(words)
        slots = np.fromiter(map(self.slot, counts), np.int32, len(counts))
        values = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)) / max(len(words), 1))
        stats = np.array(statistics(text, words, counts))
        places = WORDS + np.arange(len(stats)) * BUCKETS + np.minimum((stats * BUCKETS).astype(int), BUCKETS - 1)
        slots, place = np.unique(slots, return_inverse=True)  # words that share a slot are one feature
        values = np.bincount(place, weights=values, minlength=len(slots)).astype(np.float32)
        return np.concatenate([slots, places.astype(np.int32)]), np.concatenate([values, np.ones(len(stats), np.float32)])


def _margin(model: Model, slots: np.ndarray, values: np.ndarray) -> tuple[float, np.ndarray]:
    v = model.factors[slots]
    s = values @ v
    pairs = 0.5 * float((s * s).sum() - ((values * values) @ (v * v)).sum())
    return model.bias + float(model.weights[slots] @ values) + pairs, s


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """AdaGrad over the rows (slots, values, label), in a fixed order for each epoch."""
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(SLOTS, np.float32), rng.normal(0, 0.02, (SLOTS, FACTORS)).astype(np.float32))
    if not rows:
        model.factors[:] = 0
        return model
    share = np.clip(np.mean([y for _, _, y in rows]), 0.01, 0.99)
    model.bias = float(np.log(share / (1 - share)))
    seen_b, seen_w, seen_v = 1e-6, np.full(SLOTS, 1e-6, np.float32), np.full((SLOTS, FACTORS), 1e-6, np.float32)
    rate, ridge = 0.08, 1e-5
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            slots, values, y = rows[i]
            z, s = _margin(model, slots, values)
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            if abs(g) < 1e-4:
                continue
            seen_b += g * g
            model.bias -= rate * g / seen_b**0.5
            gw = g * values + ridge * model.weights[slots]
            seen_w[slots] += gw * gw
            model.weights[slots] -= rate * gw / np.sqrt(seen_w[slots])
            v = model.factors[slots]
            gv = g * (values[:, None] * s - v * (values * values)[:, None]) + ridge * v
            seen_v[slots] += gv * gv
            model.factors[slots] -= 0.3 * rate * gv / np.sqrt(seen_v[slots])
    return model


def fit(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """A model from at most ``bound`` labelled rows outside the held-out fold."""
    chosen = labelled_sample(labels, "quality", FOLDS, FOLD, bound)

    def make():
        reader = Reader()

        def fn(cols):
            read = [reader.read(t) for t in cols[1]]
            return [cols[0], cols[2], [s.tobytes() for s, _ in read], [x.tobytes() for _, x in read]]

        return fn

    rows = labelled_rows(documents, chosen)
    found = map_rows(rows, make, "doc_id bigint, label int, slots binary, x binary").toPandas()  # the bounded sample
    found = found.sort_values(["doc_id", "label"], kind="stable")
    return train([
        (np.frombuffer(s, np.int32), np.frombuffer(x, np.float32), int(y)) for s, x, y in zip(found["slots"], found["x"], found["label"])
    ])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make():
        reader = Reader()

        def fn(cols):
            z = np.array([_margin(model, *reader.read(t))[0] for t in cols[1]])
            return [cols[0], 1 / (1 + np.exp(-np.clip(z, -30, 30)))]

        return fn

    rows = map_rows(documents.select("doc_id", "text"), make, f"doc_id {kind}, score double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
