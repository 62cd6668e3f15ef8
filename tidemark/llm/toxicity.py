"""Toxic passages (operator 3): maximum-scoring segments over token log-odds, calibrated by extreme values.

Fit, on a bounded sample of labelled rows: log-odds of every token and token prefix between toxic and clean
texts under a Dirichlet prior, counted by texts, so that one text's repeats weigh no more than a word; tokens whose odds are
significant get a positive score at each of their places, all others a small negative one. The n-th place of a word within
``REACH`` tokens has the n-th part of what its score is above the others', so that one word repeated doesn't make a passage long, while a passage that comes
again further down scores as before. Score: a linear scan finds every maximal scoring segment of a text; a segment's score has the
expected number E = K m exp(-lambda s) of equals in m clean tokens; the log expectations of the significant segments
add up to the text's evidence (a word that stands alone, and that a segment further up holds, is no segment of its own), which a logistic curve (fitted on a fold that the log-odds have not seen) turns into 0 to 1.

Null and empty texts have no passage and the score of no evidence; rows with a null id are scored like others;
repeated rows give repeated rows; an empty table gives an empty table; without usable labels of both kinds nothing is
found toxic. Only the columns named are read, so others may have any name. Texts are scanned whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict, deque
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, labelled_rows, labelled_sample, map_rows, removed, ship, small_batches, written

ship(__name__)

FOLDS, FOLD = 4, 2
#: Labelled rows used for fitting, at most.
SAMPLE = 32_768
#: Prefix lengths that stand in for a token's inflected forms.
PREFIXES = (4, 5, 6)
#: Mass of the prior that follows the tokens' overall shares, and the mass added to each token.
PRIOR, FLOOR = 10.0, 0.5
#: Standard errors above zero from which a token counts, those taken off its score, and the least score left.
Z_MIN, Z_OFF, LEAST = 3.3, 2.0, 1.0
#: Score of any other token.
DRIFT = -0.25
#: Tokens within which a token's places share its score; the drift over so many outweighs a token's whole score.
REACH = 32
THRESHOLD = 0.3
#: Distinct tokens remembered by a task.
REMEMBERED = 100_000
WORD = r"\w+"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Scores of significant tokens ("w:" words, "p:" prefixes), extreme-value constants and the logistic curve."""

    odds: dict[str, float] = field(default_factory=dict)
    scale: float = 1.0
    rate: float = 1e-6
    offset: float = -4.0
    slope: float = 0.0


def features(word: str) -> list[str]:
    """The word and its prefixes."""
    return ["w:" + word, *("p:" + word[:k] for k in PREFIXES if len(word) > k)]


def copy_keys(text: str | None) -> list[int]:
    """Four minhashes of the text's shingles of five words; near copies agree in some."""
    words = [zlib.crc32(w) for w in (text or "").encode().lower().split()]
    h = np.array(words + [0] * max(0, 5 - len(words)), np.uint64)
    z = h[: len(h) - 4].copy()
    for k in range(1, 5):
        z = z * _MIX + h[k : len(h) - 4 + k]
    z ^= z >> np.uint64(32)
    return [int((z * m).min().astype(np.int64)) for m in (_MIX * np.arange(1, 9, 2, dtype=np.uint64))]


def without_copies(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids that are the least with each of their keys."""
    keep = np.ones(len(ids), bool)
    order = np.argsort(ids, kind="stable")
    for column in keys.T:
        _, first = np.unique(column[order], return_index=True)
        least = np.zeros(len(ids), bool)
        least[order[first]] = True
        keep &= least
    return ids[keep]


def count_tokens(rows: DataFrame) -> DataFrame:
    """(token, clean, toxic): texts by label that hold a feature, of ``rows`` (text, label); all texts under the token "n:"."""

    def make():
        counts: Counter = Counter()

        def drain():
            keys = list({k for k, _ in counts})
            out = [keys, [counts[k, 0] for k in keys], [counts[k, 1] for k in keys]]
            counts.clear()
            return out

        def fn(cols):
            out: list[list] = [[], [], []]
            for text, label in zip(*cols):
                own = {f for word in set(re.findall(WORD, (text or "").lower())) for f in features(word)}
                counts.update((f, label) for f in own)
                counts["n:", label] += 1
                if len(counts) > 150_000:
                    out = [a + b for a, b in zip(out, drain())]
            return out

        fn.rest = drain
        return fn

    parts = map_rows(rows.select("text", "label"), make, "token string, clean bigint, toxic bigint")
    return parts.groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def significant(counts: DataFrame) -> DataFrame:
    """(token, score) of the tokens whose log-odds exceed zero by ``Z_MIN`` standard errors."""
    texts = counts.filter("token = 'n:'").select(F.col("clean").alias("all_clean"), F.col("toxic").alias("all_toxic"))
    rows = counts.filter("toxic > 1 and token <> 'n:'").join(F.broadcast(texts))  # texts is one row
    share = F.lit(PRIOR) * (F.col("clean") + F.col("toxic")) / (F.col("all_clean") + F.col("all_toxic")) + FLOOR
    a, b = F.col("toxic") + share, F.col("clean") + share
    delta = F.log(a / (F.col("all_toxic") - F.col("toxic") + PRIOR)) - F.log(b / (F.col("all_clean") - F.col("clean") + PRIOR))
    error = F.sqrt(1 / a + 1 / b)
    found = rows.withColumn("delta", delta).withColumn("error", error).filter(F.col("delta") > Z_MIN * F.col("error"))
    return found.select("token", (F.col("delta") - Z_OFF * F.col("error")).alias("score")).filter(F.col("score") >= LEAST)


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in linear time, of a sequence that scores ``drift`` < 0
    everywhere but at ``hits`` (position, score > 0)."""
    out: list[list] = []  # first, last, sum before, sum after
    total, after = 0.0, 0
    for at, score in hits:
        before = total + drift * (at - after)
        total, after = before + score, at + 1
        new = [at, at, before, total]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j = out[j][4]
            if j < 0 or out[j][3] >= new[3]:
                new = [*new[:4], j]
                out.append(new)
                break
            new[0], new[2] = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, after_ - before_) for a, b, before_, after_, _ in out]


class Scanner:
    """Scans texts with one model."""

    def __init__(self, model: Model):
        self.model, self.known = model, _Scores(model.odds)

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """(number of tokens, segments in token positions)."""
        words = re.findall(WORD, (text or "").lower())
        hits, near = [], defaultdict(deque)
        for i, s in enumerate(map(self.known.__getitem__, words)):
            if s:
                places = near[words[i]]
                while places and i - places[0] > REACH:
                    places.popleft()
                places.append(i)
                s = DRIFT + (s - DRIFT) / len(places)
                if s > 0:
                    hits.append((i, s))
        found, told = [], set()
        for a, b, s in maximal_segments(hits, DRIFT):
            if a < b or words[a] not in told:
                found.append((a, b, s))
            told.update(words[a : b + 1])
        return len(words), found

    def evidence(self, tokens: int, score: float) -> float:
        """Minus the log of the expected number of clean segments that score as much; 0 if that is 1 or more."""
        return max(0.0, self.model.scale * score - math.log(self.model.rate * max(tokens, 1)))

    def total(self, tokens: int, found: list[tuple[int, int, float]]) -> float:
        return sum(self.evidence(tokens, s) for _, _, s in found)

    def probability(self, evidence: float) -> float:
        z = self.model.offset + self.model.slope * min(evidence, 60.0)
        return 1 / (1 + math.exp(-z))


class _Scores(dict):
    def __init__(self, odds):
        super().__init__()
        self.odds = odds

    def __missing__(self, word):
        s = max((self.odds.get(f, 0.0) for f in features(word)), default=0.0)
        if len(self) < REMEMBERED:
            self[word] = s
        return s


def spans(text: str, found: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Code point ranges of segments given in token positions."""
    want = {p for a, b, _ in found for p in (a, b)}
    at = {i: m.span() for i, m in enumerate(re.finditer(WORD, text.lower())) if i in want}
    return [(min(at[a][0], len(text)), min(at[b][1], len(text))) for a, b, _ in found]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a ridge logistic curve by Newton steps."""
    a, w = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-2
        step = np.linalg.solve(h, a.T @ (y - p) - 1e-2 * w)
        w = w + np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fit(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """A model from at most ``bound`` labelled rows outside the held-out fold, of near copies one; three quarters give
    the odds, the rest the calibration."""
    chosen = labelled_sample(labels, "toxic", FOLDS, FOLD, bound)
    sample = written(labelled_rows(documents, chosen), "toxicity")
    make_keys = lambda: lambda cols: [cols[0], [copy_keys(t) for t in cols[1]]]
    keys = map_rows(sample.select("doc_id", "text"), make_keys, "doc_id bigint, keys array<bigint>").toArrow()
    single = without_copies(np.array(keys["keys"].to_pylist(), np.int64).reshape(-1, 4), np.asarray(keys["doc_id"], np.int64))
    spark = documents.sparkSession
    single = spark.createDataFrame(pa.table({"doc_id": pa.array(single, pa.int64())}))  # at most ``bound`` ids
    rows = sample.join(F.broadcast(single), "doc_id", "left_semi")
    calibration = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0
    model = Model()
    model.odds = {r.token: r.score for r in significant(count_tokens(rows.filter(~calibration))).collect()}

    def make():
        scanner = Scanner(model)

        def fn(cols):
            found = [scanner.segments(t) for t in cols[0]]
            return [cols[1], [n for n, _ in found], [[s for _, _, s in x] for _, x in found]]

        return fn

    seen = map_rows(
        rows.filter(calibration).select("text", "label"), make, "label int, tokens bigint, scores array<double>"
    ).collect()  # a part of the bounded sample
    removed(sample)
    clean = [r for r in seen if r.label == 0]
    if not clean or len(clean) == len(seen):
        return model
    # extreme-value constants: log-odds in nats have scale 1 by nature; the rate is that of segments in clean texts
    tokens = sum(r.tokens for r in clean)
    found = sorted(s for r in clean for s in r.scores)
    model.rate = (len(found) + 0.5) / (tokens + 1)
    if len(found) >= 30:
        model.scale = float(np.clip(1 / max(np.mean(found), 1e-3), 0.25, 1.0))
    scanner = Scanner(model)
    x = np.array([scanner.total(r.tokens, [(0, 0, s) for s in r.scores]) for r in seen])
    model.offset, model.slope = logistic(np.minimum(x, 60.0), np.array([float(r.label) for r in seen]))
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of every row; passages: code point ranges, their scores and evidence."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make():
        scanner = Scanner(model)

        def fn(cols):
            scores, passages = [], []
            for text in cols[1]:
                n, found = scanner.segments(text)
                found = [x for x in found if scanner.evidence(n, x[2]) > 0]
                scores.append(scanner.probability(scanner.total(n, found)))
                passages.append([
                    {"start": a, "end": b, "score": x[2], "evidence": scanner.evidence(n, x[2])}
                    for x, (a, b) in zip(found, spans(text, found) if found else [])
                ])
            return [cols[0], scores, passages]

        return fn

    rows = map_rows(
        documents.select("doc_id", "text"), make,
        f"doc_id {kind}, score double, passages array<struct<start:int,end:int,score:double,evidence:double>>",
    )
    return rows.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages",
    )


def clean(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` that score below the threshold, with all their columns; decided where the text is,
    without a join."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(model)
        for texts in batches:
            found = map(scanner.segments, texts)
            yield pd.Series([scanner.probability(scanner.total(n, x)) for n, x in found], dtype="float64")

    return documents.filter(probability("text") < THRESHOLD)
