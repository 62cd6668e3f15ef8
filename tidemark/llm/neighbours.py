"""Approximate nearest neighbours (operator 2) by learned partitions.

Fit, on a bounded sample: the sample's neighbour graph is cut into balanced parts by moving nodes to the part that holds
most of their neighbours, and a small classifier learns the parts that a vector's neighbours lie in. Index: the classifier
gives every row its most probable part. Search: a query visits its most probable parts until they hold a share of its
probability, and the rows found are ranked by the exact inner product in double precision. The share is the least at
which the sample's own neighbours are found with recall ``RECALL``; on data without structure that means most parts.

Hot groups: of equal vectors only the ``k + 1`` smallest ids can be among ``k`` nearest, the rest is cut off before the
shuffle; parts are divided into blocks of bounded size, for rows and queries alike, and each pair of blocks is a task group.

Vectors that are null, zero, of another length than most of the sample, or hold null or non-finite components take no part,
nor do null ids; of several vectors of one id the least stands, so repeated rows count once. An empty table gives an empty
table; a query without candidates has no row. Only vec_id and the vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, ship, written

ship(__name__)

#: Rows of the sample, least number of parts, neighbours in the graph, units of the classifier.
SAMPLE, PARTS, DEGREE, HIDDEN = 8_192, 32, 10, 128
#: Rows for which there is one more part, as far as the sample has 64 rows for each.
PART_ROWS = 100_000
#: Recall that the share of probability is chosen for.
RECALL = 0.96
#: Most rows or queries of a block.
BLOCK = 16_384


@dataclass
class Router:
    """A classifier of vectors into parts, and the share of probability that a query visits."""

    size: int
    scale: float
    layers: list[np.ndarray]
    share: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        z = np.maximum(x * self.scale @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product with each row but itself, in blocks."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced(score: np.ndarray, room: int) -> np.ndarray:
    """The part of best score with room left for every row; rows that are surest choose first."""
    top = np.sort(score, axis=1)
    order = np.argsort(top[:, -2] - top[:, -1], kind="stable") if score.shape[1] > 1 else np.arange(len(score))
    wish, left, part = np.argsort(-score, axis=1, kind="stable"), np.full(score.shape[1], room), np.empty(len(score), np.int64)
    for i in order:
        part[i] = next(p for p in wish[i] if left[p])
        left[part[i]] -= 1
    return part


def cut_graph(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A balanced partition of the neighbour graph in which few edges cross."""
    n, room = len(x), -(-11 * len(x) // (10 * parts))
    centres = x[rng.choice(n, parts, replace=False)]
    for _ in range(5):
        part = balanced(x @ centres.T, room)
        centres = np.stack([x[part == p].sum(0) for p in range(parts)])
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-12
    here, there = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(12):
        votes = 1e-3 * (x @ centres.T)
        np.add.at(votes, (here, part[there]), 1)
        np.add.at(votes, (there, part[here]), 1)
        votes[np.arange(n), part] += 1
        moved = balanced(votes, room)
        if (moved == part).all():
            break
        part = moved
    return part


def learn(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, epochs: int = 25) -> list[np.ndarray]:
    """One hidden layer, softmax, cross entropy against ``target``, by Adam."""
    d, m = x.shape[1], target.shape[1]
    p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, m)), np.zeros(m)]
    mean, square, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            i = order[a : a + 256]
            hidden = np.maximum(x[i] @ p[0] + p[1], 0)
            z = hidden @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = (z / z.sum(1, keepdims=True) - target[i]) / len(i)
            back = (g @ p[2].T) * (hidden > 0)
            t += 1
            for j, grad in enumerate([x[i].T @ back, back.sum(0), hidden.T @ g, g.sum(0)]):
                mean[j] = 0.9 * mean[j] + 0.1 * grad
                square[j] = 0.999 * square[j] + 0.001 * grad * grad
                p[j] = p[j] - rate * mean[j] / (1 - 0.9**t) / (np.sqrt(square[j] / (1 - 0.999**t)) + 1e-8)
    return p


def visited(probabilities: np.ndarray, share: float, sizes: np.ndarray, least: int) -> np.ndarray:
    """For each query the parts it visits (a matrix of flags): the most probable ones until ``share`` is reached, and
    on until they hold ``least`` rows."""
    order = np.argsort(-probabilities, axis=1, kind="stable")
    p = np.take_along_axis(probabilities, order, 1)
    before = np.cumsum(p, 1) - p
    held = np.cumsum(sizes[order], 1) - sizes[order]
    out = np.zeros(probabilities.shape, bool)
    np.put_along_axis(out, order, (before < share) | (held < least), 1)
    return out


def fit(vectors: np.ndarray, k: int, parts: int = PARTS, seed: int = 5) -> Router:
    """A router into ``parts`` (fewer for a small sample) from a bounded sample of vectors."""
    rng, n, d = np.random.default_rng(seed), *vectors.shape
    parts = int(min(parts, n // 64))
    scale = float(d**0.5 / max(np.sqrt((vectors * vectors).sum(1).mean()), 1e-300)) if n else 1.0
    if parts < 2:
        return Router(d, scale, [np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1.0)
    degree = min(DEGREE, n - 1)
    graph = nearest(vectors, degree)
    part = cut_graph(vectors, graph, parts, rng)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), degree), part[graph].ravel()), 0.7 / degree)
    target[np.arange(n), part] += 0.3
    router = Router(d, scale, learn(vectors * scale, target, rng), 1.0)
    p = router.probabilities(vectors)
    home, near = p.argmax(1), nearest(vectors, min(k, n - 1))
    sizes = np.bincount(home, minlength=parts)
    for share in (0.3, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 1.0):
        if np.take_along_axis(visited(p, share, sizes, k + 1), home[near], 1).mean() >= RECALL:
            router.share = share
            break
    return router


def usable(df: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vector): one usable vector of doubles for each id."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min(v).alias("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def search(df: DataFrame, is_query, k: int = 20, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``is_query`` holds, the ``k`` nearest of all others found."""
    base = written(usable(df, vector), "vectors")
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()  # at most SAMPLE rows
    lengths = Counter(map(len, sample["vector"].to_pylist()))
    size = min(lengths, key=lambda n: (-lengths[n], n)) if lengths else 1
    rows = [v for v in sample["vector"].to_pylist() if len(v) == size]
    router = fit(np.array(rows, np.float64).reshape(len(rows), size), k, max(PARTS, base.count() // PART_ROWS))
    base = base.filter(F.size("vector") == size)

    w = Window.partitionBy("vector").orderBy("vec_id")
    few = base.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1).drop("_n")

    def make_home():
        return lambda cols: [cols[0], cols[1], router.probabilities(np.array(cols[1])).argmax(1).astype(np.int32)]

    indexed = written(map_rows(few, make_home, "vec_id bigint, vector array<double>, part int"), "index")
    parts = router.layers[2].shape[1]
    counts = {r.part: r.n for r in indexed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a part
    sizes = np.array([counts.get(p, 0) for p in range(parts)])

    def make_visits():
        def fn(cols):
            flags = visited(router.probabilities(np.array(cols[1])), router.share, sizes, k + 1) & (sizes > 0)
            at, part = np.nonzero(flags)
            return [[cols[0][i] for i in at], [cols[1][i] for i in at], part.astype(np.int32)]

        return fn

    queries = base.filter(is_query)
    asked = map_rows(queries, make_visits, "query_id bigint, vector array<double>, part int")
    visits = {r.part: r.n for r in asked.groupBy("part").agg(F.count("*").alias("n")).collect()}
    blocks = [max(1, -(-int(sizes[p]) // BLOCK)) for p in range(parts)]
    groups = [max(1, -(-int(visits.get(p, 0)) // BLOCK)) for p in range(parts)]

    def placed(rows: DataFrame, key: str, own: list[int], other: list[int], names: tuple[str, str]) -> DataFrame:
        """Each row in its own block, beside every block of the other side."""
        at = F.col("part") + 1
        mine = F.pmod(F.xxhash64(key), F.element_at(F.array(*map(F.lit, own)), at)).cast("int")
        return rows.withColumn(names[0], mine).withColumn(
            names[1], F.explode(F.sequence(F.lit(0), F.element_at(F.array(*map(F.lit, other)), at) - 1))
        )

    left = placed(indexed, "vec_id", blocks, groups, ("block", "lot"))
    right = placed(asked, "query_id", groups, blocks, ("lot", "block"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def rank(have: pa.Table, want: pa.Table) -> pa.Table:
        if not have.num_rows or not want.num_rows:
            return out.empty_table()
        ids, asks = np.asarray(have["vec_id"]), np.asarray(want["query_id"])
        x, q = _matrix(have["vector"]), _matrix(want["vector"])
        found = []
        for a in range(0, len(q), 256):
            s = q[a : a + 256] @ x.T
            s[asks[a : a + 256, None] == ids[None, :]] = -np.inf
            m = min(k, s.shape[1])
            low = np.partition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m]
            slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(low), low, 0)))
            i, j = np.nonzero((s >= (low - slack)[:, None]) & np.isfinite(s))
            exact = (q[a + i] * x[j]).sum(1)  # the same order of additions for every pair
            best = np.lexsort((ids[j], -exact, i))
            nth = np.arange(len(best)) - np.searchsorted(i[best], i[best])
            best = best[nth < k]
            found.append((asks[a + i[best]], ids[j[best]], exact[best]))
        return pa.table([np.concatenate(c) for c in zip(*found)], schema=out)

    key = ["part", "block", "lot"]
    pairs = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rank, "query_id bigint, vec_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
