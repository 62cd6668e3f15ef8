import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search as ls


def words(text):
    out = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in out]


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score), every document scored. docs: (doc_id, text); items: (item_id, text)."""
    counted = [(i, Counter(w), len(w)) for i, text in docs if (w := words(text))]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    own = {}
    for i, text in items:
        own.setdefault(i, set()).update(words(text))
    out = []
    for item, terms in own.items():
        found = []
        for i, counts, n in counted:
            m = 10 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in terms if t in counts
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_sql_gives_the_same_rows(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = sorted(con.execute(f"select item_id, rank, doc_id, score from ({ls.ORACLE})").fetchall(), key=str)
    got = ls.search(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert rows(got) == want and len(want) == 400


def test_bounds_hold_and_are_close(spark, sf):
    index = ls.build(spark.read.parquet(f"{sf}/documents.parquet"))
    (block,) = ls.blocks(spark.read.parquet(f"{sf}/benchmark.parquet"), index)
    texts = {r.key: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select(ls.row_key().alias("key"), "text").collect()}
    told, exact = 0, 0
    for r in index.documents.collect():
        counts = Counter(ls.terms(texts[r.key]))
        bounds, scores = block.bounds(r.sketch, r.n), np.array(block.scores(counts, r.n, list(range(len(block.items)))))
        assert (bounds >= scores).all()
        told, exact = told + bounds.sum(), exact + scores.sum()
    assert told < 1.5 * exact  # 1.33


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "Alpha BETA"), (1, "gamma"), (2, None), (3, ""), (4, "!!! ..."), (5, "漢字 text"), (None, "word1 two"), (6, "nowhere-to-be-found"), (7, "alpha"), (7, "alpha")],
        "item_id bigint, text string",
    ).withColumns({c: F.lit("clash") for c in ("score", "rank", "key", "term", "df", "item")})
    want = brute([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(ls.search(odd, items)) == want
    assert ls.search(none, items).count() == 0 and ls.search(odd, items.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_hot_copies_and_small_rounds(spark, monkeypatch, seed):
    """A third of all rows are copies, counts beyond the sketch's greatest, few rounds' places, several blocks."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 50, 300])))) for i in range(300)]
    docs += [(rng.randint(0, 2000), "W1 w2, w3 hot copy") for _ in range(150)] + [(None, "w1 w2"), (5000, "w7 " * 400), (5001, "w7 " * 300)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 9)))) for i in range(12)] + [(50, "hot copy"), (51, "w7")]
    monkeypatch.setattr(ls, "FIRST", 2)
    monkeypatch.setattr(ls, "SECOND", 5)
    monkeypatch.setattr(ls.blocks, "__defaults__", (5,))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = ls.search(d, spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(got) == brute(docs, items)


def test_few_documents_are_scored(spark):
    """Most pairs of document and query are settled by their bounds."""
    folder = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    index = ls.build(docs)
    (block,) = ls.blocks(items, index)
    least = np.ones(len(block.items), np.int64)
    least = ls.thresholds(ls.rescored(docs, ls.leaders(index, block, 64, least), block, 10, True), block, 10)
    assert ls.contenders(index, block, least, 10).count() < 0.2 * index.size * len(block.items)
