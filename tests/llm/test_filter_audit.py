import random
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit as fa

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """Every order, applied row by row. docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    marks = {}
    for i, q, t in labels:
        good, toxic = marks.get(i, (False, False))
        marks[i] = good or q == 1, toxic or t == 1
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
        same = [j for j, other, _ in docs if (other or "") == text and j is not None]
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": bool(same) and (i is None or min(same) < i),
        }
        rows.append((lang or "", fails, marks.get(i, (False, False)) if i is not None else (False, False)))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                own = [r for r in rows if r[0] == part and r[1][f]]
                out[part, order, step] = [
                    len(left), len(gone), len(own) - len(gone), sum(sum(r[1].values()) == 1 for r in own),
                    sum(r[2][0] for r in gone), sum(r[2][1] for r in gone), 0,
                ]
                shapley[f] += len(gone)
        for (p, order, step), v in out.items():
            if p == part:
                v[-1] = shapley[order[step - 1]]
    return out


def result(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in rows}
    assert len(out) == len(rows)
    return out


def test_merges_against_sets():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.choice([1, 5, 40, 3000])
        lists = [sorted(rng.sample(range(n), rng.randint(0, n))) for _ in range(rng.randint(0, 6))]
        assert fa.union(lists) == sorted(set().union(*lists))
        a, b = (lists + [[], []])[:2]
        assert fa.difference(a, b) == sorted(set(a) - set(b))
        x, start = rng.randint(0, n), rng.randint(0, len(a))
        assert fa.gallop(a, x, start) == next((k for k in range(start, len(a)) if a[k] >= x), len(a))


def test_gallop_passes_long_runs_in_few_steps():
    class Counted(list):
        reads = 0

        def __getitem__(self, k):
            Counted.reads += isinstance(k, int)
            return super().__getitem__(k)

    long = Counted(range(0, 2_000_000, 2))
    assert len(fa.difference([1, 1_500_001], long)) == 2
    assert Counted.reads < 200


def test_sql_gives_the_same_rows(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    names = "part, filter_order, step, " + ", ".join(COLUMNS)
    want = sorted(con.execute(f"select {names} from ({fa.ORACLE})").fetchall())
    got = fa.audit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert sorted(map(tuple, got.select(*names.split(", ")).collect())) == want
    assert len(want) == 600 * len({r[0] for r in want})


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, None), (2, None, 1), (2, 1, 1), (None, 1, 1), (7, 0, 1), (999, 1, 1)], "doc_id bigint, quality int, toxic int"
    ).withColumn("marks", F.lit("clash"))
    docs = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert result(fa.audit(odd, labels)) == brute(docs, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert fa.audit(none, labels).count() == 0
    assert {v[4] for v in result(fa.audit(odd, labels.limit(0))).values()} == {0}


def test_one_id_and_one_text_in_every_row(spark, monkeypatch):
    """A hot id spans ranges; counts don't depend on their size."""
    rows = [(7, "X" if i % 3 else f"text {i} #", "en") for i in range(500)] + [(None, "X", None), (3, "X", "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(7, 1, 1)], "doc_id bigint, quality int, toxic int")
    monkeypatch.setattr(fa.postings, "__defaults__", (16,))
    got = fa.audit(docs, labels)
    assert result(got) == brute(rows, [(7, 1, 1)])


def test_postings_hold_failing_rows(spark):
    rows = spark.createDataFrame(
        [("en", i, i, i % 4, i % 2) for i in range(100)], "part string, doc_id bigint, row bigint, fails int, marks int"
    )
    found = fa.postings(rows, 2, 30).collect()
    assert sum(r.n for r in found) == 100 and all(r.n <= 30 for r in found)
    ids = {f: sorted(r.first_id + k for r in found for k in r.lists[f]) for f in range(4)}
    assert ids[0] == [i for i in range(100) if i % 4 & 1] and ids[1] == [i for i in range(100) if i % 4 & 2]
    assert ids[2] == [i for i in range(100) if i % 2] and ids[3] == []
