import itertools
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import common, quality, toxicity


def held_out(doc, folds, fold):
    return zlib.crc32(str(doc).encode()) % folds == fold


def accuracy(rows, labels, column):
    """(share of 1 found, share of 0 left alone) on the held-out rows."""
    truth = {r.doc_id: r[column] for r in labels.collect()}
    both = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    ones, zeros = [p for t, p in both if t == 1], [p for t, p in both if t == 0]
    return np.mean(ones), 1 - np.mean(zeros)


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_toxicity_on_held_out_rows(tables):
    documents, labels = tables
    rows = toxicity.score(documents, toxicity.fit(documents, labels)).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held_out(r.doc_id, 4, 2) for r in rows)
    found, spared = accuracy(rows, labels, "toxic")
    assert found > 0.8 and spared > 0.98


def test_quality_on_held_out_rows(tables):
    documents, labels = tables
    rows = quality.score(documents, quality.fit(documents, labels, 2000)).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held_out(r.doc_id, 5, 0) for r in rows)
    good, bad = accuracy(rows, labels, "quality")
    assert good > 0.97 and bad > 0.9


def test_maximal_segments_against_their_definition():
    """Ruzzo and Tompa: the best segment of all, then the same to its left and right."""

    def best(scores, a, b):
        spans = [(sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        top = max(spans, default=(0,))
        if top[0] <= 1e-12:
            return []
        _, _, _, i, j = top
        return [*best(scores, a, i), (i, j - 1, round(top[0], 6)), *best(scores, j, b)]

    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 16)
        hits = [(i, rng.uniform(0.1, 1.5)) for i in range(n) if rng.random() < 0.4]
        scores = [-0.25] * n
        for i, s in hits:
            scores[i] = s
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(hits, -0.25)]
        assert got == best(scores, 0, n)


def test_passages_are_located(spark):
    model = toxicity.Model(odds={"w:bad": 5.0, "w:worse": 4.0}, rate=1e-3, offset=-2, slope=1)
    docs = spark.createDataFrame([(1, "fine words. Bad and WORSE things, then " + "calm " * 60 + "bad!")], "doc_id long, text string")
    (row,) = toxicity.score(docs, model).collect()
    text = docs.first().text
    assert [text[p.start : p.end] for p in row.passages] == ["Bad and WORSE"]  # a repeated token scores once
    assert row.predicted == 1 and toxicity.clean(docs, model).count() == 0


def test_every_passage_scores_though_its_words_came_before(spark):
    odds = {f"w:bad{i}": 2.0 for i in range(6)}
    model = toxicity.Model(odds=odds, rate=1e-3, offset=-2, slope=1)
    bad = " ".join(f"bad{i}" for i in range(6))
    lone = " ".join(f"bad{i} " + "calm " * 2000 for i in range(6))  # each alone is below the threshold
    docs = spark.createDataFrame([(1, f"{bad} {'calm ' * 60}{bad} {'calm ' * 10}{bad}"), (2, lone + bad), (3, lone)], "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {d: [texts[d][p.start : p.end] for p in r.passages] for d, r in rows.items()}
    assert found[1][0] == bad and sum(p.count("bad0") for p in found[1]) == 3
    assert found[2] == [bad] and rows[2].predicted == 1
    assert found[3] == [] and rows[3].predicted == 0
    assert [r.doc_id for r in toxicity.clean(docs, model).collect()] == [3]


def test_one_word_repeated_does_not_dominate():
    scanner = toxicity.Scanner(toxicity.Model(odds={"w:bad": 5.0}))
    for gap in (0, 1, 5, 20, 40):
        _, found = scanner.segments(("bad " + "calm " * gap) * 200)
        assert max(s for *_, s in found) <= 5 * sum(1 / n for n in range(1, toxicity.REACH + 2)) and len(found) == 1


def test_fm_identity():
    rng = np.random.default_rng(2)
    model = quality.Model(0.1, rng.normal(size=quality.SLOTS), rng.normal(size=(quality.SLOTS, 4)))
    slots, x = np.array([3, 9, 40, 77]), rng.normal(size=4)
    pairs = sum(model.factors[slots[i]] @ model.factors[slots[j]] * x[i] * x[j] for i, j in itertools.combinations(range(4), 2))
    assert np.isclose(quality._margin(model, slots, x)[0], 0.1 + model.weights[slots] @ x + pairs)


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_odd_rows(spark, odd, none, operator):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, None), (None, 1, 1), (7, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    rows = operator.score(odd, operator.fit(odd, labels)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
    unfit = operator.fit(odd, labels.limit(0))
    assert operator.score(odd, unfit).count() == odd.count()
    assert operator.score(none, unfit).collect() == [] and operator.score(none, operator.fit(none, labels)).collect() == []


def test_words_that_share_a_slot_are_one_feature(monkeypatch):
    monkeypatch.setattr(quality, "WORDS", 4)
    slots, values = quality.Reader().read("one two three four five six seven one")
    words = slots < 4
    assert len(set(slots)) == len(slots) and words.sum() <= 4
    want = [(2 / 8) ** 0.5] + [(1 / 8) ** 0.5] * 6
    assert np.isclose(values[words].sum(), sum(want))


def test_an_id_in_every_row_is_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(500)] + [(2, None)], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    rows = common.labelled_rows(docs, chosen).collect()
    assert sorted((r.doc_id, r.label) for r in rows) == [(1, 1), (2, 0)]
