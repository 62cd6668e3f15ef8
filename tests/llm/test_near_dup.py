import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, near_dup


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """[(doc_id, n_shingles, component_id, kept)] by comparing every two different sets."""
    sets = [shingles(t) for _, t in rows]
    classes = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    least = {c: min((d for (d, _), s in zip(rows, sets) if s == c and d is not None), default=None) for c in classes}
    head = {c: c for c in classes}

    def find(c):
        while head[c] != c:
            c = head[c]
        return c

    for a, b in itertools.combinations(classes, 2):
        both = len(a & b)
        if 100 * both >= 75 * (len(a) + len(b) - both):
            head[find(a)] = find(b)
    groups = {}
    for c in classes:
        if least[c] is not None:
            groups[find(c)] = min(groups.get(find(c), least[c]), least[c])
    out = []
    for (d, _), s in zip(rows, sets):
        component = groups.get(find(s)) if s else d
        out.append((d, len(s), component, d is not None and d == component))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for g in range(12):  # groups whose copies differ by more and more words
        base = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(30, 120))]
        for k in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(k):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append((g * 100 + k, " ".join(words)))
    rows += [(5000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(40)]
    rng.shuffle(rows)
    check(spark, rows)


def test_one_large_group_of_near_copies(spark):
    """Links between copies that no pivot is linked with must be found."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_boundary_of_the_similarity(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i, cut in enumerate(range(40, 66, 2)):  # intersection over union passes 0.75
        other = [f"q{i}x{j}" for j in range(300)]
        text = [f"g{i}" + w for w in words]
        rows += [(10 * i, " ".join(text)), (10 * i + 1, " ".join(text[:-cut] + (other[:1] if i % 2 else [])))]
    check(spark, rows)


def test_odd_rows(spark, odd, none, long_text):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(odd).collect()), key=str)
    assert got == brute(rows)
    assert near_dup.near_duplicates(none).collect() == []
    left = near_dup.deduplicated(odd)
    assert left.columns == odd.columns
    # of the three equal texts one stays; all rows without words stay
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "None", "None"])
    assert near_dup.deduplicated(none).collect() == []


def test_one_row_of_a_group_stays(spark):
    """Also where several texts have the least id, or no row has one, or rows differ in other columns only."""
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base + " zz", "a"), (1, base, "a"), (2, base + " yy", "a"), (None, base + " xx", "a")]
    rows += [(None, other, "a"), (None, other + " zz", "a"), (None, other, "b")]
    rows += [(5, "alone " + " ".join(f"u{i}" for i in range(20)), s) for s in "cbacb"]
    rows += [(7, "", "a"), (7, "", "a"), (None, None, "a")]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
        got = sorted(map(tuple, near_dup.deduplicated(docs).collect()), key=str)
        texts = [t or "" for _, t, _ in got]
        assert sum(t.startswith("w0") for t in texts) == sum(t.startswith("v0") for t in texts) == sum(t.startswith("alone") for t in texts) == 1
        assert len(got) == 6 and [i for i, t, _ in got if (t or "").startswith("w0")] == [1]
        assert [s for i, _, s in got if i == 5] == ["a"]
        if seed:
            assert got == before
        before = got


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300) - 100, rng.randrange(300) - 100) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(7, 2000 + i) for i in range(100)]
    head = {}

    def find(x):
        head.setdefault(x, x)
        while head[x] != x:
            x = head[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    got = {r.node: r.component for r in components.components(df.filter(F.col("a") != F.col("b"))).collect()}
    assert got == {x: find(x) for x in got} and set(got) == {x for p in links if p[0] != p[1] for x in p}
