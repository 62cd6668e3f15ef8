import random
import re

import pytest

from tidemark.llm import licenses


def shingles(text):
    w = re.findall(licenses.WORD, text.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_notices_in_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    want = set()
    for r in docs.collect():
        own = shingles(r.text)
        want |= {(r.doc_id, n) for n, t in licenses.TEMPLATES.items() if shingles(t) <= own}
    assert want and got >= want
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, n in got - want:  # more than a part of a template, as far as it is there at all
        assert len(shingles(licenses.TEMPLATES[n]) & shingles(texts[d])) >= 0.75 * len(shingles(licenses.TEMPLATES[n]))


def test_every_place_and_partial_copies(spark):
    rng = random.Random(4)
    fill = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, want = [], {}
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 12):
        words = text.split()
        if i % 3 == 1 and len(words) > 40:
            words[len(words) // 2] = "changed"  # five shingles fewer
        rows.append((i, f"{fill(rng.randrange(120))} {' '.join(words)} {fill(rng.randrange(120))}"))
        want[i] = (name, " ".join(words))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, {})[r.license] = r
    texts = dict(rows)
    for i, (name, copy) in want.items():
        r = got[i][name]
        assert r.containment >= 0.75
        assert texts[i][r.start : r.end].strip(' "()') in copy and len(texts[i][r.start : r.end]) > 0.9 * len(copy)


def test_odd_rows(odd, none):
    assert licenses.scan(odd).collect() == []
    (one,) = licenses.scan(odd, {"t": "alpha beta gamma delta epsilon zeta eta theta"}).filter("doc_id = 1").collect()
    assert (one.start, one.end, one.containment) == (0, 45, 1.0)
    assert licenses.scan(odd, {"t": "alpha beta gamma delta epsilon"}).count() == 3
    assert licenses.scan(none).collect() == []
    with pytest.raises(ValueError, match="fewer than 5"):
        licenses.Scanner({"short": "too few words"})


def windows_by_brute_force(text, templates):
    """{(template, window)}: every window of the grid that holds a template's shingles to 75 percent."""
    w = re.findall(licenses.WORD, text.lower())
    z = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = {}
    for name, template in templates.items():
        own = shingles(template)
        length = licenses.length_class(len(own))
        for start in range(0, len(z), length):
            window = z[start : start + 2 * length]
            inside = [start + k for k, s in enumerate(window) if s in own]
            if len(set(window) & own) >= 0.75 * len(own):
                out.setdefault(name, []).append((len(set(window) & own) / len(own), inside[0], inside[-1] + 4))
    return out


def united(finds):
    """Overlapping finds are one."""
    out = []
    for share, a, b in finds:
        if out and a <= out[-1][2]:
            out[-1] = (max(share, out[-1][0]), min(a, out[-1][1]), max(b, out[-1][2]))
        else:
            out.append((share, a, b))
    return out


def test_every_window_of_75_percent_is_found(sf):
    """All texts of the table, and texts of damaged copies, against every window of every template."""
    import duckdb

    rng = random.Random(8)
    texts = [t for (t,) in duckdb.sql(f"select text from '{sf}/documents.parquet'").fetchall() if t]
    notices = sorted(licenses.TEMPLATES.values())
    for _ in range(60):
        words = []
        for notice in rng.sample(notices, 3):
            copy = notice.split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [f"x{rng.randrange(1000)}"]
            words += [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(60))] + copy
        texts.append(" ".join(words))
    scanner, finds = licenses.Scanner(licenses.TEMPLATES), 0
    for text in texts:
        want = {n: united(f) for n, f in windows_by_brute_force(text, licenses.TEMPLATES).items()}
        got = {}
        for name, *find in scanner.scan(text):
            got.setdefault(name, []).append(tuple(find))
        assert got == want
        finds += len(want)
    assert finds > 100


def test_classes_grow_by_a_quarter():
    lengths = sorted({licenses.length_class(n) for n in range(1, 3000)})
    assert all(b <= max(a + 1, a * 5 // 4) for a, b in zip(lengths, lengths[1:]))
    # a template of a class has more shingles than the class before, so a window holds at most 2.5 times as many
    assert all(2 * licenses.length_class(n) <= 2.5 * n for n in range(4, 3000))
    assert len(licenses.TEMPLATES) > 60 and (8 / 11) ** licenses.BANDS < 3e-6
