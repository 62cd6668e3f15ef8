import random

import numpy as np

from tidemark.llm import substring


def prose(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(n))


def test_gear_hash_is_the_sum_over_sixteen_bytes():
    data = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    gear = substring._GEAR.astype(int)
    want = [sum(int(gear[data[i - j]]) << j for j in range(min(16, i + 1))) % 65536 for i in range(300)]
    assert substring.gear_hashes(data).tolist() == want


def test_chunks_join_to_the_text_and_resist_insertions():
    rng = random.Random(2)
    text = prose(rng, 400) + "\n é漢 \t" + prose(rng, 100)
    cuts, words, digests = substring.chunks(text)
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(cuts, cuts[1:])) == raw and words.sum() == len(raw.split())
    changed = substring.chunks(text[:500] + " inserted words " + text[500:])[2]
    assert len(set(digests) - set(changed)) <= 3


def test_passages_are_cut_from_later_documents_only(spark):
    rng = random.Random(3)
    passages = [prose(rng, 55) for _ in range(30)]
    rows, clean = [], {}
    for i, p in enumerate(passages):
        for k in range(3):
            rows.append((10 * i + k, f"{prose(rng, 40)} {p} {prose(rng, 40)}"))
    for i in range(60):
        clean[1000 + i] = prose(rng, 80)
    df = spark.createDataFrame(rows + list(clean.items()), "doc_id long, text string").repartition(5)
    out = {r.doc_id: r for r in substring.dedup(df).collect()}
    texts = dict(rows)
    assert all(out[d].text == t and out[d].removed_chars == 0 for d, t in clean.items())
    for d, t in rows:
        r = out[d]
        assert r.text == "".join(t[a:b] for a, b in zip([0] + [x.end for x in r.removed], [x.start for x in r.removed] + [len(t)]))
        assert r.removed_chars == len(t) - len(r.text)
        if d % 10 == 0:
            assert r.removed_chars == 0  # the first occurrence stays
        else:
            place = t.index(passages[d // 10])
            assert all(place - 1 <= x.start and x.end <= place + len(passages[d // 10]) + 1 for x in r.removed)
    caught = [out[d].removed_words >= 25 for d, _ in rows if d % 10]
    assert np.mean(caught) > 0.9 and np.mean([out[d].removed_words > 0 for d in texts if d % 10]) > 0.98


def test_every_kind_of_passage_is_cut(spark):
    """51 words of prose, of few words and of equal lines, and stretches without white space: none stays whole."""
    rng = random.Random(5)
    few = [[rng.choice(["no", "yes", "well", f"w{i}"]) for _ in range(51)] for i in range(200)]
    passages = [prose(rng, 51) for _ in range(200)]
    passages += [" ".join(w) for w in few] + [" ".join([f"la{i}"] * 51) for i in range(100)]
    passages += [" ".join([f"the line {i}"] * 17) for i in range(100)]
    passages += ["".join(rng.choice("abcdefgh0123456789") for _ in range(300)) for _ in range(100)]
    passages += ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(200)) for _ in range(100)]
    rows = [(2 * i + k, f"{prose(rng, 40)} {p} {prose(rng, 40)}") for i, p in enumerate(passages) for k in range(2)]
    rows += [(10_000 + k, prose(rng, 3) + "".join(["界", x, "世"])) for k, x in enumerate([passages[-1]] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = {r.doc_id: r for r in substring.dedup(df).collect()}
    assert [p for i, p in enumerate(passages) if out[2 * i + 1].removed_words < 16] == []
    assert all(out[10_000 + k].removed_words >= 16 for k in range(2))


def test_no_window_lacks_a_cut():
    rng = random.Random(6)
    for text in (prose(rng, 500), "la " * 500, " ".join(rng.choice("ab") for _ in range(500))):
        cuts, words, _ = substring.chunks(text)
        assert words.max() <= 2 * substring.WINDOW and words.sum() == 500 and (np.diff(cuts) > 0).all()
    for text in ("x" * 2000, "界" * 2000):
        cuts, _, _ = substring.chunks(text)
        assert np.diff(cuts).max() <= 2 * substring.WINDOW_CHARS * len(text[0].encode())


def brute(rows):
    """{doc_id: new text} by one pass over the documents in order."""
    seen, out = {}, {}
    for d, t in sorted(rows):
        if not t:
            out[d] = t
            continue
        cuts, words, digests = substring.chunks(t)
        numbers = substring._signed(digests)
        runs = substring.repeated_runs(numbers, words, {x for x in numbers if x in seen})
        raw, kept, at = t.encode(), b"", 0
        for a, b in runs:
            kept, at = kept + raw[at : cuts[a]], cuts[b]
        out[d] = (kept + raw[at:]).decode()
        seen.update(dict.fromkeys(numbers))
    return out


def test_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.text for r in substring.dedup(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd, none):
    out = substring.dedup(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and [c for c in odd.columns if c not in out.columns] == []
    assert {r.text for r in rows if r.doc_id in (3, 4)} == {None, ""}
    assert len({r.text for r in rows if r.doc_id == 2}) == 1
    assert substring.dedup(none).collect() == []


def test_a_digest_in_every_text_is_split(spark):
    """A stock passage that all texts hold: the join splits its rows, and all but the first occurrence go."""
    rng = random.Random(7)
    stock = prose(rng, 60)
    rows = [(i, f"{prose(rng, 30)} {stock} {prose(rng, 30)}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    names = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        found = substring.repeated_chunks(df.selectExpr("doc_id", "text", "doc_id as _key"))
        got = {r._key for r in found.collect()}
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert got == set(range(1, 4000))
