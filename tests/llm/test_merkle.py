import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm import merkle


def brute(rows):
    """{position: (edited sha256, n)} by descending id, from (doc_id, text)."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (doc, text), (_, following) in zip(order, [*order[1:], order[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), edited == text)
    return out


def test_edits_and_likeness(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = merkle.compared(docs).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint == r.edited_fingerprint) for r in rows} == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)
    prints = {}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_many_chunks_with_gaps_in_ids(spark):
    rows = [(i * i * 1_000_003 - 5_000_000_000, f"text number {i} " * (i % 7 + 1)) for i in range(400)] + [(1 << 62, "far away")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in merkle.compared(docs).collect()}
    assert got == {k: v[:2] for k, v in brute(rows).items()}


def test_no_python_runs(spark, sf):
    plan = merkle.compared(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pieces_keep_the_whole_text(spark, odd):
    lines = merkle.paragraphs(F.col("text"))
    whole = F.array_join(F.flatten(F.transform(lines, lambda p: F.regexp_extract_all(p, F.lit(merkle.PIECE), F.lit(0)))), "")
    for r in odd.select("text", F.array_join(lines, "").alias("a"), whole.alias("b")).collect():
        assert r.a == r.b == (r.text or "")


def test_differing_branch_locates_an_edit(spark):
    lines = [f"line {i} has its own words {i * 7919}\n" for i in range(200)]
    changed = [*lines[:90], "something new here\n", *lines[91:]]
    df = spark.createDataFrame([("".join(lines), "".join(changed))], "a string, b string")
    df = merkle.with_tree(merkle.with_tree(df, "a", "a_"), "b", "b_")
    row = df.select(
        "a_root", "b_root", F.size("a_sections").alias("n"), merkle.differing_sections(F.col("b_sections"), F.col("a_sections")).alias("d"),
        merkle.likeness(F.col("a_leaves"), F.col("b_leaves")).alias("near"),
    ).first()
    assert row.a_root != row.b_root and row.n > 8 and 1 <= len(row.d) <= 3 and 0.97 < row.near < 1


def test_odd_rows(odd, none):
    rows = merkle.compared(odd).collect()
    assert len(rows) == odd.count()
    assert {r.n_chars for r in rows if r.doc_id in (3, 4)} == {0}
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert merkle.compared(none).collect() == []
    (one,) = merkle.compared(odd.filter("doc_id = 1")).collect()
    assert one.near_next == 1  # the only row follows itself


def test_rows_of_one_id_and_without_ids_are_cut_too(spark):
    rows = [(7 if i % 2 else None, f"text number {i} " * (i % 5 + 1)) for i in range(300)] + [(7, "twice the same")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = merkle.in_chunks(docs, rows_per_chunk=10).filter("not _guest")
    assert chunks.filter("doc_id = 7").select("_chunk").distinct().count() > 4
    assert chunks.filter("doc_id is null").select("_chunk").distinct().count() > 4
    tie = {r["text"]: r.tie for r in docs.select("text", F.xxhash64("text").alias("tie")).collect()}
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], tie[r[1]]), reverse=True)
    want = []
    for (_, text), (_, following) in zip(order, [*order[1:], order[0]]):
        half = len(text) // 2
        want.append(hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in merkle.compared(docs).collect()) == sorted(want)


def brute_leaves(text):
    """Pieces by another way: words with the white space after them, up to four a piece, anew after a sentence's end."""
    out = set()
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        piece, n = re.match(r"\s*", line).group(), 0
        for word in re.findall(r"\S+\s*", line):
            piece, n = piece + word, n + 1
            if n == 4 or word.rstrip()[-1] in ".!?":
                out.add(piece)
                piece, n = "", 0
        if piece:
            out.add(piece)
    return out


def brute_likeness(a, b):
    a, b = brute_leaves(a), brute_leaves(b)
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


def test_likeness_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    order = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: -r[0])
    want = {}
    for (doc, text), (_, following) in zip(order, [*order[1:], order[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want[doc] = (brute_likeness(text, edited), brute_likeness(text, following))
    got = {r.doc_id: (r.near_edited, r.near_next) for r in merkle.compared(docs).collect()}
    off = {d: (got[d], want[d]) for d in want if max(abs(x - y) for x, y in zip(got[d], want[d])) > 1e-12}
    assert set(got) == set(want) and not off
