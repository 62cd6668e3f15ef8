import public_tokenizers

import corpus_pipeline
from tidemark.llm import byte_bpe, near_dup, toxicity
from tidemark.llm.queries import QUERIES


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dup", "substring", "mixing", "byte_bpe"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))  # the thirteen operators


def test_stages_one_by_one(spark, folder):
    sf = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs, seen = documents, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{folder}/{i}")
        seen[name] = docs = spark.read.parquet(f"{folder}/{i}")
        if name != "byte_bpe":
            assert docs.columns == documents.columns
    bad = {r.doc_id for r in toxicity.score(documents, toxicity.fit(documents, labels)).filter("predicted = 1").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert bad and ids(seen["toxicity"]) == ids(documents) - bad
    kept = {r.doc_id for r in near_dup.near_duplicates(seen["toxicity"]).filter("kept or n_shingles = 0").collect()}
    assert ids(seen["near_dup"]) == kept and seen["near_dup"].count() == len(kept)
    assert ids(seen["substring"]) == kept
    texts = {r.doc_id: r.text for r in seen["mixing"].collect()}
    codec = byte_bpe.Codec(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    rows = seen["byte_bpe"].collect()
    assert len(rows) == seen["mixing"].count()
    assert all(r.round_trip and codec.decode(r.ids).decode() == texts[r.doc_id] for r in rows)


def test_odd_rows(spark, odd, none):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).collect() == [], name
        stage(spark, odd, sf).collect()
