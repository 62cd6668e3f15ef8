import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    ranks = byte_bpe.read_ranks(PATH)
    own = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def numbers(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_same_ids_as_tiktoken_and_exact_round_trip(pair):
    own, other = pair
    rng = random.Random(3)
    pool = "abc the 'll's  \t\n\r\0\x1c\x85\xa0  ​　éßñ漢字😀٣½'RE don't<unk>▁ĀāĂ<|endoftext|>"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text in [*texts, "", "a" * 30_000, " " * 3_000, "x" * 5000 + " yes"]:
        ids = own.encode(text)
        assert numbers(ids) == other.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_rows_of_the_table(spark, sf, pair):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = pair[1].encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(odd, none, pair):
    out = byte_bpe.round_trip(odd, PATH, public_tokenizers.PATTERN).collect()
    assert len(out) == odd.count() and all(r.round_trip for r in out)
    assert [r.n_tokens for r in out if r.doc_id in (3, 4)] == [0, 0]
    assert byte_bpe.round_trip(none, PATH, public_tokenizers.PATTERN).collect() == []
