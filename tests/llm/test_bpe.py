"""Byte-level BPE against the tiktoken library, and the exact round trip."""

import hashlib
import random
import tracemalloc

import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken

from qalathe.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = ["a", "the", " ", "  ", "\n", "\n\n", "\r\n", "\t", "'s", "é", "漢字", "😀", "12", ".", ", ", "<|endoftext|>", "\x1f", "\xa0", "ſ"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_units_encode_as_whole_texts(reference):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, "", " ", "a "]
    ids, bounds = bpe.UnitEncoder(bpe.rank_tokenizer(RANKS, P.PATTERN))(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == reference.encode_ordinary(text or ""), repr(text)


def test_a_full_memory_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KNOWN_UNITS", 3)
    run = bpe.UnitEncoder(bpe.rank_tokenizer(RANKS, P.PATTERN))
    for text in ("some words and some more", "other words\nand some", "some words and some more"):
        assert run(pa.array([text]))[0].tolist() == reference.encode_ordinary(text)


def test_the_library_gets_few_texts_at_once(reference):
    tokenizer, most = bpe.rank_tokenizer(RANKS, P.PATTERN), []

    class Noted:
        get_vocab = tokenizer.get_vocab

        def encode_batch_fast(self, texts, **options):
            most.append(len(texts))
            return tokenizer.encode_batch_fast(texts, **options)

    texts = [f"word{k} and\u2003more\t{k}" for k in range(100)]
    ids, bounds = bpe.UnitEncoder(Noted())(pa.array(texts))
    assert max(most) <= bpe.ENCODED_AT_ONCE
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [reference.encode_ordinary(t) for t in texts]


def test_file_tokenizer_takes_special_tokens_as_text():
    tokenizer = bpe.file_tokenizer(P.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|> a", "x<|endoftext|>"]
    ids, bounds = bpe.UnitEncoder(tokenizer)(pa.array(texts))
    assert 50256 not in ids
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_round_trip_of_odd_rows(odd_docs, no_docs, reference):
    rows = bpe.round_trip(odd_docs, RANKS, P.PATTERN).collect()
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    want = []
    for none, doc_id, text in texts:
        ids = reference.encode_ordinary(text)
        want.append((none, doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(no_docs, RANKS, P.PATTERN).collect() == []


def test_offsets_and_decoding(spark):
    docs = spark.createDataFrame([(1, "ab é😀 x")], "doc_id long, text string")
    row = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN, offsets=True), RANKS).head()
    assert row.decoded == "ab é😀 x".encode() and row.starts[0] == 0 and row.ends[-1] == 7
    assert len(row.ids) == len(row.starts) == len(row.ends)
    plain = bpe.encode(docs.withColumnRenamed("doc_id", "ids"), RANKS, P.PATTERN).head()
    assert list(plain.ids) == list(row.ids)


def test_encoder_holds_the_places_of_few_ids():
    run = bpe.UnitEncoder(bpe.file_tokenizer(P.path("byte_bpe_50k.json")))
    texts = pa.array([" a" * 400_000])
    want = run(texts)[0].copy()
    tracemalloc.start()
    try:
        ids, _ = run(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (ids == want).all() and len(ids) == 400_000
    assert peak < 46 * len(ids)
