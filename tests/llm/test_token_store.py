import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from platelake.llm import token_store as ts
from platelake.llm.shared import fresh_path
from tests.llm.conftest import awkward_rows

JSON = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing_round_trip_and_random_access(width, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**width - 1), max_size=60)), np.uint32)
    packed = ts.pack(ids, width)
    assert len(packed) == (len(ids) * width + 7) // 8
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert ts.unpack(packed, width, a, b).tolist() == ids[a:b].tolist()


def test_width_is_the_least():
    assert [ts.width_of(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


def test_shard_with_odd_width_and_random_access(monkeypatch):
    monkeypatch.setattr(ts, "BLOCK_IDS", 10)
    docs = [(i if i != 3 else None, np.arange(i, dtype=np.uint32) % 900) for i in range(12)]
    data = b"".join(r + b"\n" for r in ts.records(iter(docs), 10, 7))
    shard = ts.Shard(data)
    assert (shard.number, shard.n_docs, shard.n_ids) == (7, 12, sum(len(x) for _, x in docs))
    assert [(i, x.tolist()) for i, _, x in shard.documents()] == [(i, x.tolist()) for i, x in docs]
    assert [shard.document(n).tolist() for n in (0, 5, 11)] == [docs[n][1].tolist() for n in (0, 5, 11)]
    with pytest.raises(IndexError):
        shard.document(12)
    ids = [None, None, None, 2, 2, 2, 5, 7, 7, 7, 7, 9]
    named = ts.Shard(b"".join(r + b"\n" for r in ts.records(iter([(i, np.full(4, n, np.uint32)) for n, i in enumerate(ids)]), 10, 0)))
    for i in (-3, 0, 2, 3, 5, 7, 9, 11):
        assert list(named.find(i)) == [n for n, x in enumerate(ids) if x == i]
        assert all(named.document(n).tolist() == [n] * 4 for n in named.find(i))
    with pytest.raises(ValueError):
        ts.Shard(data[:-9])


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x0b\x1c\x85 　abThe'sé1²½٣.,!%😀中́ß<|endoftext|>"), max_size=24))
def test_pieces_encode_like_whole_texts(tokenizer, text):
    encode = ts.PieceEncoder.shared(JSON, 1000)
    assert encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_the_library_has_them(tokenizer):
    encode = ts.PieceEncoder.shared(JSON, 1000)
    texts = ["hello <|endoftext|> there", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "plain"]
    assert [x.tolist() for x in encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in encode(texts)[0]


def test_cache_turns_keep_results(tokenizer):
    encode = ts.PieceEncoder(JSON, 20)
    texts = [f"word{i} common, tail{i}. foo" for i in range(60)]
    for t in texts + texts:
        assert encode([t])[0].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def held(docs_rows, found, tokenizer):
    order = sorted(docs_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, want = 0, []
    for i, t, *_ in order:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    key = lambda r: (r[1],)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_files_hold_every_document(spark, awkward, tokenizer):
    path = fresh_path(spark, "t")
    ts.write_tokens(awkward, path, ts.byte_bpe_encoder(JSON), 50_257)
    got = ts.read_tokens(spark, path, with_ids=True).collect()
    held(awkward_rows(), [r[:4] for r in got], tokenizer)
    one = next(r for r in got if r["doc_id"] == 14)
    assert one["ids"][:-1] == tokenizer.encode(awkward_rows()[15][1], add_special_tokens=False).ids and one["ids"][-1] == 0


def test_one_identifier_over_many_shards(spark, tokenizer):
    rows = [(None, f"text {k % 7}") for k in range(300)] + [(5, "same")] * 100
    path = fresh_path(spark, "t")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ts.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, ts.byte_bpe_encoder(JSON), 50_257)
        got = ts.read_tokens(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert spark.read.format("binaryFile").load(path).filter("length > 0").count() > 8
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [None] * 300 + [5] * 100


def test_empty_table(spark, empty):
    path = fresh_path(spark, "t")
    ts.write_tokens(empty, path, ts.byte_bpe_encoder(JSON), 50_257)
    assert ts.read_tokens(spark, path).collect() == []


def test_query(spark, corpus, tokenizer):
    from platelake.llm.queries import QUERIES

    got = QUERIES["op1_token_store"](spark, "/root/testdata/sf0.001").collect()
    held([(r["doc_id"], r["text"]) for r in corpus.collect()], got, tokenizer)
