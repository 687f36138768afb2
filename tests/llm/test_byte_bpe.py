import base64
import hashlib

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from platelake.llm import byte_bpe
from tests.llm.conftest import awkward_rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


REF = reference()


def test_every_entry_is_one_piece():
    entries = byte_bpe.read_ranks(RANKS)
    bpe = byte_bpe.ByteBpe(entries)
    mapped = ["".join(byte_bpe.LETTERS[b] for b in e) for e in entries]
    assert bpe.model.encode(mapped) == [[k] for k in range(len(entries))]
    assert bpe.parts == entries


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_like_the_public_library(text):
    bpe = byte_bpe.ByteBpe.shared(RANKS)
    ids = [i for w in bpe.encode([text])[0] for i in w]
    assert ids == REF.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def check(rows, found):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = REF.encode_ordinary(t or "")
        want.append((str(i), len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted((str(r[0]), *r[1:4]) for r in found) == sorted(want)


def test_awkward_rows(awkward):
    got = byte_bpe.encode_decode(awkward, RANKS, with_ids=True).collect()
    check(awkward_rows(), got)
    assert next(bytes(r["decoded"]) for r in got if r["doc_id"] == 12) == b"two words"


def test_empty_table(empty):
    assert byte_bpe.encode_decode(empty, RANKS).collect() == []


def test_query(spark, corpus):
    from platelake.llm.queries import QUERIES

    check([(r["doc_id"], r["text"]) for r in corpus.collect()], QUERIES["op5_byte_bpe"](spark, "/root/testdata/sf0.001").collect())
