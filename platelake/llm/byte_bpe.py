"""Byte-level BPE by a sentencepiece model that is serialised straight from a vocabulary of ranks.

Each vocabulary entry becomes a piece whose bytes are written as one letter each, scored by its negative rank, with identity
normalisation. sentencepiece merges the neighbouring pair whose union scores highest, leftmost first, and that is the merge of
lowest rank. Texts are cut into pre-tokens first, and each is encoded separately; decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def byte_letters() -> list[str]:
    """A printable letter for each byte: Latin-1's own where it prints, else the next one from U+0100 on."""
    letters, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


LETTERS = dict(enumerate(byte_letters()))
BYTES = {c: b for b, c in LETTERS.items()}


def read_ranks(path: str) -> list[bytes]:
    """Entries of a rank file, by rank."""
    with open(path, "rb") as lines:
        entries = [line.split() for line in lines if line.strip()]
    ranks = {int(rank): base64.b64decode(entry) for entry, rank in entries}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[r] for r in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = b""
    n &= (1 << 64) - 1
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def serialise_model(entries: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: ids are ranks; the unknown piece that the format demands comes last and is never produced."""
    # Field numbers and enum values of the public model format.
    normal, unknown, bpe = 1, 2, 2
    pieces = b"".join(_bytes(1, _bytes(1, "".join(LETTERS[b] for b in e).encode()) + _float(2, -float(rank)) + _number(3, normal)) for rank, e in enumerate(entries))
    pieces += _bytes(1, _bytes(1, b"<unk>") + _float(2, 0.0) + _number(3, unknown))
    trainer = _number(3, bpe) + _number(4, len(entries) + 1) + _number(40, len(entries)) + _number(41, -1) + _number(42, -1) + _number(43, -1)
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + _bytes(2, trainer) + _bytes(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one vocabulary; keeps the ids of pre-tokens it has met in a bounded cache."""

    _shared: dict[str, ByteBpe] = {}

    def __init__(self, entries: list[bytes], pattern: str = public_tokenizers.PATTERN, cache: int = 300_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(entries))
        self.split = regex.compile(pattern).findall
        self.limit, self.cache = cache, {}
        # The inverse mapping, by way of the pieces of the model itself.
        self.parts = [bytes(BYTES[c] for c in self.model.id_to_piece(i)) for i in range(len(entries))]

    @classmethod
    def shared(cls, path: str) -> ByteBpe:
        """One for each worker process."""
        if path not in cls._shared:
            cls._shared[path] = cls(read_ranks(path))
        return cls._shared[path]

    def encode(self, texts: list[str]) -> list[list[list[int]]]:
        """For each text the ids of each of its pre-tokens."""
        if len(self.cache) > self.limit:
            self.cache.clear()
        cut = [self.split(t) for t in texts]
        cache = self.cache
        if missing := list({w for x in cut for w in x if w not in cache}):
            mapped = [w.encode().decode("latin-1").translate(LETTERS) for w in missing]
            cache.update(zip(missing, self.model.encode(mapped, num_threads=1)))
        get = cache.__getitem__
        return [list(map(get, x)) for x in cut]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids."""
        return b"".join(map(self.parts.__getitem__, ids))


def encode_decode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each whole text and decode the ids: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the decoded bytes. Null texts count as empty:
    no ids, the digests of nothing. Rows map one to one, repeated rows and null identifiers included; texts of any length
    are encoded whole; other columns are not read. An empty input gives an empty result.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(ranks)
        for b in parts:
            for k in range(0, b.num_rows, 256):
                some = b.slice(k, 256)
                rows = []
                for words in bpe.encode([t or "" for t in some.column(1).to_pylist()]):
                    ids = [i for w in words for i in w]
                    whole = bpe.decode(ids)
                    rows.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(whole).hexdigest(), ids if with_ids else None, whole if with_ids else None))
                n, a, d, ids, whole = zip(*rows)
                arrays, names = [some.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32())), pa.array(whole, pa.binary())], [*names, "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
