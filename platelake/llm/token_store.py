"""Token identifiers in fixed-width bit-packed files.

A file is a shard: a consecutive range of documents in ascending order of their identifiers. It holds blocks and a footer:

    block   'PLB1', width u8, 3 zero bytes, n_docs u32, n_ids u64, doc ids i64[n_docs], known u8[n_docs],
            ends u64[n_docs] (running count of ids), packed ids, padded to 8 bytes, then one line feed
    footer  'PLF2', shard u32, n_blocks u32, n_docs u64, n_ids u64, block offsets u64[n_blocks], documents before each block
            u64[n_blocks], first doc id of each block i64[n_blocks], whether it is known u8[n_blocks], footer offset u64, 'PLE1',
            then one line feed

Each id takes the bits that the vocabulary needs, lowest bit first, so that numpy unpacks any range of a block at once. A
document is found by two binary searches, by its place or by its identifier: over the footer's blocks, then within one block.
Spark's own writer puts the records into files (they are rows whose line end is the final line feed), so any store that Spark
reaches will do and lost tasks are committed once.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platelake.llm.byte_bpe import byte_letters
from platelake.llm.shared import n_partitions, staged

#: Ids in a block; one longer document makes one longer block.
BLOCK_IDS = 1 << 16
#: Bytes of text in a shard, about.
SHARD_BYTES = 128 << 20
_HEAD = struct.Struct("<4sB3xIQ")
_FOOT = struct.Struct("<4sIIQQ")


def width_of(vocabulary: int) -> int:
    """Bits for ids from 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """ids in width bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, width: int, start: int, stop: int) -> np.ndarray:
    """The ids from start to stop of packed data, as unsigned 32-bit integers; only their bytes are touched."""
    n = stop - start
    if n <= 0:
        return np.zeros(0, np.uint32)
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n, start * width // 8).astype(np.uint32)
    first, skip = divmod(start * width, 8)
    raw = np.frombuffer(data, np.uint8, (skip + n * width + 7) // 8, first)
    bits = np.unpackbits(raw, bitorder="little")[skip : skip + n * width].reshape(n, width)
    return bits @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def block_record(docs: list[tuple[int | None, np.ndarray]], width: int) -> bytes:
    """One block of (identifier, ids)."""
    ids = np.concatenate([x for _, x in docs])
    names = np.array([0 if i is None else i for i, _ in docs], "<i8")
    known = np.array([i is not None for i, _ in docs], np.uint8)
    ends = np.cumsum([len(x) for _, x in docs]).astype("<u8")
    body = _HEAD.pack(b"PLB1", width, len(docs), len(ids)) + names.tobytes() + known.tobytes() + ends.tobytes() + pack(ids, width)
    return body + b"\0" * (-len(body) % 8)


def records(docs: Iterator[tuple[int | None, np.ndarray]], width: int, shard: int) -> Iterator[bytes]:
    """The records of one shard, without the line feeds that end them; none if there is no document."""
    offsets, starts, firsts, at, held, size, n_docs, n_ids = [], [], [], 0, [], 0, 0, 0

    def cut() -> bytes:
        nonlocal at
        block = block_record(held, width)
        offsets.append(at)
        starts.append(n_docs - len(held))
        firsts.append(held[0][0])
        at += len(block) + 1
        return block

    for doc, ids in docs:
        held.append((doc, ids))
        size, n_docs, n_ids = size + len(ids), n_docs + 1, n_ids + len(ids)
        if size >= BLOCK_IDS:
            yield cut()
            held, size = [], 0
    if held:
        yield cut()
    if n_docs:
        names = np.array([0 if i is None else i for i in firsts], "<i8").tobytes() + bytes(i is not None for i in firsts)
        yield _FOOT.pack(b"PLF2", shard, len(offsets), n_docs, n_ids) + np.array([*offsets, *starts], "<u8").tobytes() + names + struct.pack("<Q", at) + b"PLE1"


class Shard:
    """A shard's bytes, opened for reading."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        if bytes(self.data[-5:]) != b"PLE1\n":
            raise ValueError("not a whole token file")
        at = struct.unpack_from("<Q", self.data, len(data) - 13)[0]
        _, self.number, n, self.n_docs, self.n_ids = _FOOT.unpack_from(self.data, at)
        at += _FOOT.size
        self.offsets = np.frombuffer(self.data, "<u8", n, at).tolist()
        self.starts = np.frombuffer(self.data, "<u8", n, at + 8 * n).tolist()
        firsts = np.frombuffer(self.data, "<i8", n, at + 16 * n).tolist()
        known = np.frombuffer(self.data, np.uint8, n, at + 24 * n).tolist()
        self.firsts = [(bool(k), i) for i, k in zip(firsts, known)]  # documents without an identifier come first

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable[[int, int], np.ndarray]]:
        """Identifiers, which of them are known, running ends and a reader of id ranges of block k; nothing is copied."""
        at = self.offsets[k]
        magic, width, n, _ = _HEAD.unpack_from(self.data, at)
        if magic != b"PLB1":
            raise ValueError("broken block")
        names = np.frombuffer(self.data, "<i8", n, at := at + _HEAD.size)
        known = np.frombuffer(self.data, np.uint8, n, at := at + 8 * n)
        ends = np.frombuffer(self.data, "<u8", n, at := at + n)
        body = self.data[at + 8 * n :]
        return names, known, ends, lambda a, b: unpack(body, width, a, b)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(identifier, ids before it in this shard, its ids), block by block."""
        before = 0
        for k in range(len(self.offsets)):
            names, known, ends, read = self.block(k)
            ids = read(0, int(ends[-1]))
            a = 0
            for name, ok, b in zip(names.tolist(), known.tolist(), ends.tolist()):
                yield name if ok else None, before + a, ids[a:b]
                a = b
            before += a

    def document(self, n: int) -> np.ndarray:
        """The ids of the shard's n-th document alone, by random access."""
        if not 0 <= n < self.n_docs:
            raise IndexError(n)
        k = bisect_right(self.starts, n) - 1
        _, _, ends, read = self.block(k)
        n -= self.starts[k]
        return read(int(ends[n - 1]) if n else 0, int(ends[n]))

    def find(self, doc_id: int) -> range:
        """Places of the documents of this identifier, for document(); empty if there is none."""
        low, high = bisect_left(self.firsts, (True, doc_id)) - 1, bisect_right(self.firsts, (True, doc_id)) - 1

        def place(k: int, side: str) -> int:
            if k < 0:
                return 0
            names, known, _, _ = self.block(k)
            unknown = len(known) - int(np.count_nonzero(known))
            return self.starts[k] + unknown + int(np.searchsorted(names[unknown:], doc_id, side))

        return range(place(low, "left"), place(high, "right"))


def write_tokens(docs: DataFrame, path: str, encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]], vocabulary: int, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write shards below path, ascending by identifier.

    encoder makes, on the executor, a function from texts to arrays of ids. end_id is appended to each document. Null texts
    count as empty; null identifiers come first and stay null; repeated rows are all written, rows of one identifier in the order
    of their texts' first characters and a hash. Shards are ranges of about SHARD_BYTES of text, in which rows of one identifier
    (or of none) may spread over many. An empty table gives files without records. Other columns are not read.
    """
    width = width_of(vocabulary)

    def shard(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(), TaskContext.get().partitionId()
        tail = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)

        def encoded() -> Iterator[tuple[int | None, np.ndarray]]:
            for b in parts:
                for k in range(0, b.num_rows, 512):
                    some = b.slice(k, 512)
                    for i, ids in zip(some.column(0).to_pylist(), encode([t or "" for t in some.column(1).to_pylist()])):
                        yield i, np.concatenate([ids, tail])

        for r in records(encoded(), width, number):
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.binary())], names=["record"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = ["doc_id", "head", "hash", "nth"]  # what a range ends at stays short
    spread = rows.withColumns({"head": F.substring("text", 1, 32), "hash": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    ordered = spread.repartitionByRange(max(n_partitions(docs.sparkSession), size // SHARD_BYTES), *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    ordered.mapInArrow(shard, "record binary").select(F.col("record").cast("string").alias("record")).write.option("lineSep", "\n").option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("content")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of the files below path: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids."""

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for data in b.column(0):
                shard = Shard(data.as_py())
                rows: list[tuple] = []
                for name, at, ids in shard.documents():
                    rows.append((shard.number, name, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids if with_ids else None))
                    if len(rows) >= 1000:
                        yield whole(rows)
                        rows = []
                if rows:
                    yield whole(rows)

    def whole(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))]
        names = ["shard", "doc_id", "at", "n_tokens", "ids_crc32"]
        if with_ids:
            arrays, names = [*arrays, pa.array(cols[5], pa.list_(pa.int64()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    docs = staged(_files(spark, path).mapInArrow(documents, schema), "token-documents")
    # One row a file: the running sum over files is small whatever the corpus.
    sums = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    return docs.join(before, "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def byte_bpe_encoder(tokenizer_json: str, cache: int = 250_000) -> Callable[[], Callable[[list[str]], list[np.ndarray]]]:
    """An encoder by the tokenizers library for write_tokens.

    A blank that follows a character other than white space always starts a pre-token, so texts are cut there and each
    different piece is encoded once while the bounded cache holds it. Texts that hold one of the tokenizer's added tokens
    literally are left to the library as they are.
    """
    return lambda: PieceEncoder.shared(tokenizer_json, cache)


class PieceEncoder:
    """Encodes texts piece by piece with a byte-level tokenizer. The cache has two generations, so that common pieces outlive its turns."""

    _shared: dict[str, PieceEncoder] = {}
    _gap = re.compile(r"\s ")
    #: White space of ASCII before a blank.
    _gaps = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ", "\x1c ", "\x1d ", "\x1e ", "\x1f ")

    def __init__(self, tokenizer_json: str, cache: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_json)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # this class has its own
        self.limit = cache
        # By what follows the blank of a piece; self.other by whole pre-tokens or pieces without one.
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.other: dict[str, bytes] = {}
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = dict(enumerate(byte_letters()))

    @classmethod
    def shared(cls, tokenizer_json: str, cache: int) -> PieceEncoder:
        """One for each worker process."""
        if tokenizer_json not in cls._shared:
            cls._shared[tokenizer_json] = cls(tokenizer_json, cache)
        return cls._shared[tokenizer_json]

    def pieces(self, text: str) -> list[str]:
        """The first piece, and the others without the blank that each starts with; cuts are made before blanks that follow other than white space."""
        cut = text.split(" ")
        if not (any(g in text for g in self._gaps) if text.isascii() else self._gap.search(text)) and cut[0]:
            return cut
        found, last = [], cut[0]
        for p in cut[1:]:
            if last and not last[-1].isspace():
                found.append(last)
                last = p
            else:
                last += " " + p
            if last == "" and found:
                last = " "
                found, last = found[:-1], found[-1] + last
        return [*found, last]

    def whole(self, piece: str) -> bytes:
        """The ids of a piece. Where all characters are Latin, whose classes no Unicode version changes, the splitting is done here
        and only the merges by the library's model; other pieces take the library's whole path."""
        if piece and max(piece) >= "\u0250":
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        return b"".join([self.word(w) for w in self.split(piece)])

    def word(self, word: str) -> bytes:
        """The ids of one pre-token."""
        spaced = word[0] == " " and len(word) > 1 and not word[1].isspace()
        home, key = (self.cache, word[1:]) if spaced else (self.other, word)
        found = home.get(key)
        if found is None:
            found = home[key] = array("I", [t.id for t in self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]).tobytes()
        return found

    def fill(self, missing: set[str]) -> None:
        """Bring pieces into the cache, from its older generation or anew. Letters alone are one pre-token, and so are they before a last mark."""
        cache, old, other, tokenize, letters = self.cache, self.old, self.other, self.tokenizer.model.tokenize, self.letters
        marks = {m: other.get(m) or self.word(m) for m in ".,"}
        for p in missing:
            ids = old.get(p)
            if ids is None:
                tail = b""
                w = p
                if p[-1:] in marks:
                    tail, w = marks[p[-1]], p[:-1]
                if w.isalpha() and (w.isascii() or max(w) < "\u0250"):
                    ids = cache.get(w) or old.get(w) if tail else None
                    if ids is None:
                        ids = array("I", [t.id for t in tokenize("\u0120" + w if w.isascii() else "\u0120" + w.encode().decode("latin-1").translate(letters))]).tobytes()
                    ids += tail
                else:
                    ids = self.whole(" " + p)
            cache[p] = ids

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) > self.limit:
            self.cache, self.old = {}, self.cache
        if len(self.other) > self.limit:
            self.other = {}
        added = [any(a in t for a in self.added) for t in texts]
        cut = [self.pieces("" if x else t) for x, t in zip(added, texts)]
        heads = [self.whole(x.pop(0)) for x in cut]
        self.fill(set().union(*cut).difference(self.cache))
        get = self.cache.__getitem__
        found = [np.frombuffer(b"".join([h, *map(get, x)]), np.uint32) for h, x in zip(heads, cut)]
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) if x else f for x, t, f in zip(added, texts, found)]
