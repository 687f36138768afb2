"""Substring deduplication by level-wise doubling over words.

A window of 35 words is repeated only if what it holds is repeated at every shorter length, so lengths are taken in turn, each
about twice the one before (9, 18, 35). At a level every window that is still a candidate names the least-hashed run of that
length within it: equal windows name equal runs, and neighbouring windows mostly name the same, so that a few runs stand for
all. Runs that occur once drop their windows; the windows that are left are extended to the next length, until the runs are the
windows themselves or no candidate survives.

Words are named by 128-bit hashes of their bytes, and the name of a run is mixed from the names of its two halves, which overlap
where the length is odd; no sum of powers is taken, so that patterns of words cannot cancel out. Shorter runs are compared by
64 bits, as a chance collision there only keeps a candidate; windows are compared by all 128 bits.

Documents are packed into chunks, rows of a stored table that is bucketed by chunk. A chunk sends each level's hashes as one
packed array for each range of hashes, and gets back one bit a hash, so that windows never become rows and texts are dealt out
once: the answers meet them in their buckets. A very common passage costs one hash a chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.shared import bucketed, byte_column, discard, n_partitions, staged

#: Bytes of text in a chunk; one longer document makes one longer chunk.
CHUNK = 2 << 20
#: Bytes of text for each range of hashes, and the fewest ranges: a range's hashes fit in a task, and messages stay long.
RANGE, RANGES = 64 << 20, 16
_ODD, _EVEN = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

_CHUNKS = "chunk long, ids binary, known binary, sizes binary, texts binary, bytes long"


def levels(window: int) -> list[int]:
    """Lengths that double up to the window: 9, 18, 35 for 35."""
    found = [window]
    while found[-1] > 9:
        found.append((found[-1] + 1) // 2)
    return found[::-1]


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for b in parts:
        raw, at = byte_column(b.column(1))
        ids, known = b.column(0).fill_null(0).to_numpy(), b.column(0).is_valid().to_numpy(zero_copy_only=False)
        a = 0
        while a < b.num_rows:
            z = max(a + 1, int(np.searchsorted(at, at[a] + CHUNK, "right")) - 1)
            row = [number, ids[a:z].astype("<i8").tobytes(), known[a:z].astype(np.uint8).tobytes(), np.diff(at[a : z + 1]).astype("<i8").tobytes(), raw[at[a] : at[z]].tobytes(), int(at[z] - at[a])]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["chunk", "ids", "known", "sizes", "texts", "bytes"])
            a, number = z, number + 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _runs(names: np.ndarray, length: int) -> np.ndarray:
    """The names of all runs of length, by their first word, from names of words; a run is mixed from its two halves."""
    if length == 1:
        return names
    half = (length + 1) // 2
    part = _runs(names, half)
    a, b = part[: len(names) - length + 1], part[length - half :]
    return _mix(a * np.uint64(_ODD) + _mix(b + np.uint64(_EVEN)) + np.uint64(length))


class Words:
    """The words of a chunk: their names of 128 bits, and the document of each."""

    def __init__(self, sizes: np.ndarray, texts: bytes):
        ends = np.cumsum(sizes).tolist()
        self.texts = [texts[a:z].split() for a, z in zip([0, *ends], ends)]
        self.n = np.array([len(w) for w in self.texts], np.int64)
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.n)])  # of each document, and the end
        every = [w for text in self.texts for w in text]
        place = {w: k for k, w in enumerate(dict.fromkeys(every))}
        names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, place)), "<u8").reshape(-1, 2)
        at = np.fromiter(map(place.__getitem__, every), np.int64, len(every))
        self.names = names[at, 0], names[at, 1]

    def windows(self, length: int) -> np.ndarray:
        """Mask over words: a window of length starts there within its document."""
        ok = np.zeros(len(self.names[0]), bool)
        for a, n in zip(self.first[:-1].tolist(), self.n.tolist()):
            if n >= length:
                ok[a : a + n - length + 1] = True
        return ok

    def named(self, window: int, length: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """For each window alive, by its first word: the place and name of the run of length that it names, the last of the least;
        windows themselves have a second half to their names."""
        at = np.flatnonzero(alive)
        if not len(at):
            return at, np.zeros(0, np.uint64), np.zeros(0, np.uint64) if length == window else None
        if length == window:
            low, high = (_runs(x, length)[at] for x in self.names)
            return at, _mix(low), high
        low, reach = _runs(self.names[0], length), 1
        width = window - length + 1
        place = np.arange(len(low))
        while reach < width:
            step = min(reach, width - reach)
            a, b = low[:-step], low[step:]
            later = b <= a
            low, place = np.where(later, b, a), np.where(later, place[step:], place[:-step])
            reach += step
        return place[at], _mix(low[at]), None  # least hashes are small ones; mixed, they spread evenly over the ranges


def _distinct(low: np.ndarray, high: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For names of one or two halves: places of the distinct ones in order, which of them each name is, and how often they occur."""
    order = np.argsort(low, kind="stable") if high is None else np.lexsort((high, low))
    new = np.ones(len(low), bool)
    a = low[order]
    new[1:] = a[1:] != a[:-1]
    if high is not None:
        b = high[order]
        new[1:] |= b[1:] != b[:-1]
    which = np.empty(len(low), np.int64)
    which[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return order[starts], which, np.diff(np.append(starts, len(low)))


def _cuts(low: np.ndarray, buckets: int) -> np.ndarray:
    """Where ranges end in ordered names."""
    return np.searchsorted(low, np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets))


def _send(parts: Iterator[pa.RecordBatch], alive, window: int, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's distinct names by range, with a bit that says that a name stands at two places in the chunk."""
    for b in parts:
        for k in range(b.num_rows):
            words, live = alive(b, k)
            place, low, high = words.named(window, length, live)
            _, once = np.unique(place, return_index=True)
            low, high = low[once], None if high is None else high[once]
            first, _, n = _distinct(low, high)
            low, high = low[first], None if high is None else high[first]
            cut = _cuts(low, buckets)
            packed = [x.astype("<u8").tobytes() for x in np.split(low, cut)]
            if high is not None:
                packed = [x + y.astype("<u8").tobytes() for x, y in zip(packed, np.split(high, cut))]
            full = [(i, x, np.packbits(m).tobytes()) for i, (x, m) in enumerate(zip(packed, np.split(n > 1, cut))) if x]
            if full:
                which, x, m = zip(*full)
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[k].as_py()] * len(full), pa.int64()), pa.array(which, pa.int32()), pa.array(x, pa.binary()), pa.array(m, pa.binary())], names=["chunk", "bucket", "hashes", "many"])


def _answer_of(halves: int):
    """What a range answers to names of so many halves: the bits of each chunk's names, set where the name stands at two places at least."""

    def answer(key, pdf):
        import pandas as pd

        sent = [np.frombuffer(x, "<u8").reshape(halves, -1) for x in pdf["hashes"]]
        many = [np.unpackbits(np.frombuffer(m, np.uint8))[: x.shape[1]].astype(bool) for x, m in zip(sent, pdf["many"])]
        low = np.concatenate([x[0] for x in sent])
        _, which, n = _distinct(low, np.concatenate([x[1] for x in sent]) if halves > 1 else None)
        twice = n > 1
        twice[which[np.concatenate(many)]] = True
        bits = np.split(twice[which], np.cumsum([x.shape[1] for x in sent])[:-1])
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "bits": [np.packbits(x).tobytes() for x in bits]})

    return answer


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept.

    Words end at ASCII white space and are compared unchanged, by 128 bits of hash. Each word goes that is covered by a window of words which also
    starts anywhere else, its own document included; windows are judged on the input. kept_sha256 is of the kept words joined
    by one space. Null and empty texts have no words; documents shorter than the window keep all; repeated rows lose all
    their windows; null identifiers stay null. An empty input gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = staged(rows.mapInArrow(_pack, _CHUNKS), "substring-packed")
    total = packed.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(RANGES, total // RANGE)
    chunks = bucketed(packed.drop("bytes"), "chunk", max(n_partitions(docs.sparkSession), total // RANGE), "substring_chunks")
    discard(packed)
    done: DataFrame | None = None
    past: list[int] = []

    def opener(past: list[int]):
        """Words of a chunk and the windows alive after the levels past, by the answers that came with it."""

        def alive(b: pa.RecordBatch, k: int) -> tuple[Words, np.ndarray]:
            words = Words(np.frombuffer(b.column(3)[k].as_py(), "<i8"), b.column(4)[k].as_py())
            live = words.windows(window)
            told = b.column(5)[k].as_py() if past else []
            answers = {(x["level"], x["bucket"]): x["bits"] for x in told or []}
            for n, length in enumerate(past):
                _, low, high = words.named(window, length, live)
                first, which, _ = _distinct(low, high)
                cut = np.split(low[first], _cuts(low[first], buckets))
                parts = [np.unpackbits(np.frombuffer(answers[n, bucket], np.uint8))[: len(x)].astype(bool) for bucket, x in enumerate(cut) if len(x)]
                twice = np.concatenate(parts) if parts else np.zeros(0, bool)
                live[np.flatnonzero(live)[~twice[which]]] = False
            return words, live

        return alive

    def joined() -> DataFrame:
        if done is None:
            return chunks
        told = done.groupBy("chunk").agg(F.collect_list(F.struct("level", "bucket", "bits")).alias("told"))
        # The answers grow with the corpus, so they are never broadcast: they are dealt to the buckets, where texts stay unsorted.
        return chunks.join(told.hint("shuffle_hash"), "chunk", "left")

    for n, length in enumerate(levels(window)):
        alive = opener(list(past))
        sent = joined().mapInArrow(lambda parts, alive=alive, length=length: _send(parts, alive, window, length, buckets), "chunk long, bucket int, hashes binary, many binary")
        answer = _answer_of(2 if length == window else 1)
        bits = staged(sent.groupBy("bucket").applyInPandas(answer, "chunk long, bucket int, bits binary").withColumn("level", F.lit(n)), "substring-bits")
        done = bits if done is None else done.unionByName(bits)
        past.append(length)
        if bits.isEmpty():  # no candidate is left
            break

    alive = opener(list(past))

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for k in range(b.num_rows):
                words, live = alive(b, k)
                edge = np.zeros(len(live) + window, np.int32)
                at = np.flatnonzero(live)
                edge[at] += 1
                edge[at + window] -= 1
                gone = np.cumsum(edge)[: len(live)] > 0
                ids, known = np.frombuffer(b.column(1)[k].as_py(), "<i8").tolist(), b.column(2)[k].as_py()
                out = []
                for i, ok, own, a, n in zip(ids, known, words.texts, words.first.tolist(), words.n.tolist()):
                    lost = int(np.count_nonzero(gone[a : a + n]))
                    kept = b" ".join([w for w, g in zip(own, gone[a : a + n].tolist()) if not g] if lost else own)
                    out.append((i if ok else None, n, lost, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
                cols, kinds, names = list(zip(*out)), [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
                m = 5 if with_text else 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:m], kinds)], names=names[:m])

    return joined().mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
