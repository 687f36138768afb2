"""Toxicity by a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram of lower-cased characters, by its hash; its value is the logarithm of how much more often
toxic than clean training texts hold it. A logistic regression over the strongest features is fitted on a bounded sample of
labelled rows, in one task, and its scale is set by cross-validation so that a score of 0.7 is the cut that separates best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.shared import lowered

#: Lengths of n-grams and bits of their hashes.
SIZES = (3, 4, 5, 6)
BITS = 22
#: Documents whose n-grams are handled at once, by characters.
CHUNK = 1 << 20


def _chunks(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, characters, document of each character) for runs of documents of about CHUNK characters; long ones are split with their ends overlapping."""
    first, held, size = 0, [], 0
    for k, t in enumerate(texts):
        held.append(t)
        size += len(t)
        if size >= CHUNK or k == len(texts) - 1:
            padded = [f" {x} " for x in held]
            chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
            of = np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in padded])
            step = 4 * CHUNK
            for a in range(0, len(chars), step):
                yield first, chars[a : a + step + max(SIZES) - 1], of[a : a + step + max(SIZES) - 1]
            first, held, size = k + 1, [], 0


def _hashes(chars: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of the n-grams of each size, one array pair a size; those across documents are left out."""
    h = np.zeros(len(chars), np.uint32)
    for n in range(1, max(SIZES) + 1):
        if len(chars) < n:
            return
        h = h[: len(chars) - n + 1] * np.uint32(0x01000193) + chars[n - 1 :]
        if n in SIZES:
            x = h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            x ^= x >> np.uint32(16)
            x *= np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(13)
            x *= np.uint32(0xC2B2AE35)
            x >>= np.uint32(32 - BITS)
            yield of[: len(x)], np.where(of[: len(x)] == of[n - 1 :], x, np.uint32(1 << BITS))


@dataclass
class Model:
    """buckets and weights of the features (log-count ratio times regression weight), and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        """Scores from 0 to 1 of lower-cased texts."""
        index = np.full((1 << BITS) + 1, -1, np.int16)
        index[self.buckets] = np.arange(len(self.buckets))
        return 1 / (1 + np.exp(-np.clip(self.margins(texts, index), -500, 500)))

    def margins(self, texts: list[str], index: np.ndarray) -> np.ndarray:
        found = np.full(len(texts), self.bias)
        doc, feature = _present(texts, index)
        return found + np.bincount(doc, self.weights[feature], len(texts)) if len(doc) else found


def _present(texts: list[str], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of document and feature among texts, for the features that index numbers."""
    seen = []
    for first, chars, of in _chunks(texts):
        for doc, bucket in _hashes(chars, of):
            f = index[bucket]
            hit = np.flatnonzero(f >= 0)
            seen.append((doc[hit].astype(np.int64) + first) << 16 | f[hit].astype(np.int64))
        if len(seen) > 64:
            seen = [np.unique(np.concatenate(seen))]
    pairs = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
    return pairs >> 16, pairs & 0xFFFF


def _regress(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, k: int, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2 logistic regression with balanced classes, by accelerated gradient steps."""
    n = len(y)
    c = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))
    w, b = np.zeros(k), 0.0
    v, vb = w.copy(), b
    # The largest eigenvalue of the weighted design, by power iteration.
    p = np.full(k, 1 / np.sqrt(max(1, k)))
    top = 1.0
    for _ in range(12):
        q = np.bincount(feature, value * (c * np.bincount(doc, value * p[feature], n))[doc], k)
        top = float(np.linalg.norm(q)) or 1.0
        p = q / top
    rate = 1 / (0.25 * (top * 1.2 + 1) + ridge)
    for t in range(steps):
        z = np.bincount(doc, value * v[feature], n) + vb
        e = c * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        w2 = v - rate * (np.bincount(feature, value * e[doc], k) + ridge * v)
        b2 = vb - rate * e.sum()
        m = t / (t + 3)
        v, vb = w2 + m * (w2 - w), b2 + m * (b2 - b)
        w, b = w2, b2
    return w, b


def fit(texts: list[str], y: np.ndarray, features: int = 8000, least: int = 3, ridge: float = 1e-4, steps: int = 300, folds: int = 3) -> Model:
    """Fit on lower-cased texts with labels y (0 or 1). Without both classes the model scores every text by their share alone."""
    n = len(texts)
    if n == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    fold = np.empty(n, np.int64)
    for c in (0, 1):
        at = np.flatnonzero(y == c)
        fold[at] = np.arange(len(at)) % folds
    count = np.zeros((folds, 2, (1 << BITS) + 1), np.int32)
    for i, t in enumerate(texts):
        found = [b for _, chars, of in _chunks([t]) for _, b in _hashes(chars, of)]
        if found:
            count[fold[i], y[i], np.unique(np.concatenate(found))] += 1
    count[:, :, -1] = 0

    def train(rows: np.ndarray, counts: np.ndarray) -> tuple[Model, np.ndarray]:
        clean, toxic = counts
        df = clean + toxic
        able = np.flatnonzero(df >= least)
        r = np.log((toxic[able] + 1) / (y[rows].sum() + 2)) - np.log((clean[able] + 1) / ((1 - y[rows]).sum() + 2))
        best = np.argsort(-np.abs(r) * np.sqrt(df[able]), kind="stable")[:features]
        buckets, r = able[best], r[best]
        index = np.full((1 << BITS) + 1, -1, np.int16)
        index[buckets] = np.arange(len(buckets))
        doc, feature = _present([texts[i] for i in rows], index)
        w, b = _regress(doc, feature, r[feature], y[rows], len(buckets), ridge, steps)
        return Model(buckets, r * w, b), index

    total = count.sum(0)
    margin = np.zeros(n)
    for k in range(folds):
        rows, rest = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(rest) and 0 < y[rows].sum() < len(rows):
            model, index = train(rows, total - count[k])
            margin[rest] = model.margins([texts[i] for i in rest], index)
    model, _ = train(np.arange(n), total)
    # The cut of most true less false decisions, a false alarm weighing as much as two misses in the sample; midway to the next margin.
    order = np.argsort(-margin, kind="stable")
    gain = np.cumsum(np.where(y[order] == 1, 1.0, -2.0))
    j = int(gain.argmax())
    cut = (margin[order[j]] + margin[order[min(j + 1, n - 1)]]) / 2 if gain[j] > 0 else margin[order[0]]
    model.bias += float(np.log(0.7 / 0.3) - cut)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from: crc32 of the identifier as text, modulo 3, is 1. A null identifier is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train_model(docs: DataFrame, labels: DataFrame, most_toxic: int = 2000, most_clean: int = 4000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows that are not held out: at most most_toxic and most_clean of them, those of least identifier hash."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    mixed = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    sample = known.filter("y = 1").orderBy(mixed, "doc_id").limit(most_toxic).unionAll(known.filter("y = 0").orderBy(mixed, "doc_id").limit(most_clean))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i, t, y) for b in parts for i, t, y in zip(b.column(0).to_pylist(), lowered(b.column(1)).to_pylist(), b.column(2).to_pylist()))
        m = fit([t for _, t, _ in rows], np.array([y for *_, y in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([m.buckets.astype("<i8").tobytes()]), pa.array([m.weights.astype("<f8").tobytes()]), pa.array([m.bias])], names=["buckets", "weights", "bias"])

    got = rows.repartition(1).mapInArrow(task, "buckets binary, weights binary, bias double").first()  # the sample is bounded
    if got is None:
        return fit([], np.zeros(0, np.int64))
    return Model(np.frombuffer(got[0], "<i8"), np.frombuffer(got[1], "<f8"), got[2])


def score_toxicity(docs: DataFrame, model: Model, cut: float = 0.7, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, and carry.

    Whole texts are scored, null as empty; an empty text has the score of a text without features. Repeated rows and null
    identifiers are rows like others. Only the text enters a score. An empty input gives an empty result; a model fitted on no
    labels, or on labels of one kind, gives every text one score.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = np.full((1 << BITS) + 1, -1, np.int16)
        index[model.buckets] = np.arange(len(model.buckets))
        for b in parts:
            scores = []
            for k in range(0, b.num_rows, 256):
                m = model.margins(lowered(b.column(1).slice(k, 256)).to_pylist(), index)
                scores.append(1 / (1 + np.exp(-np.clip(m, -500, 500))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(scores) if scores else np.zeros(0)), *(b.column(2 + k) for k in range(len(carry)))], names=["doc_id", "score", *carry])

    kinds = dict(docs.dtypes)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    scored = rows.mapInArrow(run, "doc_id long, score double" + "".join(f", `{c}` {kinds[c]}" for c in carry))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), *carry)
