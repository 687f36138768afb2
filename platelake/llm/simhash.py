"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit of a fingerprint gets a non-zero vector of radius + 1 bits; the mask of a non-zero v keeps the bits whose vector has an
odd inner product with v. Any radius bits leave some v orthogonal to all their vectors, so that every pair within the radius
agrees under the mask of that v: the tables miss no pair. Candidates of a bucket are then compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.components import components, joined_with_sums
from platelake.llm.shared import discard, row_bytes, staged

#: Fingerprints in a bucket that one task compares pair by pair; larger buckets take the way by neighbours.
BUCKET = 4096
_BITS = 64


def masks(radius: int = 2) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + i % vectors for i in range(_BITS)]
    return [sum(1 << i for i in range(_BITS) if (of_bit[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of lower-cased text: a bit is set if set in over half the hashes of its shingles, repeats included."""
    words = text.split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(g), seed) for g in zip(*(words[k:] for k in range(shingle)))]
    of = np.array(hashes, "<u8")
    counts = np.zeros(_BITS, np.int64)
    for k in range(0, len(of), 1 << 16):
        counts += np.unpackbits(of[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(of), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, and the columns in carry) for every row; fp as a signed long. Words end at ASCII white space."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            fps = np.array([fingerprint(t, shingle) for t in row_bytes(b.column(1), lower=True)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), *(b.column(2 + k) for k in range(len(carry)))], names=["doc_id", "fp", *carry])

    kinds = dict(docs.dtypes)
    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", `{c}` {kinds[c]}" for c in carry))


def _linked(parts: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Star edges of the components within each bucket: each fingerprint is compared with those not reached yet."""
    for b in parts:
        us, vs = [], []
        for found in b.column(0):
            left = np.sort(np.array(found.values.to_numpy(zero_copy_only=False)))
            while len(left) > 1:
                root, left, front = left[0], left[1:], left[:1]
                while len(front) and len(left):
                    near = np.zeros(len(left), bool)
                    for x in front:
                        near |= np.bitwise_count((left ^ x).view(np.uint64)) <= radius
                    front, left = left[near], left[~near]
                    us.append(front)
                    vs.append(np.full(len(front), root))
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def links(classes: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints (column fp, distinct) reachable by steps of at most radius bits.

    Buckets of up to bucket fingerprints are compared in memory. For a radius of 2 the members of larger ones meet at the words
    within one bit of them: two words are within two bits if and only if such a word is common to both, at most 65 fingerprints
    meet at one, and all of those are linked. For other radii a larger bucket is dealt to lanes, which meet in pairs."""
    rows = classes.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks(radius)))).alias("t", "key"))
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    held = staged(joined_with_sums(rows, sizes, ["t", "key"]), "simhash-buckets")
    small = held.filter(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    edges = small.mapInArrow(lambda parts: _linked(parts, radius), "u long, v long")
    hot = held.filter(F.col("n") > bucket)
    if radius != 2:
        lanes = F.ceil(F.col("n") / bucket).cast("int")
        dealt = hot.withColumns({"lanes": lanes, "lane": F.pmod(F.xxhash64("fp"), lanes).cast("int")}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))
        pairs = dealt.groupBy("t", "key", F.least("lane", "other").alias("a"), F.greatest("lane", "other").alias("b")).agg(F.collect_list("fp").alias("fps")).select("fps")
        return edges.unionAll(pairs.mapInArrow(lambda parts: _linked(parts, radius), "u long, v long"))
    hot = hot.select("fp").distinct()
    steps = F.array(F.lit(0).cast("long"), *(F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b) for b in range(_BITS)))
    met = hot.select("fp", F.explode(steps).alias("bit")).groupBy(F.col("fp").bitwiseXOR(F.col("bit")).alias("z")).agg(F.collect_set("fp").alias("fps"), F.min("fp").alias("v"))
    return edges.unionAll(met.filter(F.size("fps") > 1).select(F.explode("fps").alias("u"), "v").filter("u <> v"))


def simhash_components(docs: DataFrame, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), shingle: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (least doc_id of its component), n_class, root, and carry.

    Texts are lower-cased in A-Z; fewer words than a shingle count whole; texts without words (null, empty) have fingerprint
    zero and are linked like any other. n_class counts the rows with the same fingerprint. Null identifiers are passed over
    when the least is chosen; repeated rows are rows of their own. An empty input gives an empty result.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle, carry), "simhash-fingerprints")
    classes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_class")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(best, "root").select("fp", "root", "component_id", "n_class")
    name = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(known, "fp").select("doc_id", name.alias("fingerprint"), "component_id", "n_class", "root", *carry)
