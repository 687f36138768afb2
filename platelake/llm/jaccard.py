"""The exact check behind the SimHash stage of a pipeline: five-word Jaccard similarity within clusters of candidates.

Few bits of 64 tell only the closest copies; at a similarity of 0.8 about ten bits differ. So candidates also come from MinHash
bands of the same shingles: documents that agree in all hashes of some band join a cluster, as do those that the fingerprints
link. Each cluster's shingle sets are then compared in full. A large cluster is dealt to lanes, so that it need not fit one task:
first each lane compares its documents among themselves and with a few pivots of the cluster, which join the copies of one text
across all lanes at one pass. Only documents outside the cluster's largest group so far then meet all others, lane by lane.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm.components import components, joined_with_sums
from platelake.llm.shared import discard, row_bytes, staged

#: Bands and hashes in a band: of pairs at similarity 0.8 all but 1 in 12,000 agree in some band, above it fewer are missed.
BANDS, ROWS = 40, 7
#: Documents and shingles that a lane of a cluster holds on average.
LANE, LANE_SHINGLES = 1024, 1 << 22
#: Documents of a cluster that every lane sees, and the most shingles of such a document.
PIVOTS, PIVOT_SHINGLES = 16, 1 << 16

_random = np.random.default_rng(42)
_TIMES = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """The different hashes of a lower-cased text's shingles, in order; fewer words count whole, no words as one empty shingle."""
    words = text.split()
    n = max(1, len(words) - size + 1)
    of = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)
    h = np.full(n, len(words) if len(words) < size else size, np.uint64)
    for k in range(min(size, len(words))):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + of[k : k + n])
    return np.unique(h)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One hash for each band of a shingle set's least hashes."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for k in range(0, len(found), 4096):
        h = found[None, k : k + 4096] * _TIMES[:, None] + _PLUS[:, None]
        least = np.minimum(least, (h ^ (h >> np.uint64(32))).min(axis=1))
    key = np.zeros(BANDS, np.uint64)
    for part in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + part)
    return key.view(np.int64)


def linked(ids: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the components among shingle sets whose similarity is at least so much."""
    us, vs = [], []
    order = np.argsort(ids, kind="stable")
    left, sizes = order, np.array([len(s) for s in sets])
    while len(left) > 1:
        root, left, front = left[0], left[1:], [left[0]]
        while len(front) and len(left):
            x, front = front[0], front[1:]
            able = np.minimum(sizes[left], sizes[x]) >= similarity * np.maximum(sizes[left], sizes[x]) - 1e-9
            near = np.zeros(len(left), bool)
            if able.any():
                some = left[able]
                at = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                values = np.concatenate([sets[i] for i in some])
                place = np.minimum(np.searchsorted(sets[x], values), sizes[x] - 1)
                common = np.add.reduceat((sets[x][place] == values).astype(np.int64), at)
                near[able] = common >= similarity * (sizes[some] + sizes[x] - common) - 1e-9
            reached, left = left[near], left[~near]
            front = [*front, *reached]
            us.append(ids[reached])
            vs.append(np.full(len(reached), ids[root]))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))


def _lanes(rows: Column, shingles_: Column) -> Column:
    return F.greatest(F.ceil(rows / LANE), F.ceil(shingles_ / LANE_SHINGLES), F.lit(1)).cast("int")


def _dealt_once(held: DataFrame) -> DataFrame:
    """(cluster, a, b, row, found): each document of held (row, cluster, n, found) in one lane a of its cluster, and the cluster's pivots
    in every lane. b is 0."""
    lanes = held.groupBy("cluster").agg(_lanes(F.count("*"), F.sum("n")).alias("lanes"))
    dealt = joined_with_sums(held, lanes, ["cluster"]).withColumn("a", F.pmod(F.xxhash64("row"), F.col("lanes")).cast("int"))
    able = dealt.filter(F.col("lanes") > 1).filter(F.col("n") <= PIVOT_SHINGLES).select("cluster", "row", "lanes", "a")
    first = able.withColumn("nth", F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("row", F.lit("pivot")), "row"))).filter(F.col("nth") <= PIVOTS)
    pivots = first.withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))).filter("lane <> a").select("row", F.col("lane").alias("to"))
    copies = held.join(pivots, "row").select("cluster", F.col("to").alias("a"), F.lit(0).alias("b"), "row", "found")
    return dealt.select("cluster", "a", F.lit(0).alias("b"), "row", "found").unionAll(copies)


def _dealt_across(held: DataFrame, roots: DataFrame) -> DataFrame:
    """(cluster, a, b, row, found): pairs of lanes in which the documents of a cluster outside its largest group by roots (node, root)
    meet each other and those within it. Clusters that fitted one lane, or are one group, have none."""
    named = held.join(roots.select(F.col("node").alias("row"), "root"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    groups = named.groupBy("cluster", "root").agg(F.count("*").alias("rows"), F.sum("n").alias("size"))
    most = groups.groupBy("cluster").agg(F.max(F.struct("rows", "root", "size")).alias("most"), F.sum("rows").alias("rows"), F.sum("size").alias("size"))
    most = most.filter((_lanes(F.col("rows"), F.col("size")) > 1) & (F.col("rows") > F.col("most.rows")))
    within, outside = _lanes(F.col("most.rows"), F.col("most.size")), _lanes(F.col("rows") - F.col("most.rows"), F.col("size") - F.col("most.size"))
    most = most.select("cluster", F.col("most.root").alias("main"), within.alias("within"), outside.alias("outside"))
    apart, mixed = F.col("root") != F.col("main"), F.xxhash64("row")
    lane = F.when(apart, F.pmod(mixed, "outside")).otherwise(F.col("outside") + F.pmod(mixed, "within")).cast("int").alias("lane")
    others = F.explode(F.sequence(F.lit(0), F.col("outside") + F.when(apart, F.col("within")).otherwise(0) - 1)).alias("other")
    met = joined_with_sums(named, most, ["cluster"]).select("cluster", "row", "found", lane, others)
    return met.select("cluster", F.least("lane", "other").alias("a"), F.greatest("lane", "other").alias("b"), "row", "found")


def _edges(dealt: DataFrame, similarity: float) -> DataFrame:
    """Star edges (u, v) of the components within each (cluster, a, b) of dealt."""

    def compared(t: pa.Table) -> pa.Table:
        ids = t.column("row").to_numpy()
        u, v = linked(ids, [np.frombuffer(x.as_py(), np.uint64) for x in t.column("found")], similarity)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.groupBy("cluster", "a", "b").applyInArrow(compared, "u long, v long")


def compared_components(held: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of the rows of held (row, cluster, n, found) that steps of at least this similarity within a cluster join."""
    roots = components(_edges(_dealt_once(held), similarity))
    across = _edges(_dealt_across(held, roots), similarity)
    return components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(across))


def jaccard_components(docs: DataFrame, row: str, linked_before: DataFrame | None = None, text_col: str = "text", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(node, root) for every row, by its number in column row, that is joined to others by steps of at least this similarity.

    linked_before (u, v) are further candidates. Texts are lower-cased in A-Z, words end at ASCII white space, repeats count
    once. Shingles are compared by 64-bit hashes."""
    rows = docs.select(F.col(row).alias("row"), F.col(text_col).alias("text"))

    def bands(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for k in range(0, b.num_rows, 512):
                some = b.slice(k, 512)
                found = [shingles(t, size) for t in row_bytes(some.column(1), lower=True)]
                keys = pa.array(np.concatenate([band_keys(s) for s in found]))
                names = np.repeat(some.column(0).to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(found))), keys], names=["row", "band", "key"])

    keyed = staged(rows.mapInArrow(bands, "row long, band int, key long"), "jaccard-bands")
    met = keyed.groupBy("band", "key").agg(F.min("row").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = joined_with_sums(keyed, met, ["band", "key"]).select(F.col("row").alias("u"), "v")
    if linked_before is not None:
        edges = edges.unionAll(linked_before.select("u", "v"))
    clusters = staged(components(edges), "jaccard-clusters")
    discard(keyed)

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            found = [shingles(t, size) for t in row_bytes(b.column(2), lower=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(s) for s in found], pa.int32()), pa.array([s.tobytes() for s in found], pa.binary())], names=["row", "cluster", "n", "found"])

    held = rows.join(clusters.select(F.col("node").alias("row"), F.col("root").alias("cluster")), "row").select("row", "cluster", "text")
    held = staged(held.mapInArrow(sets, "row long, cluster long, n int, found binary"), "jaccard-sets")
    discard(clusters)
    return compared_components(held, similarity)
