"""Exact top-k inner products by MaxScore over shards of posting columns.

A query's terms are its non-zero components, a term's postings the column of that component in a shard. Contributions are counted
from the least that a term can give in the shard, so that bounds add up whatever the signs. The terms whose bounds together
cannot lift a vector to the current k-th score are non-essential: essential columns are traversed for all vectors, the others
are probed, largest bound first, only for the vectors that are still competitive. Scores of shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm.shared import discard, n_partitions, staged

#: Vectors in a shard and queries in a block.
SHARD, BLOCK = 8192, 16384

_BLOCKS = "ids binary, dims int, matrix binary"


def _quantised(array: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that take part, and their components: whole numbers, as doubles that hold them exactly."""
    rows, found = [], []
    for k, x in enumerate(array):
        if not x.is_valid:
            continue
        v = x.values
        if v.null_count:
            continue
        v = v.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(v).all():
            with np.errstate(over="ignore"):
                v = np.floor(scale * v)
            if not np.isfinite(v).all():
                raise OverflowError("a scaled component is too large for a double")
            rows.append(k)
            found.append(v)
    return np.array(rows, np.int64), found


def _packed(parts: Iterator[pa.RecordBatch], most: int, scale: float, grouped: bool = False) -> Iterator[pa.RecordBatch]:
    """Blocks of at most so many vectors (id, v, and q if grouped): identifiers, and the matrix with a row for each component; a
    block holds vectors of one q only."""
    ids: list[int] = []
    held: list[np.ndarray] = []
    at = None

    def cut() -> pa.RecordBatch:
        dims = max(map(len, held))
        m = np.zeros((dims, len(held)), "<f8")
        for k, v in enumerate(held):
            m[: len(v), k] = v
        cols, names = [pa.array([np.array(ids, "<i8").tobytes()]), pa.array([dims], pa.int32()), pa.array([m.tobytes()])], ["ids", "dims", "matrix"]
        return pa.RecordBatch.from_arrays([*cols, pa.array([at], pa.int32())] if grouped else cols, names=[*names, "q"] if grouped else names)

    for b in parts:
        rows, found = _quantised(b.column(1), scale)
        qs = b.column(2).to_numpy()[rows].tolist() if grouped and len(rows) else [None] * len(rows)
        for i, v, q in zip(b.column(0).to_numpy(zero_copy_only=False)[rows].tolist() if len(rows) else [], found, qs):
            if held and (len(held) == most or q != at):
                yield cut()
                ids, held = [], []
            at = q
            ids.append(i)
            held.append(v)
    if held:
        yield cut()


def exact_kind(query_most: float, shard_most: float, dims: int) -> type:
    """The cheapest type in which all sums of products stay exact: double, long or whole numbers of any size."""
    reach = query_most * shard_most * max(dims, 1) * 2
    return np.float64 if reach < 2**53 else np.int64 if reach < 2**62 else object


def _whole(x: np.ndarray, kind: type) -> np.ndarray:
    """Doubles that hold whole numbers, as kind."""
    if kind is object:
        return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
    return x if kind is np.float64 else x.astype(kind)


class Top:
    """The k best (score, smaller identifier first) so far of one query."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int | None:
        """What a score must reach, None while there are fewer than k."""
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if scores.dtype == object and any(not -(1 << 63) <= s < 1 << 63 for s in scores):
            raise OverflowError("a score does not fit a long")
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores.astype(np.int64)])
        best = np.lexsort((ids, ~scores))[: self.k]  # ~s falls as s rises and never overflows
        self.ids, self.scores = ids[best], scores[best]


def search(query: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, top: Top) -> None:
    """Add a shard's vectors to top. columns has a row for each component; low and high are its least and greatest values. All
    are of one type that holds sums of products exactly."""
    n = min(len(query), len(columns))
    q = query[:n]
    most, least = np.maximum(q * low[:n], q * high[:n]), np.minimum(q * low[:n], q * high[:n])
    rest = np.flatnonzero(ids != own)
    if top.floor is None:  # a first threshold
        some, rest = rest[: 8 * top.k], rest[8 * top.k :]
        top.add(ids[some], q @ columns[:n, some] if n else np.zeros(len(some), np.int64))
    order = np.argsort(-(most - least), kind="stable")
    order = order[q[order] != 0]
    # What the terms from each place on can still add; essential are those before which the bound alone may reach the threshold.
    zero = np.zeros(1, q.dtype)
    bound = np.concatenate([np.cumsum(most[order][::-1])[::-1], zero])
    floor = top.floor
    essential = len(order)
    if floor is not None:
        base = np.concatenate([zero, np.cumsum(least[order])])
        short = base + bound < floor
        essential = int(np.argmax(short)) if short.any() else len(order)
    total = np.zeros(len(rest), q.dtype)
    for t in order[:essential]:
        total += q[t] * columns[t, rest]
    for k in range(essential, len(order) + 1):
        able = total + bound[k] >= floor if floor is not None else np.ones(len(rest), bool)
        if not able.all():
            rest, total = rest[able], total[able]
        if k == len(order) or not len(rest):
            break
        total += q[order[k]] * columns[order[k], rest]
    top.add(ids[rest], total)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """For every row of queries its k highest rows of vectors: query_id, rank (from 1), vec_id, score.

    A component x counts as floor(scale * x); a score is the exact integer inner product, ties go to the smaller identifier, and
    rows with the query's identifier are left out. Vectors that are null or hold null or non-finite components take no part, nor
    do null identifiers; missing components of shorter vectors count 0; of queries that share an identifier the least vector
    asks; repeated rows are candidates each; other columns are not read. A score that fits no long, or a scaled component that
    fits no double, is an error. Without vectors or queries the result is empty.

    A task holds the queries of a block and lets shards of vectors stream past, so that no more than a block and a shard are in
    memory. Every block meets every shard once: the work is queries times vectors less what the bounds spare.
    """
    spark = vectors.sparkSession
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id is not null")
    shards = staged(pick(vectors).mapInArrow(lambda p: _packed(p, shard, scale), _BLOCKS), "maxscore-shards")
    asked = staged(pick(queries).groupBy("id").agg(F.min("v").alias("v")), "maxscore-asked")
    n_blocks, lanes = max(1, -(-asked.count() // block)), max(1, min(n_partitions(spark), shards.count()))
    dealt = asked.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")).repartition(n_blocks, "q").sortWithinPartitions("q")
    blocks = staged(dealt.mapInArrow(lambda p: _packed(p, block, scale, True), _BLOCKS + ", q int"), "maxscore-queries")
    discard(asked)
    # A lane of a block holds its queries and some of the shards; every shard meets every block once.
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    left = blocks.select("q", lane, F.lit(0).alias("kind"), "ids", "dims", "matrix")
    right = shards.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
    right = right.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("q"), "lane", F.lit(1).alias("kind"), "ids", "dims", "matrix")
    met = left.unionByName(right).repartition(lanes, "q", "lane").sortWithinPartitions("q", "lane", "kind")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked = None, []  # (identifier, vector, greatest component, Top) of each query of the block at hand

        def done() -> pa.RecordBatch:
            n = [len(t.ids) for *_, t in asked]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([i for i, *_ in asked], np.int64), n)), pa.array(np.concatenate([t.ids for *_, t in asked])), pa.array(np.concatenate([t.scores for *_, t in asked]))], names=["query_id", "vec_id", "score"])

        for b in parts:
            for r in range(b.num_rows):
                q, lane, kind = (b.column(c)[r].as_py() for c in range(3))
                ids = np.frombuffer(b.column(3)[r].as_py(), "<i8")
                columns = np.frombuffer(b.column(5)[r].as_py(), "<f8").reshape(b.column(4)[r].as_py(), len(ids))
                if kind == 0:
                    if at != (q, lane) and asked:
                        yield done()
                        asked = []
                    at = q, lane
                    asked += [(i, v, float(np.abs(v).max(initial=0)), Top(k)) for i, v in zip(ids.tolist(), np.ascontiguousarray(columns.T))]
                elif at == (q, lane):
                    most, made = float(np.abs(columns).max(initial=0)), {}
                    for i, v, own_most, top in asked:
                        kind_ = exact_kind(own_most, most, len(columns))
                        if kind_ not in made:
                            c = _whole(columns, kind_)
                            made[kind_] = c, *((c.min(axis=1), c.max(axis=1)) if len(c) else (np.zeros(0, c.dtype),) * 2)
                        search(_whole(v, kind_), i, ids, *made[kind_], top)
        if asked:
            yield done()

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
