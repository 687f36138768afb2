"""Exact deduplication by sorting whole contents.

Sampled splitters range-partition the normalised texts, each partition is sorted externally, and neighbours are compared in
full. The range key is the text's first characters, half its SHA-256, the row's identifier and the row's place in the input, so that
the copies of one text may spread over many partitions, whatever their identifiers; runs that touch a partition's border are then joined to the runs beside them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm.shared import lowered, n_partitions, staged

#: Bytes of text in a splitter; what the driver samples stays small however long texts are.
PREFIX = 32

_RUNS = "pid int, run int, edge boolean, last boolean, row long, doc_id long, run_keep long, run_size long, sha string, edge_text string"


def _normalise(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts:
        yield pa.RecordBatch.from_arrays([b.column(0), lowered(b.column(1)), b.column(2)], names=["doc_id", "norm", "row"])


def _runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in a sorted partition. The first and the last run carry their text once, for the comparison across the border."""
    pid = TaskContext.get().partitionId()
    names = [x.split()[0] for x in _RUNS.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def emit(run: int, text: str, ids: list, rows: list, edge: bool) -> pa.RecordBatch:
        n, known = len(ids), [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        cols = [[pid] * n, [run] * n, [edge] * n, [False] * (n - 1) + [True], rows, ids, [max(known, default=None)] * n, [n] * n, [sha] * n, [text if edge else None] + [None] * (n - 1)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    run, text, ids, rows, held, small = 0, None, [], [], [], 0
    for b in parts:
        for i, t, r in zip(*(c.to_pylist() for c in b.columns)):
            if t == text:
                ids.append(i)
                rows.append(r)
                continue
            if text is not None:
                held.append(emit(run, text, ids, rows, run == 0))
                small += len(ids)
                run += 1
                if small >= 4096:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, small = [], 0
            text, ids, rows = t, [i], [r]
    if text is not None:
        held.append(emit(run, text, ids, rows, True))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, and row_col (a long that tells rows apart) if given.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest identifier stays;
    null identifiers rank below all others, and of repeated rows (same identifier and text) one is kept. Other columns are
    not read, whatever their names. An empty input gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("norm"), (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("row")).mapInArrow(_normalise, "doc_id long, norm string, row long")
    keys = rows.withColumns({"head": F.substring("norm", 1, PREFIX), "hash": F.unhex(F.substring(F.sha2("norm", 256), 1, 32)), "nth": F.monotonically_increasing_id()})
    ordered = keys.repartitionByRange(n_partitions(spark), "head", "hash", "doc_id", "nth").sortWithinPartitions("head", "hash", "norm", "doc_id", "nth")
    runs = staged(ordered.select("doc_id", "norm", "row").mapInArrow(_runs, _RUNS), "exact-dedup-runs")

    # Border runs, two a partition at most: number them, compare each text with its predecessor's, and chain the equal ones.
    edges = runs.filter(F.col("edge_text").isNotNull())
    at = edges.select("pid", "run", "run_keep", "run_size", F.row_number().over(Window.orderBy("pid", "run")).alias("n"))
    texts = edges.select("pid", "run", F.col("edge_text").alias("t")).join(at, ["pid", "run"])
    before = texts.select((F.col("n") + 1).alias("n"), F.col("t").alias("t0"))
    linked = texts.join(before, "n", "left").select("n", "pid", "run", "run_keep", "run_size", F.coalesce(F.col("t") == F.col("t0"), F.lit(False)).alias("same"))
    chained = linked.withColumn("chain", F.sum((~F.col("same")).cast("long")).over(Window.orderBy("n")))
    totals = chained.groupBy("chain").agg(F.max("run_keep").alias("keep_id"), F.sum("run_size").alias("group_size"))
    borders = chained.select("pid", "run", "chain").join(totals, "chain").drop("chain")

    kept = (F.col("last") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept")
    inner = runs.filter(~F.col("edge")).withColumns({"keep_id": F.col("run_keep"), "group_size": F.col("run_size")})
    outer = runs.filter("edge").join(borders, ["pid", "run"])
    cols = ["doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept, F.col("sha").alias("text_sha256"), *([F.col("row").alias(row_col)] if row_col else [])]
    return inner.select(*cols).unionAll(outer.select(*cols))
