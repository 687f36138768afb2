"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations alone.

Every source is a stream of its documents in a shuffled order, cut into blocks of equally many words, the last one of a pass
being what is left. Slot i of the mix is the golden-ratio point frac(i * 0.618...); the cumulative target shares map it to a
source, and its rank among that source's slots says which block it takes, starting over when the source is used up. How often a
source is drawn is thus decided by the points alone; their low discrepancy keeps that near its target.

Sources whose target holds fewer than MIN_BLOCKS blocks would be met too coarsely. They form tiers of their own with blocks a
sixteenth as long (and again, down to single words), each tier having its own schedule over its sources.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.llm.shared import staged, word_count

#: The golden ratio's inverse.
STEP = 0.6180339887498949
#: Weights of sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most this many times its size.
MAX_EPOCHS = 3
#: Cells of the unit interval by which points find their source.
CELLS = 1024
#: Words in a block, and the blocks that a source's target holds at least, unless blocks are single words.
BLOCK, MIN_BLOCKS = 1024, 512
#: How much shorter blocks get from tier to tier.
FINER = 16
#: Slots that are ranked together; ranks of a frequent source don't meet in one task.
RANK_CHUNK = 1 << 16


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row a source: skey, source_size, target. The cap is exact: sources by the ratio of cap to weight, those below the
    common level are held at their caps. Sums are of integers, so the level does not depend on their order."""
    by = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by) - 1) % len(weights)
    w = sized.groupBy("source", "skey").agg(F.sum("size").alias("source_size")).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).cast("long"))
    cap = F.col("source_size") * max_epochs
    all_ = Window.partitionBy()
    level = Window.orderBy(cap / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_) - F.coalesce(F.sum(cap).over(level), F.lit(0))
    over = F.sum("w").over(all_) - F.coalesce(F.sum("w").over(level), F.lit(0))
    lined = w.withColumn("level", left.cast("double") / over.cast("double"))
    at = F.max("level").over(all_)  # the levels rise while the next source is above its cap, and fall from there on
    return lined.withColumn("at", at).select("source", "skey", "source_size", F.least(cap.cast("double"), F.col("at") * F.col("w")).alias("target"))


def tiers(block: int = BLOCK) -> list[int]:
    """Block lengths, longest first."""
    found = [max(1, block)]
    while found[-1] > 1:
        found.append(max(1, found[-1] // FINER))
    return found


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """(skey, slot, rank): golden-ratio points through the cumulative shares of sources (source, skey, target), ranked within their source."""
    spark = sources.sparkSession
    order = Window.orderBy("source")
    hi = F.sum("target").over(order) / F.sum("target").over(Window.partitionBy())
    spans = sources.filter("target > 0").withColumn("hi", hi)
    spans = spans.withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0))).withColumn("hi", F.when(F.lead("hi").over(order).isNull(), F.lit(2.0)).otherwise(F.col("hi")))
    last = F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))
    spans = spans.select("skey", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.greatest(last, F.floor(F.col("lo") * CELLS)))).alias("cell"))
    points = spark.range(slots).withColumn("u", (F.col("id") * F.lit(STEP)) % 1.0).withColumn("cell", F.floor(F.col("u") * CELLS))
    hit = points.join(spans, (points.cell == spans.cell) & (points.u >= spans.lo) & (points.u < spans.hi)).select("skey", F.col("id").alias("slot"), F.floor(F.col("id") / RANK_CHUNK).alias("chunk"))
    counts = hit.groupBy("skey", "chunk").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("skey").orderBy("chunk")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("slot")) - 1
    return hit.withColumn("within", within).join(before, ["skey", "chunk"]).select("skey", "slot", (F.col("before") + F.col("within")).alias("rank"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, block_words: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, and the columns in carry.

    size is the number of words, 0 for null or empty texts, which are never taken. A null source is a source of its own and
    comes last. taken counts repeated passes; a document that a block cuts is taken in part. A source's taken words differ from
    its target by some blocks, of which the target holds MIN_BLOCKS unless they are single words, and no block is taken more
    than max_epochs times. The shuffled order depends on the identifier alone, so reruns agree; rows that share it are ordered
    by size, and rows without one come last in their source, by size. An empty input gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), F.md5(F.col(id_col).cast("string")).alias("order"), F.monotonically_increasing_id().alias("nth"), *carry)
    sized = staged(rows.withColumn("skey", _key(F.col("source"))), "mix-sizes")
    sources = staged(source_targets(sized, weights, max_epochs), "mix-sources")

    # The streams: running sums within slices of the shuffled order, then over the slices of a source. Rows without an identifier
    # come last, by size; what tells those of one size apart is the stored number, so that they too are many slices.
    unnamed = F.concat(F.lit("g"), F.lpad(F.col("size").cast("string"), 19, "0"), F.lpad(F.hex(F.pmod("nth", F.lit(256))), 2, "0"))
    salted = sized.withColumn("slice", F.coalesce(F.substring("order", 1, 3), unnamed))
    slices = salted.groupBy("skey", "slice").agg(F.sum("size").alias("n"))
    offsets = slices.withColumn("offset", F.sum("n").over(Window.partitionBy("skey").orderBy("slice")) - F.col("n")).drop("n").join(sources.drop("source"), "skey")
    inside = F.sum("size").over(Window.partitionBy("skey", "slice").orderBy("order", "size", "nth").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    streams = salted.withColumn("inside", inside).join(offsets, ["skey", "slice"]).withColumn("a", F.col("offset") + F.col("inside")).select("doc_id", "skey", "nth", "size", "source_size", "target", "a", *carry)

    # The draws: a slot's rank is the block of the repeated stream that it takes.
    lengths = tiers(block_words)
    tier = F.lit(lengths[-1])
    for n in reversed(lengths[:-1]):
        tier = F.when(F.col("target") >= n * MIN_BLOCKS, n).otherwise(tier)
    tiered = sources.withColumn("b", tier.cast("long"))
    totals = {r["b"]: r["t"] for r in tiered.groupBy("b").agg(F.sum("target").alias("t")).collect()}  # a row a tier
    drawn = [schedule(tiered.filter(F.col("b") == n).drop("b"), math.ceil(t / n - 0.5)) for n, t in sorted(totals.items()) if t > 0]
    ranks = reduce(DataFrame.unionByName, drawn) if drawn else schedule(sources, 0)
    per = F.ceil(F.col("source_size") / F.col("b"))
    draws = ranks.select("skey", "rank").join(tiered.select("skey", "b", per.alias("per")), "skey").filter(F.col("rank") < max_epochs * F.col("per"))
    blocks = draws.groupBy("skey", (F.col("rank") % F.col("per")).alias("block")).agg(F.count("*").alias("times"))

    # Documents meet the blocks that hold their words.
    b = F.col("b")
    met = streams.filter("size > 0").join(tiered.select("skey", "b"), "skey")
    pieces = met.withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / b), F.floor((F.col("a") + F.col("size") - 1) / b))))
    words = F.least(F.col("a") + F.col("size"), (F.col("block") + 1) * b) - F.greatest(F.col("a"), F.col("block") * b)
    pieces = pieces.join(blocks, ["skey", "block"], "left").withColumn("words", F.coalesce("times", F.lit(0)) * words)
    out = ["doc_id", "size", "source_size", "target"]
    taken = pieces.groupBy("nth", *out, *carry).agg(F.sum("words").cast("long").alias("taken")).select(*out, "taken", *carry)
    empty = streams.filter("size = 0").select(*out, F.lit(0).cast("long").alias("taken"), *carry)
    return taken.unionByName(empty)
