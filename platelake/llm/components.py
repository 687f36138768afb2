"""Connected components of an edge table by alternating large and small stars, one staged table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.shared import discard, staged


def joined_with_sums(rows: DataFrame, sums: DataFrame, keys: list[str]) -> DataFrame:
    """rows joined with sums, which has a row for each of keys and comes from a grouping by them.

    Joined on the keys alone, a partition of rows could not be split, as the grouping's shuffle is used again. The further key,
    always 0, gives both sides shuffles of their own, of which adaptive execution splits those that a hot key makes large."""
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).alias("zero_")
    return rows.select("*", zero).join(sums.select("*", zero), [*keys, "zero_"]).drop("zero_")


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least of u and all of u's v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return joined_with_sums(edges, least, ["u"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u long, v long), root being the least node of its component.

    Loops and repeated edges are ignored. A round costs a few shuffles of the edges, and the number of rounds grows with the
    logarithm of a component's extent. Nothing but a count and a checksum reaches the driver.
    """
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = _least_neighbour(large)
        pairs = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        before, now = now, staged(pairs.filter("u <> v").distinct(), "edges")
        discard(before)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
