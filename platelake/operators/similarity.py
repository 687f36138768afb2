"""Replicate similarity by cosine."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platelake.functions.scalars import cosine, norm


def average_cosine(df: DataFrame, keys: list[str], vector: str = "features") -> DataFrame:
    """keys, n and the mean cosine over all pairs of rows in a group, NULL for a single row.

    The mean over pairs of unit vectors is (|sum u|^2 - rows that are not zero) / (n (n - 1)), so no pair is formed: the sums are
    combined before the shuffle and a group may be of any size. Missing values count 0; rows with a null key are left out.
    """
    filled = df.dropna(subset=keys).select(*keys, F.transform(vector, lambda x: F.coalesce(x.cast("double"), F.lit(0.0))).alias("v"))
    units = filled.withColumn("l", norm(F.col("v")))
    counts = units.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("l") > 0).alias("some"))
    parts = units.filter("l > 0").select(*keys, F.posexplode(F.transform("v", lambda x: F.try_divide(x, F.col("l")))).alias("pos", "u"))
    squares = parts.groupBy(*keys, "pos").agg(F.sum("u").alias("s")).groupBy(*keys).agg(F.sum(F.col("s") * F.col("s")).alias("squares"))
    mean = F.try_divide(F.coalesce("squares", F.lit(0.0)) - F.col("some"), F.col("n") * (F.col("n") - 1))
    return counts.join(squares, keys, "left").select(*keys, "n", mean.alias("average_cosine_similarity"))


def replicate_cosines(df: DataFrame, keys: list[str], vector: str = "features", order: str = "row_idx", most: int = 2000) -> DataFrame:
    """keys, replicates and cosine_similarities: the cosines of all pairs i < j of a group in order.

    The result itself grows with the square of a group; a group of more than most rows is an error rather than a lost task.
    """
    numbered = df.dropna(subset=keys).withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    limited = numbered.filter(F.when(F.col("i") >= most, F.raise_error(F.lit("too many replicates for a pair list")).cast("boolean")).otherwise(F.lit(True)))
    filled = limited.select(*keys, "i", F.transform(vector, lambda x: F.coalesce(x.cast("double"), F.lit(0.0))).alias("v"))
    a, b = filled.alias("a"), filled.select(*keys, F.col("i").alias("j"), F.col("v").alias("w")).alias("b")
    pairs = a.join(b, keys).filter("i < j").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "j", cosine(F.col("v"), F.col("w")).alias("c")))).alias("p"))
    groups = filled.groupBy(*keys).agg(F.sort_array(F.collect_list("i")).alias("replicates"))
    return groups.join(pairs, keys, "left").select(*keys, "replicates", F.coalesce(F.col("p.c"), F.array().cast("array<double>")).alias("cosine_similarities"))


def replicate_cosine_summary(df: DataFrame, keys: list[str], vector: str = "features", order: str = "row_idx", lane: int = 1024) -> DataFrame:
    """keys, n_pairs, low, high and total: count, least, greatest and sum of the cosines of all pairs of rows in a group.

    A group's rows are dealt over lanes of about lane rows by order, and lanes meet in pairs; each pair of lanes gives one row. Rows that share
    both keys and order share a lane. Missing values count 0; rows with a null key are left out, and so are groups without pairs.
    """
    filled = df.dropna(subset=keys).select(*keys, F.xxhash64(order).alias("_h"), F.transform(vector, lambda x: F.coalesce(x.cast("double"), F.lit(0.0))).alias("_v"))
    lanes = filled.groupBy(*keys).agg(F.ceil(F.count("*") / lane).cast("int").alias("_lanes"))
    dealt = filled.join(lanes, keys).withColumn("_lane", F.pmod("_h", F.col("_lanes")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1)))
    met = dealt.select(*keys, F.least("_lane", "_other").alias("_a"), F.greatest("_lane", "_other").alias("_b"), "_lane", "_v")

    def compared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dims = max((len(v) for v in pdf["_v"] if v is not None), default=0)
        x, known = np.zeros((len(pdf), dims)), np.array([v is not None for v in pdf["_v"]])
        for k, v in enumerate(pdf["_v"]):
            if v is not None:
                x[k, : len(v)] = v
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
        one = (pdf["_lane"] == key[-2]).to_numpy()
        same = key[-2] == key[-1]
        left, right, ok_l, ok_r = (x, x, known, known) if same else (x[one], x[~one], known[one], known[~one])
        n = len(left) * (len(left) - 1) // 2 if same else len(left) * len(right)
        low, high, total, some = np.inf, -np.inf, 0.0, False
        for k in range(0, len(left), 256):
            c, use = left[k : k + 256] @ right.T, np.logical_and.outer(ok_l[k : k + 256], ok_r)
            if same:
                use &= np.arange(len(right))[None, :] > np.arange(k, k + len(c))[:, None]
            c = c[use]
            if len(c):
                low, high, total, some = min(low, c.min()), max(high, c.max()), total + c.sum(), True
        return pd.DataFrame([[*key[:-2], n, *((float(low), float(high), float(total)) if some else (None, None, None))]], columns=names)

    names = [*keys, "n_pairs", "low", "high", "total"]
    kinds = dict(df.dtypes)
    parts = met.groupBy(*keys, "_a", "_b").applyInPandas(compared, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_pairs long, low double, high double, total double")
    return parts.groupBy(*keys).agg(F.sum("n_pairs").alias("n_pairs"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")).filter("n_pairs > 0")
