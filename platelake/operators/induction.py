"""Induction scores, control thresholds, hits and their summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.functions.scalars import natural_key, percent

PLATE, TIME, COMPOUND, CONC = "Metadata_Plate", "Metadata_Timepoint", "Metadata_Compound", "Metadata_ConcLevel"


def induction(features: list[str] | Column, threshold: float = 0.95, array: bool = False) -> Column:
    """Share of features strictly above threshold; missing values are not, and all features count in the share."""
    if array:
        return F.size(F.filter(features, lambda x: F.coalesce(x > threshold, F.lit(False)))) / F.nullif(F.size(features), F.lit(0))
    above = [F.when(F.col(f"`{c}`") > threshold, 1).otherwise(0) for c in features]
    return reduce(lambda a, b: a + b, above) / F.lit(len(features))


def control_threshold(df: DataFrame, control: Column, q: float = 0.95, value: str = "induction", keys: tuple[str, ...] = (PLATE, TIME)) -> DataFrame:
    """keys and threshold: the exact quantile, linearly interpolated, of the control rows of each group."""
    return df.filter(control).dropna(subset=list(keys)).groupBy(*keys).agg(F.percentile(value, q).alias("threshold"))


def mean_induction(df: DataFrame, control: Column, keys: tuple[str, ...] = (PLATE, TIME, COMPOUND, CONC)) -> DataFrame:
    """keys and induction_mean of the rows that are not controls."""
    return df.filter(~control).dropna(subset=list(keys)).groupBy(*keys).agg(F.avg("induction").alias("induction_mean"))


def flag_hits(means: DataFrame, thresholds: DataFrame, keys: tuple[str, ...] = (PLATE, TIME)) -> DataFrame:
    """means with threshold and Bioactive: 1 where the mean reaches the threshold, 0 where it does not or there is none."""
    met = means.join(thresholds, list(keys), "left")
    return met.withColumn("Bioactive", F.coalesce((F.col("induction_mean") >= F.col("threshold")).cast("int"), F.lit(0)))


def hits_by(flags: DataFrame, *keys: str) -> DataFrame:
    """The greatest flag of each group."""
    return flags.groupBy(*keys).agg(F.max("Bioactive").alias("Bioactive"))


def hit_pivot(flags: DataFrame, times: list[str], keys: tuple[str, ...] = (PLATE, COMPOUND)) -> DataFrame:
    """A column of flags for each time, 0 where a group lacks it, and any_active. times is listed, so that no job looks for it."""
    table = flags.groupBy(*keys).pivot(TIME, times).agg(F.max("Bioactive")).fillna(0, times)
    return table.withColumn("any_active", reduce(lambda a, b: F.greatest(a, b), (F.col(f"`{t}`") for t in times[1:]), F.col(f"`{times[0]}`")))


def ordered_times(df: DataFrame) -> list[str]:
    """Labels of times in natural order, those without digits last."""
    return [r[0] for r in df.select(TIME).distinct().filter(F.col(TIME).isNotNull()).orderBy(natural_key(F.col(TIME)).asc_nulls_last(), TIME).collect()]


def venn(flags: DataFrame) -> DataFrame:
    """only_all, only_active, both: all compounds against bioactive ones."""
    of = flags.filter(F.col(COMPOUND).isNotNull()).groupBy(COMPOUND).agg(F.max("Bioactive").alias("active"))
    return of.agg(F.count_if(F.col("active") == 0).alias("only_all"), F.lit(0).cast("long").alias("only_active"), F.count_if(F.col("active") == 1).alias("both"))


def venn_per_time(flags: DataFrame) -> DataFrame:
    """For each time with a hit: bioactive compounds of any time against those of this one, and the percentage."""
    ever = flags.filter("Bioactive = 1").select(COMPOUND).distinct().agg(F.count("*").alias("n_all"))
    now = flags.filter("Bioactive = 1").groupBy(TIME).agg(F.count_distinct(COMPOUND).alias("both"))
    met = now.join(F.broadcast(ever))  # one row
    return met.select(TIME, (F.col("n_all") - F.col("both")).alias("only_all"), F.lit(0).cast("long").alias("only_time"), "both", percent(F.col("both"), F.col("n_all")).alias("percent"))


def _with_range(df: DataFrame, keys: list[str], value: str, *more: Column) -> DataFrame:
    """Rows that hold value, with _lo and _hi, the least and greatest value of their own group, and more of its aggregates."""
    rows = df.filter(F.col(value).isNotNull())
    range_ = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), *more)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return rows.join(range_, same).drop(*(f"_{k}" for k in keys))


def histogram(df: DataFrame, keys: list[str], value: str = "induction", bins: int = 100) -> DataFrame:
    """keys, bin, low, high, n: counts in equal bins between the least and the greatest value of each group; the last bin is closed.

    A group of one value has bins around it, of a width of 1 in all. Bins without rows are left out."""
    half = F.when(F.col("_hi") == F.col("_lo"), 0.5).otherwise(0.0)
    met = _with_range(df, keys, value).withColumns({"_w": (F.col("_hi") - F.col("_lo") + 2 * half) / bins, "_lo": F.col("_lo") - half})
    k = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("_lo")) / F.col("_w"))).cast("long")
    grouped = met.groupBy(*keys, k.alias("bin")).agg(F.count("*").alias("n"), F.min("_lo").alias("_lo"), F.min("_w").alias("_w"))
    return grouped.select(*keys, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("low"), (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("high"), "n")


def density(df: DataFrame, keys: list[str], value: str = "induction", points: int = 200, cut: float = 0.0) -> DataFrame:
    """keys, x, density: a Gaussian kernel estimate by Scott's rule on an even grid over each group's range, cut bandwidths wider.

    The curve over a histogram ends where the data do, so cut is 0. It reads the distinct values of a group with their counts (an
    induction score has one more value than features), so that it is a sum over grid x values in SQL. Groups of one value have none."""
    rows = df.filter(F.col(value).isNotNull())
    stats = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.stddev_samp(value).alias("_s"), F.min(value).alias("_lo"), F.max(value).alias("_hi")).filter("_s > 0")
    stats = stats.withColumn("_h", F.col("_s") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    step = (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / (points - 1)
    grid = stats.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", F.col("_lo") - cut * F.col("_h") + F.col("_k") * step)
    values = rows.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    z = (F.col("x") - F.col("_v")) / F.col("_h")
    share = F.col("_c") * F.exp(-0.5 * z * z) / (F.col("_n") * F.col("_h") * (2 * 3.141592653589793) ** 0.5)
    return grid.join(values, keys).groupBy(*keys, "x").agg(F.sum(share).alias("density"))


def numbered_rows(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """r: the number of a row in its group, from 0, in a stated order."""
    return df.withColumn("r", (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))
