"""Robust normalisation fitted on control rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.operators.profiles import Profiles

#: Makes the MAD of normal values their standard deviation; what keeps the divisor from zero.
MAD_SCALE, EPSILON = 1.4826, 1e-18


def control_statistics(profiles: Profiles, keys: list[str], control: Column) -> DataFrame:
    """keys, center and spread: arrays of the medians and scaled MADs of each feature over the control rows of each group.

    The controls of one plate and time are some tens of wells, whose exact medians fit in memory whatever the corpus. Over objects
    the different values of a group and feature must fit in a task."""
    values = Profiles(profiles.df.filter(control), profiles.names, profiles.meta).long(*keys).filter("x IS NOT NULL")
    medians = values.groupBy(*keys, "pos").agg(F.median("x").alias("m"))
    spreads = values.join(medians, [*keys, "pos"]).groupBy(*keys, "pos").agg(F.first("m").alias("m"), (F.median(F.abs(F.col("x") - F.col("m"))) * MAD_SCALE).alias("s"))
    cells = F.map_from_entries(F.collect_list(F.struct("pos", F.struct("m", "s"))))
    at = F.sequence(F.lit(0), F.lit(max(0, len(profiles.names) - 1)))
    gathered = spreads.groupBy(*keys).agg(cells.alias("cells"))
    return gathered.select(*keys, F.transform(at, lambda i: F.col("cells")[i]["m"]).alias("center"), F.transform(at, lambda i: F.col("cells")[i]["s"]).alias("spread"))


def mad_robustize(profiles: Profiles, keys: list[str], control: Column, epsilon: float = EPSILON, require: bool = False) -> Profiles:
    """(x - median) / (MAD + epsilon) by group. A group without controls gets nulls, or is an error if require is set."""
    stats = control_statistics(profiles, keys, control)
    met = profiles.df.join(stats, keys, "left")
    if require:
        met = met.filter(F.when(F.col("center").isNull(), F.raise_error(F.lit("a group has no control rows")).cast("boolean")).otherwise(F.lit(True)))
    scaled = F.zip_with(F.zip_with("features", "center", lambda x, m: x - m), F.col("spread"), lambda d, s: d / (s + epsilon))
    return Profiles(met.withColumn("features", scaled).drop("center", "spread"), profiles.names, profiles.meta)
