"""The array layout of profiles: metadata columns and one array of features, with their names kept beside it.

Statistics over very many columns are planned as one aggregate over (position, value) rows instead of one expression a column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Profiles:
    """df holds the metadata columns and features, an array<double> in the order of names; NaN is NULL."""

    df: DataFrame
    names: list[str]
    meta: list[str]

    @classmethod
    def of(cls, wide: DataFrame, features: list[str], keep: list[str] | None = None) -> Profiles:
        meta = [c for c in wide.columns if c not in features] if keep is None else keep
        values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in features]
        return cls(wide.select(*(f"`{c}`" for c in meta), F.array(*values).cast("array<double>").alias("features")), list(features), meta)

    def wide(self) -> DataFrame:
        return self.df.select(*(f"`{c}`" for c in self.meta), *(F.col("features")[k].alias(n) for k, n in enumerate(self.names)))

    def long(self, *columns: str) -> DataFrame:
        """Rows of columns, pos and x."""
        return self.df.select(*columns, F.posexplode("features").alias("pos", "x"))

    def mapped(self, f) -> Profiles:
        """f applied to every value."""
        one = lambda x: f(x)  # noqa: E731  f may have more parameters, transform would fill a second one
        return Profiles(self.df.withColumn("features", F.transform("features", one)), self.names, self.meta)

    def keeping(self, names: list[str]) -> Profiles:
        """Only some features."""
        at = [self.names.index(n) for n in names]
        picked: Column = F.array(*(F.col("features")[k] for k in at)).cast("array<double>")
        return Profiles(self.df.withColumn("features", picked), list(names), self.meta)
