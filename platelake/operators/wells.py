"""From object tables to well profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platelake.functions.naming import PREFIXES, drop_bookkeeping, prefixed, whole_integers
from platelake.functions.scalars import upper_of
from platelake.operators.qc import any_flag, with_image_metadata, without_failing
from platelake.operators.selection import unite

#: Aggregates by name.
AGGREGATES = {"mean": F.avg, "median": F.median, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_samp, "count": F.count}


def _numeric(df: DataFrame, but: tuple[str, ...] | list[str]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in but]


def aggregate_by(df: DataFrame, keys: list[str], how: str = "mean", order: str | None = None) -> DataFrame:
    """Every numeric column aggregated by keys; rows with a null key are left out. first needs an order and skips nulls."""
    cols = _numeric(df, [*keys, *([order] if order else [])])
    rows = df.dropna(subset=keys)
    if how == "first":
        if order is None:
            raise ValueError("first needs a column that orders the rows")
        return rows.groupBy(*keys).agg(*(F.expr(f"min_by(`{c}`, `{order}`) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in cols))
    return rows.groupBy(*keys).agg(*(AGGREGATES[how](F.col(f"`{c}`")).alias(c) for c in cols))


def site_scaling(df: DataFrame, scope: list[str], well: str = "Metadata_Well", site: str = "Metadata_Site") -> DataFrame:
    """scope, well, n_sites and scaling_factor: most sites of any well in scope over the sites of the well."""
    sites = df.dropna(subset=[*scope, well]).groupBy(*scope, well).agg(F.count_distinct(site).alias("n_sites"))
    most = F.max("n_sites").over(Window.partitionBy(*scope) if scope else Window.partitionBy(F.lit(1)))
    return sites.withColumn("scaling_factor", F.try_divide(most, F.col("n_sites")))


def scale_counts(df: DataFrame, scope: list[str], columns: list[str] | None = None, well: str = "Metadata_Well", site: str = "Metadata_Site") -> DataFrame:
    """Integer features times the scaling factor of their well; columns defaults to the integer columns without nulls."""
    columns = whole_integers(df) if columns is None else columns
    factors = site_scaling(df, scope, well, site).drop("n_sites")
    scaled = df.join(factors, [*scope, well])
    return scaled.withColumns({c: F.col(f"`{c}`") * F.col("scaling_factor") for c in columns if c not in scope}).drop("scaling_factor")


def outer_merge(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of several tables by keys, which hold no nulls; shared other names are told apart by the number of their table."""
    seen: set[str] = set()
    named = []
    for k, t in enumerate(tables):
        named.append(t.withColumnsRenamed({c: f"{c}_{k}" for c in t.columns if c in seen and c not in keys}))
        seen |= set(t.columns)
    return reduce(lambda a, b: a.join(b, keys, "full"), named)


def annotate(profiles: DataFrame, platemap: DataFrame, keys: list[str]) -> DataFrame:
    """Profiles of wells on the plate map, its columns first."""
    extra = [c for c in profiles.columns if c not in platemap.columns]
    return platemap.join(profiles.select(*keys, *(f"`{c}`" for c in extra)), keys).select(*platemap.columns, *(f"`{c}`" for c in extra))


def platemap_of(df: DataFrame) -> DataFrame:
    """The four columns of a plate map, compounds in upper case."""
    cols = ["Metadata_Compound", "Metadata_ConcLevel", "Metadata_Well", "Metadata_Plate"]
    return df.select(*cols).withColumn("Metadata_Compound", upper_of(F.col("Metadata_Compound")))


def plate_profiles(tables: dict[str, list[tuple[DataFrame, DataFrame]]], platemaps: DataFrame, scope: tuple[str, ...] = ("Metadata_Plate", "Metadata_Timepoint"), how: str = "mean", qc_drop: bool = True) -> DataFrame:
    """Annotated well profiles of all plates and times at once. tables holds, by name, frames that have scope's columns, each with
    scope and whole, the columns of whole numbers there; platemaps has the wells of every plate.

    Images are numbered, wells counted and scaled within each combination of scope."""
    on, keys = [*scope, "ImageNumber"], [*scope, "Metadata_Well"]
    known = ("Metadata_Well", "Metadata_Site")
    facts = unite([f.select(*on, *(c for c in known if c in f.columns), any_flag(f).alias("_fails")) for f, _ in tables["Image"]])
    merged = []
    for name, prefix in PREFIXES.items():
        parts = []
        for frame, whole in tables.get(name, []):
            t = with_image_metadata(frame, facts, within=scope)
            if qc_drop:
                t = t.join(facts.filter("_fails").select(*on), on, "left_anti")
                t = prefixed(drop_bookkeeping(t, (*keys, "Metadata_Site")), prefix)
                met = t.join(site_scaling(t, list(scope)).drop("n_sites"), keys).join(whole, list(scope))
                place = {prefix + c: k for k, c in enumerate(frame.columns)}
                numbers = [f.name for f in t.schema if isinstance(f.dataType, T.NumericType) and f.name in place]
                counts = {c: F.when(F.col("whole")[place[c]], F.col(f"`{c}`") * F.col("scaling_factor")).otherwise(F.col(f"`{c}`")) for c in numbers}
                t = met.withColumns(counts).drop("scaling_factor", "whole", "Metadata_Site")
            else:
                t = prefixed(drop_bookkeeping(t, tuple(keys)), prefix)
            parts.append(aggregate_by(t, keys, how))
        if parts:
            merged.append(unite(parts))
    layout = platemap_of(platemaps)
    done = annotate(outer_merge(merged, keys), layout, ["Metadata_Plate", "Metadata_Well"])
    rest = [c for c in done.columns if c not in layout.columns and c != "Metadata_Timepoint"]
    return done.select(*layout.columns, *(f"`{c}`" for c in rest), "Metadata_Timepoint")


def well_profiles(tables: dict[str, DataFrame], platemap: DataFrame, timepoint: str, how: str = "mean", qc_drop: bool = True) -> DataFrame:
    """Object tables (Image, Nuclei, Cells, Cytoplasm) of one plate and time to annotated well profiles."""
    images = tables["Image"]
    wells = []
    for name, prefix in PREFIXES.items():
        if name not in tables:
            continue
        t = with_image_metadata(tables[name], images)
        if qc_drop:
            t = prefixed(drop_bookkeeping(without_failing(t, images), ("Metadata_Well", "Metadata_Site")), prefix)
            t = scale_counts(t, []).drop("Metadata_Site")
        else:
            t = prefixed(drop_bookkeeping(t), prefix)
        wells.append(aggregate_by(t, ["Metadata_Well"], how))
    merged = outer_merge(wells, ["Metadata_Well"])
    return annotate(merged, platemap_of(platemap), ["Metadata_Well"]).withColumn("Metadata_Timepoint", F.lit(timepoint))
