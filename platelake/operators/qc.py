"""Image quality flags and metadata propagation."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flags(df: DataFrame, part: str) -> list[Column]:
    return [F.col(f"`{c}`").cast("double") for c in df.columns if part in c]


def any_flag(df: DataFrame, part: str = "ImageQC_") -> Column:
    """Fails when any flag is other than zero; a missing flag is none."""
    return reduce(or_, (F.coalesce(c != 0, F.lit(False)) for c in _flags(df, part)), F.lit(False))


def sum_below_one(df: DataFrame, part: str = "ImageQC_") -> Column:
    """Passes when the flags sum to less than 1, missing ones aside. Not the opposite of any_flag."""
    return reduce(add, (F.coalesce(c, F.lit(0.0)) for c in _flags(df, part)), F.lit(0.0)) < 1


def without_failing(objects: DataFrame, images: DataFrame, key: str = "ImageNumber") -> DataFrame:
    """Objects of images on which no flag is set."""
    return objects.join(images.filter(any_flag(images)).select(key), key, "left_anti")


def with_image_metadata(objects: DataFrame, images: DataFrame, columns: tuple[str, ...] = ("Metadata_Well", "Metadata_Site"), key: str = "ImageNumber", within: tuple[str, ...] = ()) -> DataFrame:
    """Image metadata joined on, if the first of columns is missing and the key is there; objects without an image keep nulls.

    within names columns within which key is unique."""
    if columns[0] in objects.columns or key not in objects.columns:
        return objects
    return objects.join(images.select(*within, key, *(c for c in columns if c not in objects.columns)), [*within, key], "left")


def tables_with_metadata(tables: dict[str, DataFrame], columns: tuple[str, ...], key: str = "ImageNumber", within: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Image metadata joined on to every object table if the nuclei lack the site, and to none if they have it."""
    if "Nuclei" not in tables or "Metadata_Site" in tables["Nuclei"].columns:
        return tables
    joined = lambda t: t.drop(*columns).join(tables["Image"].select(*within, key, *columns), [*within, key], "left")
    return {n: t if n == "Image" else joined(t) for n, t in tables.items()}


def mask_rows(rows: DataFrame, quality: DataFrame, key: str, passes: Column) -> DataFrame:
    """Rows whose keyed quality record passes; a row without a record is an error, not a silent loss."""
    met = rows.join(quality.select(key, passes.alias("_passes")), key, "left")
    checked = F.when(F.col("_passes").isNull(), F.raise_error(F.lit("a row has no quality record")).cast("boolean")).otherwise(F.col("_passes"))
    return met.filter(checked).drop("_passes")
