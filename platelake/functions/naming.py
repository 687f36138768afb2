"""Column rules by naming convention: what is metadata, what is a feature, what is dropped or renamed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of names that mark bookkeeping columns.
BOOKKEEPING = ("ExecutionTime", "ModuleError", "URL")
#: Prefix of each measurement table.
PREFIXES = {"Image": "Image_", "Nuclei": "DNA_", "Cells": "Cell_", "Cytoplasm": "Cyto_"}
#: Cells of a CSV file that mean "no value".
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def features_without(df: DataFrame, part: str = "Metadata") -> list[str]:
    """Columns whose name does not contain part."""
    return [c for c in df.columns if part not in c]


def features_not_starting(df: DataFrame, prefix: str = "Metadata_") -> list[str]:
    """Columns whose name does not start with prefix."""
    return [c for c in df.columns if not c.startswith(prefix)]


def drop_bookkeeping(df: DataFrame, keep: Iterable[str] = ("Metadata_Well",), parts: Iterable[str] = BOOKKEEPING) -> DataFrame:
    """Without ImageNumber, metadata other than keep, and bookkeeping columns."""
    keep, parts = set(keep), tuple(parts)
    gone = [c for c in df.columns if c == "ImageNumber" or (c.startswith("Metadata") and c not in keep) or any(p in c for p in parts)]
    return df.drop(*gone)


def drop_text_features(df: DataFrame) -> DataFrame:
    """Without string columns that are not metadata."""
    return df.drop(*(f.name for f in df.schema if isinstance(f.dataType, T.StringType) and "Metadata" not in f.name))


def drop_stale_qc(df: DataFrame) -> DataFrame:
    """Without the columns of an earlier image quality run."""
    return df.drop(*(c for c in df.columns if "ImageQuality_" in c or "QC_Error" in c))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """prefix before every column that is not metadata."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if not c.startswith("Metadata_")})


def nulls_for_tokens(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """NULL for cells of string columns that mean "no value"; the comparison is exact, so NAN stays a string."""
    tokens = list(tokens)
    return df.withColumns({f.name: F.when(~F.col(f"`{f.name}`").isin(tokens), F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)})


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """NULL for NaN in floating columns, so that comparisons and aggregates skip it."""
    return df.withColumns({f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def whole_integers(df: DataFrame) -> list[str]:
    """Integral columns without a null: a blank makes a column floating for the purposes of scaling. One aggregate over the table."""
    cols = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType) and not f.name.startswith("Metadata")]
    if not cols:
        return []
    row = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols)).first()
    return [c for c in cols if row[c] == 0]
