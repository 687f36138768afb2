"""Scalar functions as Column expressions; none needs a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scale of the double sigmoid.
SIGMOID = 2.3538


def double_sigmoid(x: Column, scale: float = SIGMOID) -> Column:
    """(x/a)^3 / sqrt(1 + (x/a)^6): odd, between -1 and 1; overflows to 0 for huge x as the formula does."""
    cube = F.pow(x / scale, 3)
    return cube / F.sqrt(1 + F.pow(x / scale, 6))


def natural_key(label: Column) -> Column:
    """The first run of digits as a number, NULL without digits; order it nulls last."""
    return F.try_to_number(F.nullif(F.regexp_extract(label, r"(\d+)", 1), F.lit("")), F.lit("9" * 18)).cast("bigint")


def upper_of(value: Column) -> Column:
    """Upper case of the value as text; NULL becomes NAN."""
    return F.upper(F.coalesce(value.cast("string"), F.lit("nan")))


def strip_leading(text: Column, chars: str) -> Column:
    """Without leading characters of a set (not a prefix)."""
    return F.ltrim(text, F.lit(chars))


def strip_prefix(text: Column, prefix: str) -> Column:
    """Without a prefix."""
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 1 << 30)).otherwise(text)


def stacked_path(path: Column, old: str = "Images", new: str = "ImagesStacked") -> Column:
    """The first segment old becomes new."""
    parts = F.split(path, "/", -1)
    at = F.array_position(parts, old)
    return F.array_join(F.transform(parts, lambda x, i: F.when(i + 1 == at, F.lit(new)).otherwise(x)), "/")


def binned_key(key: Column) -> Column:
    """Every Image becomes Image_binned, wherever it stands."""
    return F.replace(key, F.lit("Image"), F.lit("Image_binned"))


def well_of_position(position: Column, columns: int = 24) -> Column:
    """Well name of a position that counts from 1 along rows."""
    return well_of(F.floor((position - 1) / columns) + 1, F.pmod(position - 1, F.lit(columns)) + 1)


def well_of(row: Column, column: Column) -> Column:
    """Well name of a row and a column that count from 1."""
    return F.concat(F.char(64 + row), F.lpad(column.cast("string"), 2, "0"))


def path_join(left: Column, right: Column) -> Column:
    """Paths joined by one slash; an absolute right side wins."""
    return F.when(right.startswith("/"), right).when((left == "") | left.endswith("/"), F.concat(left, right)).otherwise(F.concat_ws("/", left, right))


def last_segment(path: Column) -> Column:
    """The last segment of a path, a trailing slash aside."""
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def file_label(text: Column) -> Column:
    """Blanks and slashes become underscores."""
    return F.translate(text, " /", "__")


def capitalised(text: Column) -> Column:
    """The first character in upper case, the others in lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.right(text, F.char_length(text) - 1)))


def scale_8bit(pixels: Column) -> Column:
    """Pixels from 0 (least) to 255 (greatest), truncated; all zero when they are equal."""
    low, high = F.array_min(pixels), F.array_max(pixels)
    return F.transform(pixels, lambda x: F.when(high == low, F.lit(0)).otherwise((255 * (x - low) / F.nullif(high - low, F.lit(0.0))).cast("int")))


def divide_illumination(pixels: Column, illumination: Column) -> Column:
    """pixels / illumination where the shapes agree, else pixels as they are."""
    divided = F.zip_with(pixels, illumination, lambda x, y: F.try_divide(x, y))
    return F.when(F.size(pixels) == F.size(illumination), divided).otherwise(pixels)


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 if either is zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(F.try_divide(dot, norm(a) * norm(b)), F.lit(0.0))


def scaled_vector(v: Column, by: Column) -> Column:
    """v / by, zeros where by is 0."""
    return F.transform(v, lambda x: F.when(by == 0, F.lit(0.0)).otherwise(F.try_divide(x, by)))


def percent(part: Column, whole: Column) -> Column:
    """Percentage truncated to an integer, 0 of nothing."""
    return F.coalesce(F.try_divide(part * 100, whole), F.lit(0)).cast("int")
