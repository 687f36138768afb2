"""Image quality, projection and resizing. Kernels are numpy over one image; everything around them is relational."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platelake.sources.images import decode, encode_tiff, illumination_of


def ring_numbers(height: int, width: int) -> np.ndarray:
    """Ring of each frequency: one more than the whole radius, squared radii being folded by mirror images of the index grid."""
    squared = np.add.outer(np.arange(height) ** 2, np.arange(width) ** 2)
    for axis in (0, 1):
        squared = np.minimum(squared, np.flip(squared, axis))
    return np.sqrt(squared).astype(np.int64) + 1


def radial_power(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rings from 2 up to an eighth of the shorter side, and their sums of magnitude and power; no rings for small images."""
    if image.ndim != 2:
        raise ValueError("an image of two dimensions is needed")
    rings = np.arange(2, math.floor(min(image.shape) / 8))
    if not len(rings):
        return rings, np.zeros(0), np.zeros(0)
    x = image.astype(float)
    if np.ptp(x) > 0:
        with np.errstate(all="ignore"):
            x = x / np.median(np.abs(x - x.mean()))
    size = np.abs(np.fft.fft2(x - x.mean()))
    at = ring_numbers(*image.shape).ravel()
    sums = [np.bincount(at, v.ravel(), rings[-1] + 1)[rings] for v in (size, size**2)]
    return rings, *sums


def power_slope(image: np.ndarray) -> float | None:
    """Slope of log power over log ring, 0 if fewer than three rings have power, None without rings."""
    rings, _, power = radial_power(image)
    if not len(rings):
        return None
    ok = power > 0
    if ok.sum() <= 2:
        return 0.0
    x, y = np.log(rings[ok]), np.log(power[ok])
    return float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())


def percent_maximal(pixels: np.ndarray, mask: np.ndarray | None = None) -> float:
    """Percentage of pixels that equal the greatest, 0 without pixels."""
    p = pixels[mask] if mask is not None else pixels
    return 100.0 * float((p == p.max()).sum()) / p.size if p.size else 0.0


def percent_maximal_column(pixels: Column) -> Column:
    """percent_maximal of an array column."""
    top = F.array_max(pixels)
    return F.coalesce(F.try_divide(F.size(F.filter(pixels, lambda x: x == top)) * F.lit(100.0), F.size(pixels)), F.lit(0.0))


def pixel_statistics(pixels: Column) -> Column:
    """mean, spread (the median distance from the mean) and extent (greatest less least) of an array column, as a struct."""
    n = F.size(pixels)
    mean = F.try_divide(F.aggregate(pixels, F.lit(0.0), lambda a, x: a + x.cast("double")), n)
    gaps = F.array_sort(F.transform(pixels, lambda x: F.abs(x - mean)))
    middle = (F.try_element_at(gaps, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(gaps, F.floor(n / 2).cast("int") + 1)) / 2
    return F.struct(mean.alias("mean"), middle.alias("spread"), (F.array_max(pixels) - F.array_min(pixels)).alias("extent"))


def unpivot_channels(sites: DataFrame, key: str, prefix: str = "FileName_") -> DataFrame:
    """key, channel and file of every site and channel."""
    channels = [c for c in sites.columns if c.startswith(prefix)]
    entries = F.array(*(F.struct(F.lit(c[len(prefix) :]).alias("channel"), F.col(f"`{c}`").alias("file")) for c in channels))
    return sites.select(key, F.explode(entries).alias("e")).select(key, "e.channel", "e.file")


def image_quality(images: DataFrame, key: str, illumination: dict[str, np.ndarray] | None = None) -> DataFrame:
    """key, channel, slope, percent and error of images (key, channel, content). An array of another shape is not applied."""
    arrays = illumination or {}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for k, channel, content in zip(pdf[key], pdf["channel"], pdf["content"]):
                try:
                    if content is None:
                        raise FileNotFoundError("File Not Found")
                    x = decode(content)
                    light = illumination_of(arrays, channel)
                    if light is not None and light.shape == x.shape:
                        x = x / light
                    rows.append((k, channel, power_slope(x), percent_maximal(x), None))
                except Exception as e:
                    rows.append((k, channel, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "channel", "slope", "percent", "error"]).astype({"slope": float, "percent": float})

    kind = dict(images.dtypes)[key]
    return images.select(key, "channel", "content").mapInPandas(run, f"`{key}` {kind}, channel string, slope double, percent double, error string").withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("slope", "percent")})


def quality_columns(sites: DataFrame, quality: DataFrame, key: str, channels: list[str]) -> DataFrame:
    """sites with the slope, percentage and error of each channel in columns of their own. Two results for a site and channel are an error."""
    names = {"slope": "ImageQuality_PowerLogLogSlope_", "percent": "ImageQuality_PercentMaximal_", "error": "QC_Error_"}

    def one(channel: str, value: str) -> Column:
        of = F.col("channel") == channel
        return F.when(F.count_if(of) > 1, F.raise_error(F.lit(f"a site has two images of channel {channel}"))).otherwise(F.max(F.when(of, F.col(value))))

    return sites.join(quality.groupBy(key).agg(*(one(c, v).alias(n + c) for c in channels for v, n in names.items())), key, "left")


def plane_groups(planes: DataFrame, channels: int, n_planes: int, order: list, plate: str = "PlateID") -> DataFrame:
    """planes with chunk, channel and plane: rows of a plate in order, chunks of channels x planes rows; incomplete chunks go."""
    g = channels * n_planes
    r = F.row_number().over(Window.partitionBy(plate).orderBy(*order)) - 1
    rows = planes.withColumn("_r", r).withColumns({"chunk": F.floor(F.col("_r") / g).cast("long"), "channel": (F.col("_r") % g % channels).cast("long"), "plane": F.floor(F.col("_r") % g / channels).cast("long")})
    whole = F.count("*").over(Window.partitionBy(plate, "chunk")) == g
    return rows.withColumn("_whole", whole).filter("_whole").drop("_r", "_whole")


def _tops(parts: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of keys and, last, an array of pixels: the greatest values for each key, given out after most keys. Missing pixels count least."""
    held: dict[tuple, tuple[list[pa.Array], np.ndarray]] = {}

    def out() -> pa.RecordBatch:
        keys = [pa.concat_arrays(c) for c in zip(*(k for k, _ in held.values()))]
        return pa.RecordBatch.from_arrays([*keys, pa.array([x for _, x in held.values()], kind, from_pandas=True)], names=names)

    for b in parts:
        *keys, pixels = b.columns
        names, kind = b.schema.names, pixels.type
        for r in range(b.num_rows):
            if not pixels[r].is_valid:
                continue
            x, key = pixels[r].values.to_numpy(zero_copy_only=False), tuple(c[r].as_py() for c in keys)
            if key not in held:
                held[key] = [c.slice(r, 1) for c in keys], x
            elif held[key][1].shape != x.shape:
                raise ValueError("images of different size")
            else:
                held[key] = held[key][0], np.fmax(held[key][1], x)
            if most and len(held) >= most:
                yield out()
                held = {}
    if held:
        yield out()


def max_projection(stacks: DataFrame, keys: list[str], pixels: str = "pixels") -> DataFrame:
    """keys and pixels: the greatest value of each pixel over the images of a group. Images of different size are an error.

    Images are combined whole where they are, so that a group may be of any depth and a pixel never becomes a row; what is left
    of a group is as many images as partitions hold some."""
    rows = stacks.select(*keys, pixels)
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    partial = rows.mapInArrow(lambda parts: _tops(parts, 64), schema)
    return partial.groupBy(*keys).applyInArrow(lambda t: pa.Table.from_batches(list(_tops(iter(t.select([*keys, pixels]).to_batches())))), schema)


def project_images(planes: DataFrame, keys: list[str], path: str = "path", order: str = "plane", content: str = "content") -> DataFrame:
    """keys, path (of the first plane), content and error: the greatest value of each pixel over the image files of a group, as TIFF.

    A group is the planes of one stack, so it is as small as a stack is deep. Images of different shape, or one that is missing
    or broken, are reported and give no content."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        made, error = None, None
        try:
            for data in pdf[content]:
                if data is None:
                    raise FileNotFoundError("File Not Found")
                x = decode(data)
                if made is not None and (x.shape != made.shape):
                    raise ValueError("images of different shape")
                made = x if made is None else np.maximum(made, x)
            made = encode_tiff(made)
        except Exception as e:
            made, error = None, f"{type(e).__name__}: {e}"
        return pd.DataFrame([[*key, pdf[path].iloc[0], made, error]], columns=[*keys, path, "content", "error"])

    kinds = dict(planes.dtypes)
    return planes.groupBy(*keys).applyInPandas(one, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", `{path}` string, content binary, error string")


def _lanczos_weights(old: int, new: int, lobes: int = 3) -> np.ndarray:
    """Resampling matrix (new x old) of the windowed sinc, widened when shrinking."""
    scale = old / new
    wide = max(scale, 1.0)
    center = (np.arange(new) + 0.5) * scale
    x = (np.arange(old)[None, :] + 0.5 - center[:, None]) / wide
    w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, resolution: int = 1080) -> np.ndarray:
    """The image resampled to resolution x resolution, rounded and clipped to its type."""
    if image.ndim == 3:  # colours are resampled one by one
        return np.stack([resize(image[..., k], resolution) for k in range(image.shape[2])], axis=-1)
    out = _lanczos_weights(image.shape[0], resolution) @ image.astype(float) @ _lanczos_weights(image.shape[1], resolution).T
    if image.dtype.kind in "ui":
        info = np.iinfo(image.dtype)
        return np.clip(np.rint(out), info.min, info.max).astype(image.dtype)
    return out.astype(image.dtype)
