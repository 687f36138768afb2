"""From segmented sites to cell, site and well embeddings. Models are callables that the user supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions.scalars import scaled_vector

#: Side of the box around a cell, in pixels.
BOX = 200


def inside(y: Column, x: Column, height: Column, width: Column, box: int = BOX) -> Column:
    """The box around (y, x) lies within the image."""
    h = box // 2
    return (y - h >= 0) & (y + h <= height) & (x - h >= 0) & (x + h <= width)


def dead(probability: Column, threshold: float = 0.5) -> Column:
    """Strictly above the threshold."""
    return probability > threshold


def centroids(mask: np.ndarray) -> list[tuple[int, int, int]]:
    """(label, y, x) of every label of a mask but 0, centres truncated to whole pixels."""
    labels = mask.ravel().astype(np.int64)
    n = np.bincount(labels)
    y, x = (np.bincount(labels, v.ravel()) for v in np.indices(mask.shape))
    return [(int(k), int(y[k] / n[k]), int(x[k] / n[k])) for k in np.flatnonzero(n) if k]


def mask_centroids(mask: DataFrame, keys: list[str]) -> DataFrame:
    """centroids of masks in long form (keys, label, y, x)."""
    return mask.filter("label <> 0").groupBy(*keys, "label").agg(F.avg("y").cast("int").alias("Y_Center"), F.avg("x").cast("int").alias("X_Center"))


def crop(stack: np.ndarray, mask: np.ndarray, label: int, y: int, x: int, box: int = BOX) -> np.ndarray:
    """The box around a cell, other cells and background 0."""
    h = box // 2
    own = mask[y - h : y + h, x - h : x + h] == label
    return stack[y - h : y + h, x - h : x + h] * own[..., None]


def to_8bit(x: np.ndarray) -> np.ndarray:
    """Each channel from 0 to 255, truncated; zeros where it is constant."""
    low, high = x.min((0, 1)), x.max((0, 1))
    width = np.where(high == low, 1, high - low)
    return np.where(high == low, 0, 255.0 * (x - low) / width).astype(np.uint8)


def process_sites(sites: DataFrame, key: str, load: Callable[[dict], np.ndarray], models: Callable[[], tuple[Callable, Callable, Callable | None]], channels: int, box: int = BOX, drop_dead: bool = False) -> DataFrame:
    """One row a cell: key, cell_index, y, x, is_dead, embedding (channels x values, flat) and error; a site without cells has one row without cell_index.

    load makes the (height, width, channels) stack of a site's row; models makes (segment, embed, classify) once a task. A site
    with another number of channels is empty; a site that fails has an error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segment, embed, classify = models()
        cols = [key, "cell_index", "y", "x", "is_dead", "embedding", "error"]
        for pdf in parts:
            rows = []
            for site in pdf.to_dict("records"):
                none = (site[key], None, None, None, None, None)
                try:
                    stack = load(site)
                    if stack.shape[-1] != channels:
                        rows.append((*none, None))
                        continue
                    mask = segment(stack)
                    h, (height, width) = box // 2, mask.shape
                    found = [(k, y, x) for k, y, x in centroids(mask) if y - h >= 0 and y + h <= height and x - h >= 0 and x + h <= width]
                    if not found:
                        rows.append((*none, None))
                        continue
                    vectors = np.asarray(embed(np.stack([to_8bit(crop(stack, mask, *c, box)) for c in found])), np.float32)
                    flat = vectors.reshape(len(found), -1)
                    dies = np.asarray(classify(flat)) > 0.5 if classify else np.zeros(len(found), bool)
                    kept = [(f, v, d) for f, v, d in zip(found, flat, dies) if not (drop_dead and d)]
                    rows += [(site[key], i, y, x, bool(d), v.tolist(), None) for i, ((_, y, x), v, d) in enumerate(kept)] or [(*none, None)]
                except Exception as e:
                    rows.append((*none, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in zip(cols, zip(*rows))})

    kind = dict(sites.dtypes)[key]
    return sites.mapInPandas(run, f"`{key}` {kind}, cell_index int, y int, x int, is_dead boolean, embedding array<float>, error string")


def site_sums(cells: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """keys, Cell_Count, Dead_Cells and total: the sum of the vectors of living cells; sums are combined before the shuffle."""
    counts = cells.groupBy(*keys).agg(F.count(vector).alias("Cell_Count"), F.count_if(F.coalesce("is_dead", F.lit(False))).alias("Dead_Cells"))
    alive = cells.filter(~F.coalesce("is_dead", F.lit(False)))
    sums = alive.select(*keys, F.posexplode(vector).alias("pos", "v")).groupBy(*keys, "pos").agg(F.sum(F.col("v").cast("double")).alias("v"))
    total = sums.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("total"))
    living = alive.groupBy(*keys).agg(F.count(vector).alias("n_alive"))
    return counts.join(living, keys, "left").join(total, keys, "left").withColumn("n_alive", F.coalesce("n_alive", F.lit(0)))


def well_means(sites: DataFrame, keys: list[str], order: str, firsts: tuple[str, ...] = ("Metadata_Timepoint", "Metadata_Plate"), n: str = "n_alive") -> DataFrame:
    """keys, Cell_Count, the first known value (by order) of each of firsts, and mean_features: sums over counts, zeros for no cell."""
    rows = sites.dropna(subset=keys)
    first = [F.expr(f"min_by(`{c}`, `{order}`) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in firsts if c not in keys]
    counts = rows.groupBy(*keys).agg(F.sum(n).alias("Cell_Count"), *first)
    sums = rows.select(*keys, F.posexplode("total").alias("pos", "v")).groupBy(*keys, "pos").agg(F.sum("v").alias("v"))
    total = sums.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("total"))
    return counts.join(total, keys, "left").withColumn("mean_features", scaled_vector(F.col("total"), F.col("Cell_Count"))).drop("total")


def single_cells(sites: DataFrame, cells: str = "cells") -> DataFrame:
    """A row for each element of an array of vectors, with the site's columns, Cell_Index from 0 and the vector; sites without cells go."""
    rest = [c for c in sites.columns if c != cells]
    return sites.filter(F.size(cells) > 0).select(*rest, F.posexplode(cells).alias("Cell_Index", "single_cell_features"))


def cell_id(well: Column, site: Column, index: Column) -> Column:
    """{well}_{site}_cell{index}."""
    return F.format_string("%s_%s_cell%s", well.cast("string"), site.cast("string"), index.cast("string"))
