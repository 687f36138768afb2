"""The runs a user starts, from files to files; every command-line option of a run is a keyword here."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions import scalars
from platelake.functions.naming import drop_stale_qc, drop_text_features, features_not_starting, features_without, prefixed
from platelake.operators import cells, images, induction, qc, selection, similarity, wells
from platelake.operators.normalize import mad_robustize
from platelake.operators.profiles import Profiles
from platelake.sources import tables
from platelake.sources.images import load_arrays, map_images, write_files

KEYS = ["Metadata_Plate", "Metadata_Timepoint"]


def normalize_plates(spark: SparkSession, base: str, platemaps: dict[str, str], times: list[str], output: str | None = None, control: str = "DMSO", how: str = "mean", qc_drop: bool = True, prefix_strip: bool = True, time_folders: bool = True) -> DataFrame:
    """Object tables below base/plate/time to well profiles, robustly normalised against the control of their plate and time.

    All plates and times are one plan: files of the same columns are read as one table, and what belongs to a plate and time is
    grouped by both. Without time_folders the tables lie in base/plate and stand for each of times. A control name that no well has is
    an error."""
    stripped = (lambda p: p.removeprefix("binned/")) if prefix_strip else (lambda p: p.lstrip("binned/"))
    parts = F.split(tables.path_below(base, "_file"), "/")
    depth = 2 if time_folders else 1
    plate = F.array_join(F.slice(parts, 1, F.size(parts) - depth), "/")
    plate = F.regexp_replace(plate, "^binned/", "") if prefix_strip else scalars.strip_leading(plate, "binned/")
    time = F.element_at(parts, -2) if time_folders else F.lit("")
    loaded = {}
    for t in ("Image", "Nuclei", "Cells", "Cytoplasm"):
        paths = [f"{base.rstrip('/')}/{p}/{h}{t}.csv" for p in platemaps for h in ([f"{x}/" for x in times] if time_folders else [""])]
        loaded[t] = tables.read_csvs(spark, paths, {"Metadata_Plate": plate, "Metadata_Timepoint": time})
    ends = {"/" + re.sub("^[A-Za-z0-9]+:", "", path).lstrip("/"): stripped(p) for p, path in platemaps.items()}
    of_file = F.coalesce(*(F.when(F.endswith(F.col("_file"), F.lit(e)), F.lit(ends[e])) for e in sorted(ends, key=len, reverse=True)))
    layouts = tables.read_csvs(spark, list(platemaps.values()), {"Metadata_Plate": of_file})
    united = wells.plate_profiles(loaded, selection.unite([wells.platemap_of(t) for t, _ in layouts]), how=how, qc_drop=qc_drop)
    if not time_folders:
        united = united.withColumn("Metadata_Timepoint", F.explode(F.array(*map(F.lit, times))))
    profiles = Profiles.of(united, features_without(united))
    done = mad_robustize(profiles, KEYS, F.col("Metadata_Compound") == control, require=True).wide()
    if output:
        tables.write_parquet(done, output, by=tuple(KEYS))
    return done


def profile_objects(tables_: dict[str, DataFrame], control: str = "DMSO", clean_names: bool = True, scope: tuple[str, ...] = tuple(KEYS)) -> DataFrame:
    """The older all-in-one form: means by plate, well, time and compound of four tables, merged, normalised within scope, double sigmoid, magnitude."""
    keys = ["Metadata_Plate", "Metadata_Well", "Metadata_Timepoint", "Metadata_Compound"]
    means = []
    for name in ("Cells", "Nuclei", "Image", "Cytoplasm"):
        if name in tables_:
            t = wells.aggregate_by(tables_[name].drop("ImageNumber"), keys)
            means.append(prefixed(t, wells.PREFIXES[name]) if clean_names or name == "Image" else t)
    merged = wells.outer_merge(means, keys)
    p = mad_robustize(Profiles.of(merged, features_without(merged)), list(scope), F.col("Metadata_Compound") == control)
    return p.mapped(lambda x: F.abs(scalars.double_sigmoid(x))).wide()


def profile_times(spark: SparkSession, folder: str, times: list[str], output: str | None = None, control: str = "DMSO", operations: tuple[str, ...] = ("variance_threshold", "drop_na_columns", "correlation_threshold", "drop_outliers"), clean_names: bool = True, **options: dict) -> dict[str, dict[str, DataFrame]]:
    """The older run whole, for each time of one plate: selected (profiles after normalisation, the magnitude of the double sigmoid
    and selection), averages and cosines (mean and list of the replicate cosines of compound, time and level).

    The tables of folder/time are read together; each time has features of its own, and a file of each result below output."""
    label = {"Metadata_Timepoint": F.element_at(F.split(F.col("_file"), "/"), -2)}
    loaded = {t: selection.unite([f for f, _ in tables.read_csvs(spark, [f"{folder.rstrip('/')}/{x}/{t}.csv" for x in times], label)]) for t in ("Cells", "Nuclei", "Image", "Cytoplasm")}
    facts = ("Metadata_Plate", "Metadata_Site", "Metadata_Well", "Metadata_Compound", "Metadata_ConcLevel")
    loaded = qc.tables_with_metadata(loaded, facts, within=("Metadata_Timepoint",))
    objects = {n: drop_text_features(t) if n == "Image" else t.drop("Metadata_Site", "Metadata_ConcLevel") for n, t in loaded.items()}
    magnitudes = profile_objects(objects, control, clean_names, ("Metadata_Timepoint",)).withColumn("Metadata_Plate", F.lit(folder.rstrip("/").rsplit("/", 1)[-1]))
    groups = ["Metadata_Compound", "Metadata_Timepoint", "Metadata_ConcLevel"]
    results = {}
    for time in times:
        now = magnitudes.filter(F.col("Metadata_Timepoint") == time)
        kept = selection.feature_select(Profiles.of(now, features_without(now)), list(operations), options)
        made = {
            "selected": kept.wide(),
            "averages": similarity.average_cosine(kept.df, groups).drop("n"),
            "cosines": similarity.replicate_cosines(kept.df, groups, order="Metadata_Well"),
        }
        for name, df in made.items() if output else ():
            tables.write_csv(df, f"{output.rstrip('/')}/{time}/{name}", single=True)
        results[time] = made
    return results


def select_features(normalized: DataFrame, per_time: bool = False, operations: tuple[str, ...] = ("variance_threshold", "drop_na_columns", "correlation_threshold", "drop_outliers"), na_cutoff: float = 0.5, correlation: float = 0.9, **options: dict) -> tuple[DataFrame, DataFrame]:
    """Selected profiles after the double sigmoid and its magnitude, and the average replicate cosine of compound, time and level."""
    settings = {"drop_na_columns": {"cutoff": na_cutoff}, "correlation_threshold": {"threshold": correlation}, **options}
    p = Profiles.of(normalized, features_without(normalized))
    if per_time:
        wide = selection.select_per(p, "Metadata_Timepoint", list(operations), settings)
        kept = Profiles.of(wide, features_without(wide))
    else:
        kept = selection.feature_select(p, list(operations), settings)
    signed = kept.mapped(scalars.double_sigmoid)
    cosines = similarity.average_cosine(signed.df, ["Metadata_Compound", "Metadata_Timepoint", "Metadata_ConcLevel"]).drop("n")
    return signed.mapped(F.abs).wide(), cosines


def call_hits(selected: DataFrame, threshold: float = 0.95, quantile: float = 0.95, control: str = "DMSO") -> dict[str, DataFrame]:
    """Everything that follows from induction: scores, thresholds, bioactivities, flags, summaries, set counts, pivot and histogram."""
    is_control = F.col("Metadata_Compound") == control
    scored = selected.withColumn("induction", induction.induction(features_not_starting(selected), threshold))
    limits = induction.control_threshold(scored, is_control, quantile)
    means = induction.mean_induction(scored, is_control)
    flags = induction.flag_hits(means, limits)
    upper = flags.withColumn("Metadata_Compound", F.upper("Metadata_Compound"))
    return {
        "induction": scored.select(*KEYS, "Metadata_Well", "Metadata_Compound", "Metadata_ConcLevel", "induction"),
        "thresholds": limits,
        "bioactivities": means,
        "flags": flags,
        "summary": induction.hits_by(flags, "Metadata_Timepoint", "Metadata_Compound"),
        "venn": induction.venn(flags),
        "venn_per_time": induction.venn_per_time(flags),
        "pivot": induction.hit_pivot(upper, induction.ordered_times(flags)),
        "histogram": induction.histogram(scored.filter(is_control), KEYS),
        "density": induction.density(scored.filter(is_control), KEYS),
    }


def image_qc(spark: SparkSession, sites: DataFrame, folder: str, illumination: str | None = None, key: str = "site_id", small: int = 64 << 20) -> DataFrame:
    """sites with the quality of the image of each channel; its file is named by its path below folder.

    Columns of an earlier run go first. A file that is not there is an error of its channel. Names of up to small bytes are sent to
    where the images are read, so that no image is moved; beyond that, images are dealt out by their paths."""
    sites = drop_stale_qc(sites)
    channels = [c[len("FileName_") :] for c in sites.columns if c.startswith("FileName_")]
    arrays = load_arrays(spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(illumination)) if illumination else None
    names = images.unpivot_channels(sites, key).withColumn("file", F.regexp_replace("file", "^(\\./)+", ""))
    size = names.agg(F.sum(F.length("file") + F.length("channel") + 64)).first()[0] or 0
    files = tables.images_below(spark, folder).select(tables.path_below(folder).alias("file"), "content")
    met = files.join(F.broadcast(names) if size <= small else names, "file")
    found = images.image_quality(met, key, arrays)
    missing = names.join(found.select(key, "channel"), [key, "channel"], "left_anti").select(key, "channel", F.lit(None).cast("double").alias("slope"), F.lit(None).cast("double").alias("percent"), F.lit("File Not Found").alias("error"))
    return images.quality_columns(sites, found.unionByName(missing), key, channels)


def rebin_images(spark: SparkSession, folder: str, resolution: int = 1080) -> DataFrame:
    """path (Image becoming Image_binned), content and error of every image below folder, grey or colour, resampled."""
    return map_images(tables.images_below(spark, folder), lambda x: images.resize(x, resolution), lambda p: p.replace("Image", "Image_binned"))


def project_planes(planes: DataFrame, pixels: DataFrame, channels: int, n_planes: int, order: str = "row_idx") -> DataFrame:
    """PlateID, chunk, channel, the first file's stacked path and the projection, of planes (PlateID, Image_PathName, Image_FileName) joined to pixels (path, pixels)."""
    path = scalars.path_join(F.col("Image_PathName"), F.col("Image_FileName"))
    grouped = images.plane_groups(planes.withColumn("path", path), channels, n_planes, [order])
    keys = ["PlateID", "chunk", "channel"]
    named = grouped.groupBy(*keys).agg(F.min_by("path", "plane").alias("path")).withColumn("path", scalars.stacked_path(F.col("path")))
    return named.join(images.max_projection(grouped.join(pixels, "path"), keys), keys)


def project_files(spark: SparkSession, planes: DataFrame, folder: str, channels: int, n_planes: int, output: str | None = None, order: str = "row_idx") -> DataFrame:
    """PlateID, chunk, channel, path, content and error: the projection of every stack of planes (PlateID, Image_PathName, Image_FileName).

    Files are named by their path below folder; a projection is named after its first plane, Images becoming ImagesStacked. With
    output the files are written below it as well, and path, bytes and error of each are returned."""
    named = planes.withColumn("path", scalars.path_join(F.col("Image_PathName"), F.col("Image_FileName")))
    grouped = images.plane_groups(named, channels, n_planes, [order]).select("PlateID", "chunk", "channel", "plane", "path")
    files = tables.images_below(spark, folder).select(tables.path_below(folder).alias("path"), "content")
    made = images.project_images(grouped.join(files, "path", "left"), ["PlateID", "chunk", "channel"])
    made = made.withColumn("path", scalars.stacked_path(F.col("path")))
    return write_files(made, output) if output else made


def embed_sites(sites: DataFrame, key: str, load: Callable[[dict], np.ndarray], models: Callable[[], tuple], channels: int, drop_dead: bool = False) -> dict[str, DataFrame]:
    """Site counts, cell coordinates, single cells and well embeddings of sites (key, Metadata_Well, Metadata_Site, ...) through the given models.

    The cells feed several results: persist or store them first if the models are costly."""
    found = cells.process_sites(sites, key, load, models, channels, drop_dead=drop_dead)
    facts = [c for c in sites.columns if c != key and c.startswith("Metadata_")]
    met = found.join(sites.select(key, *facts), key)
    living = met.filter("cell_index IS NOT NULL")
    sums = cells.site_sums(found, [key])
    site = F.coalesce(F.col("Metadata_Site").cast("string"), F.col(key).cast("string")) if "Metadata_Site" in facts else F.col(key).cast("string")
    rows = sums.join(sites.select(key, *facts), key)
    return {
        "sites": rows.select(key, *facts, "Cell_Count", "Dead_Cells"),
        "coordinates": living.select(cells.cell_id(F.col("Metadata_Well"), site, F.col("cell_index")).alias("Cell_ID"), F.col("y").alias("Y_Center"), F.col("x").alias("X_Center"), F.col("is_dead").alias("Is_Dead")),
        "single_cells": living.select(key, *facts, F.col("cell_index").alias("Cell_Index"), F.col("embedding").alias("single_cell_features"), F.col("is_dead").alias("is_dead_cell")),
        "wells": cells.well_means(rows, [c for c in ("Metadata_Plate", "Metadata_Well") if c in facts], key, tuple(c for c in ("Metadata_Timepoint",) if c in facts)),
        "errors": found.filter("error IS NOT NULL").select(key, "error"),
    }
