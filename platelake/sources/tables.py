"""Reading and writing tables: sniffed CSV, listings, appends and Parquet."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platelake.functions.naming import nulls_for_nan, nulls_for_tokens


def sniff_separator(spark: SparkSession, path: str, candidates: str = ";,", head: int = 1024) -> str:
    """The separator of a CSV file by its first characters; read through Spark, so that any store will do."""
    line = spark.read.text(path).limit(20).collect()
    return separator_of("\n".join(r[0] for r in line)[:head], candidates)


def separator_of(sample: str, candidates: str = ";,") -> str:
    """The separator of the first lines of a CSV file."""
    try:
        return csv.Sniffer().sniff(sample, delimiters=candidates).delimiter
    except csv.Error:
        first = sample.split("\n", 1)[0]
        return max(candidates, key=first.count) if any(c in first for c in candidates) else ","


def read_csv(spark: SparkSession, path: str | list[str], sep: str | None = None, schema=None) -> DataFrame:
    """A CSV table with header; tokens that mean "no value" and NaN become NULL before types are inferred.

    Without a schema the file is read as text first and each column's type is decided over the cleaned cells."""
    first = path if isinstance(path, str) else path[0]
    reader = spark.read.option("header", True).option("sep", sep or sniff_separator(spark, first))
    if schema is not None:
        return nulls_for_nan(reader.schema(schema).csv(path))
    return nulls_for_nan(typed(nulls_for_tokens(reader.csv(path))))


def read_csvs(spark: SparkSession, paths: list[str], labels: dict[str, Column]) -> list[tuple[DataFrame, DataFrame]]:
    """CSV files of one kind, whatever their columns and separators: those with the same header are read as one table.

    labels are further columns, made of _file, the path of a row's file; they take the place of columns of the same name. With each
    table comes one of labels and whole: whether its columns, by their places, hold whole numbers without a blank in the files of
    these labels, as what one file has decides nothing about another. Else a column has one type over all files of its header. The first lines reach the
    driver, one a file."""
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = spark.read.text(paths).select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    by_header: dict[str, list[str]] = {}
    for row in lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header")).orderBy("file").collect():
        by_header.setdefault(row["header"], []).append(row["file"])
    found = []
    for header, files in by_header.items():
        raw = spark.read.option("header", True).option("sep", separator_of(header)).csv(files)
        cells = [c for c in raw.columns if c.lower() not in {k.lower() for k in labels}]
        raw = nulls_for_tokens(raw.select(*(f"`{c}`" for c in cells), file.alias("_file"))).withColumns(labels).drop("_file")
        whole = F.array(*(F.bool_and(F.col(f"`{c}`").isNotNull() & F.trim(F.col(f"`{c}`")).rlike(r"^[+-]?\d+$")) for c in cells))
        found.append((nulls_for_nan(typed(raw, tuple(labels))), raw.groupBy(*labels).agg(whole.alias("whole"))))
    return found


def typed(df: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    """String columns other than but cast to bigint, double or boolean where every value that is there parses. One aggregate over the table."""
    columns = [c for c in df.columns if c not in but]
    if not columns:
        return df
    kinds = {"bigint": r"^[+-]?\d{1,18}$", "double": r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$", "boolean": "^(True|TRUE|true|False|FALSE|false)$"}
    tests = [F.count_if(F.col(f"`{c}`").isNotNull() & ~F.trim(F.col(f"`{c}`")).rlike(shape)) for c in columns for shape in kinds.values()]
    some = [F.count(F.col(f"`{c}`")) for c in columns]
    row = df.agg(*(t.alias(f"t{i}") for i, t in enumerate(tests)), *(s.alias(f"s{i}") for i, s in enumerate(some))).first()
    out = {}
    for i, c in enumerate(columns):
        fits = [k for j, k in enumerate(kinds) if row[f"t{3 * i + j}"] == 0]
        if row[f"s{i}"] == 0:
            out[c] = F.col(f"`{c}`").cast("double")
        elif fits:
            out[c] = F.trim(F.col(f"`{c}`")).cast(fits[0])
    return df.withColumns(out)


def read_matching(spark: SparkSession, folder: str, part: str = "Normalized_features") -> list[DataFrame]:
    """The CSV files below folder, one level down, whose name contains part, one table each: their columns may differ."""
    return [read_csv(spark, p) for p in list_files(spark, f"{folder.rstrip('/')}/*", f"*{part}*")]


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> list[str]:
    """Paths of the files in folder that match a glob, sorted. Only names reach the driver."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    return sorted(r[0] for r in files.load(folder).select("path").collect())


def main_folders(paths: DataFrame, tokens: Iterable[str], path: str = "path") -> DataFrame:
    """path: each path cut after its first component that contains any token; distinct and sorted."""
    parts = F.split(path, "/")
    tokens = list(tokens)
    hit = F.transform(parts, lambda p: F.exists(F.array(*map(F.lit, tokens)), lambda t: F.contains(p, t)))
    at = F.array_position(hit, True)
    return paths.filter(at > 0).select(F.array_join(F.slice(parts, 1, at.cast("int")), "/").alias(path)).distinct().orderBy(path)


def images_below(spark: SparkSession, folder: str) -> DataFrame:
    """path, modificationTime, length and content of the images below folder, by extension in either case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.filter(F.lower("path").rlike(r"\.(png|jpg|jpeg|tif|tiff)$"))


def path_below(folder: str, path: str = "path") -> Column:
    """The part of a path below folder, which may be written with or without the scheme of its file system."""
    key = re.escape(folder.rstrip("/"))
    return F.regexp_extract(path, f"^.*?{key}/+(.*)$", 1)


def with_row_index(df: DataFrame, column: str = "row_idx") -> DataFrame:
    """File order made explicit: rows numbered from 0 across files by path, row group order within a file.

    Parquet only, which knows the place of a row; a number for each file is small, and rows never meet in one task."""
    rows = df.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")})
    files = rows.groupBy("_file").agg((F.max("_at") + 1).alias("_n"))
    before = files.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    return rows.join(before, "_file").withColumn(column, F.col("_before") + F.col("_at")).drop("_file", "_at", "_before")


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with header; arrays are written as JSON. single puts it into one file, for small results."""
    flat = df.select(*(F.to_json(F.col(f"`{c}`")).alias(c) if t.startswith(("array", "map", "struct")) else F.col(f"`{c}`") for c, t in df.dtypes))
    (flat.coalesce(1) if single else flat).write.mode("overwrite").option("header", True).csv(path)


def append(tables: list[DataFrame], strict_position: bool = False) -> DataFrame:
    """Tables below each other: by name, or by position whatever the names."""
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t) if strict_position else out.unionByName(t, allowMissingColumns=True)
    return out


def write_parquet(df: DataFrame, path: str, rows: int = 100_000, by: tuple[str, ...] = ()) -> None:
    """Parquet in row groups of at most rows rows, in a folder for each value of by."""
    writer = df.write.mode("overwrite").option("parquet.block.row.count.limit", rows)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def concat_timepoints(spark: SparkSession, folders: dict[str, str], names: tuple[str, ...] = ("Nuclei", "Cytoplasm", "Image", "Cells"), strict_position: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of each time below each other, objects with Plate, Site and Well of their image, and what was skipped.

    Names may be in lower case, files begin with a capital. A time without its Image table is skipped whole, another missing table
    alone; both are reported."""
    found: dict[str, list[DataFrame]] = {n: [] for n in names}
    skipped = []
    for time, folder in folders.items():
        try:
            image = read_csv(spark, f"{folder}/Image.csv", ",")
        except Exception as e:  # a missing or broken file is reported, not fatal
            skipped.append(f"{time}/Image: {type(e).__name__}")
            continue
        facts = image.select("ImageNumber", "Metadata_Plate", "Metadata_Site", "Metadata_Well")
        for n in names:
            try:
                t = image if n.capitalize() == "Image" else read_csv(spark, f"{folder}/{n.capitalize()}.csv", ",")
            except Exception as e:
                skipped.append(f"{time}/{n}: {type(e).__name__}")
                continue
            if n.capitalize() != "Image" and "ImageNumber" in t.columns:
                t = t.drop(*(c for c in facts.columns if c != "ImageNumber")).join(facts, "ImageNumber", "left")
            found[n].append(t.withColumn("Metadata_Timepoint", F.lit(time)))
    return {n: append(ts, strict_position) for n, ts in found.items() if ts}, skipped


def output_name(path: str, tail: str) -> str:
    """path with .parquet replaced by tail."""
    return re.sub(r"\.parquet$", "", path) + tail
