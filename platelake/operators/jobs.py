"""The job grid: plates times timepoints in batches, and the folder that each job reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def job_batches(plates: DataFrame, times: DataFrame, size: int = 10, small: int = 5) -> DataFrame:
    """plate, time, batch and instance of every job, in the order of plate and time: batches of size jobs, those of fewer than small on a small instance.

    The grid is the result; a job's number is that of its plate among plates and of its time among times."""
    of = lambda df, c: df.select(c).withColumn(f"{c}_at", F.row_number().over(Window.orderBy(c)) - 1)  # noqa: E731  as many rows as plates or times
    n = times.agg(F.count("*").alias("n_times"))
    grid = of(plates, "plate").join(of(times, "time"), how="cross").join(n, how="cross")
    jobs = grid.withColumn("batch", F.floor((F.col("plate_at") * F.col("n_times") + F.col("time_at")) / size))
    held = F.count("*").over(Window.partitionBy("batch"))
    return jobs.select("plate", "time", "batch", F.when(held < small, "small").otherwise("large").alias("instance"))


def first_folders(jobs: DataFrame, folders: DataFrame) -> DataFrame:
    """plate, time and the first folder, by name, whose path holds "{time}h_{plate}"; jobs without one are left out.

    Each job is looked for in each folder's name: both lists are as short as a screen has plates and times."""
    wanted = F.concat(F.col("time").cast("string"), F.lit("h_"), F.col("plate").cast("string"))
    return jobs.join(folders, F.contains(F.col("folder"), wanted)).groupBy("plate", "time").agg(F.min("folder").alias("folder"))
