"""New image tables as a stream: the batch transforms, applied to each batch of files that arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def follow_csv(spark: SparkSession, folder: str, schema, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Apply transform to the CSV files that are new in folder and append the results as Parquet to output."""
    source = spark.readStream.schema(schema).option("header", True).csv(folder)

    def batch(df: DataFrame, number: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{output}/batch={number}")  # a batch that is run again replaces itself

    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
