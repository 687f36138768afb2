"""What the operators share: staged tables, settings and Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes A-Z to a-z; bytes of longer UTF-8 characters stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: White space that separates words in most contracts.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: spark.checkpoint.dir, or for local sessions without it a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="platelake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: lineage ends there and lost executors take nothing with them."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return _held(df.sparkSession.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """staged, as a table bucketed by key: joins on it deal out the other side only."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    table_ = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(table_)
    return _held(spark.table(table_), path)


def _held(df: DataFrame, path: str) -> DataFrame:
    df._staged_path = path
    return df


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df._staged_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, nulls as empty, and the n + 1 offsets of its rows."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    n = len(array)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def row_bytes(array: pa.Array, lower: bool = False) -> Iterator[bytes]:
    """Each row of a string column as bytes, nulls as empty, optionally with A-Z lower-cased."""
    raw, at = byte_column(array)
    whole = raw.tobytes()
    if lower:
        whole = whole.translate(LOWER)
    ends = at.tolist()
    for a, b in zip(ends, ends[1:]):
        yield whole[a:b]


def lowered(array: pa.Array) -> pa.Array:
    """A string column with A-Z lower-cased, nulls as empty."""
    raw, at = byte_column(array)
    return pa.Array.from_buffers(pa.large_string(), len(array), [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes().translate(LOWER))]).cast(pa.string())
