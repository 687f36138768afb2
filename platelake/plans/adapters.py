"""Profiling roles for the driver tables: objects, events and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Features of objects, the control compound, and the times that occur.
FEATURES = ["quantity", "extendedprice", "discount", "tax"]
CONTROL = "BUILDING"
TIMES = [str(y) for y in range(1995, 2002)]
META = ["Metadata_Plate", "Metadata_Well", "Metadata_Site", "Metadata_Timepoint", "Metadata_Compound", "Metadata_ConcLevel"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as images with the facts of their customer."""
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("ImageNumber"),
        (F.col("c_nationkey") % 4).cast("bigint").alias("Metadata_Plate"),
        (F.col("c_custkey") % 96).alias("Metadata_Well"),
        (F.col("o_orderkey") % 9).alias("Metadata_Site"),
        F.year("o_orderdate").cast("string").alias("Metadata_Timepoint"),
        F.col("c_mktsegment").alias("Metadata_Compound"),
        (F.col("c_custkey") % 96).alias("Metadata_ConcLevel"),
        (F.col("o_orderstatus") == "P").cast("int").alias("ImageQC_flag"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as objects of images."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ImageNumber"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("kind"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extendedprice"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with the metadata of their image."""
    return measurements(spark, sf_dir).join(images(spark, sf_dir), "ImageNumber")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of one feature, value, on plates of users."""
    return load(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).alias("Metadata_Plate"), F.col("event_type").alias("Metadata_Compound"), "value")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as cells of 16 sites, of wells by label; every seventh is dead."""
    e = load(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") % 16).alias("site"), F.col("label").cast("bigint").alias("Metadata_Well"), "vec_id", "embedding", (F.col("vec_id") % 7 == 0).alias("is_dead"))


#: The same in SQL, as common table expressions.
SQL_IMAGES = """images AS (
    SELECT o_orderkey AS ImageNumber, CAST(c_nationkey % 4 AS BIGINT) AS Metadata_Plate, c_custkey % 96 AS Metadata_Well, o_orderkey % 9 AS Metadata_Site,
           CAST(year(o_orderdate) AS VARCHAR) AS Metadata_Timepoint, c_mktsegment AS Metadata_Compound, c_custkey % 96 AS Metadata_ConcLevel,
           CAST(o_orderstatus = 'P' AS INTEGER) AS ImageQC_flag
    FROM orders JOIN customer ON o_custkey = c_custkey)"""
SQL_OBJECTS = (
    SQL_IMAGES
    + """, obj AS (
    SELECT l_linenumber AS line, l_returnflag AS kind, l_quantity AS quantity, l_extendedprice AS extendedprice, l_discount AS discount, l_tax AS tax, images.*
    FROM lineitem JOIN images ON l_orderkey = ImageNumber)"""
)
SQL_EVENTS = "ev AS (SELECT event_id, user_id % 4 AS Metadata_Plate, event_type AS Metadata_Compound, value FROM events)"
SQL_CELLS = "cells AS (SELECT vec_id % 16 AS site, CAST(label AS BIGINT) AS Metadata_Well, vec_id, embedding, vec_id % 7 = 0 AS is_dead FROM embeddings)"
