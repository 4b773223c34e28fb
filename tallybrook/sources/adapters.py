"""The driver's tables as invoices and receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def invoices_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with fine timestamps: a vendor for each user."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("invoice_id"), F.col("event_type").alias("po_no"), F.col("user_id").cast("string").alias("vendor_id"),
        F.col("value").cast("decimal(15,2)").alias("invoice_amount"), F.col("ts").alias("invoice_timestamp"), F.col("props").alias("payload"),
    )


def invoices_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with real duplicate ids and a long history: a vendor for each supplier."""
    return read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("invoice_id"), F.col("l_orderkey").cast("string").alias("po_no"), F.col("l_suppkey").cast("string").alias("vendor_id"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("invoice_amount"), F.col("l_shipdate").alias("invoice_timestamp"), F.col("l_partkey").alias("upc_no"), F.col("l_quantity").alias("quantity"),
    )


def receipts_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("po_no"), F.col("o_custkey").cast("string").alias("vendor_id"), F.col("o_orderdate").alias("received_timestamp"))
