"""Tables as sources: the baseline with its fallback, JDBC, inline values, and the catalogue of a table's columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.schemas import BASELINE

#: The seed rows of the baseline (vendor, average, deviation, 99th percentile, invoices a day).
SEED_BASELINE = [("V-1001", "1200.00", "180.00", "1800.00", 12), ("V-1002", "4500.00", "600.00", "7000.00", 8), ("V-1003", "850.00", "120.00", "1400.00", 22), ("V-1004", "15000.00", "2200.00", "22000.00", 3), ("V-1005", "250.00", "45.00", "400.00", 35)]


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    """The baseline table; if it can't be read, an empty one, so that every vendor takes the fallback path."""
    try:
        return spark.read.parquet(path).select(*BASELINE.fieldNames())
    except AnalysisException:
        return spark.createDataFrame([], BASELINE)


def jdbc_baseline(spark: SparkSession, url: str, table: str = "vendor_90day_baseline", **options: str) -> DataFrame:
    """The baseline by JDBC; its driver must be on the class path. With partitionColumn, lowerBound, upperBound and numPartitions it is read by several tasks."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*(F.col(f.name).cast(f.dataType) for f in BASELINE if f.name != "refreshed_at"))


def seed_baseline(spark: SparkSession) -> DataFrame:
    """The seed rows by way of an array of structs."""
    rows = ", ".join(f"named_struct('vendor_id', '{v}', 'avg_invoice_amount', {a}BD, 'stddev_invoice_amount', {s}BD, 'p99_invoice_amount', {p}BD, 'avg_daily_invoice_cnt', {n}L)" for v, a, s, p, n in SEED_BASELINE)
    held = spark.sql(f"SELECT inline(array({rows}))")
    return held.select(*(F.col(f.name).cast(f.dataType) for f in BASELINE if f.name != "refreshed_at"), F.current_timestamp().alias("refreshed_at"))


def in_memory(spark: SparkSession, rows: list, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, ordinal_position, data_type) of the tables."""
    rows = [(name, f.name, i + 1, f.dataType.simpleString()) for name, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int, data_type string")
