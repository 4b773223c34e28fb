"""Dedup of invoices in batch: the first row of an id stays until its time to live is over."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ranked_duplicates(invoices: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """Rows with ``occurrence`` from 1 in a total order within their key; 1 is the one that stays."""
    keys = [key] if isinstance(key, str) else key
    return invoices.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def unique(invoices: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    return ranked_duplicates(invoices, key, order).where("occurrence = 1").drop("occurrence")


def duplicates(invoices: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    return ranked_duplicates(invoices, key, order).where("occurrence > 1")


def with_ttl(invoices: DataFrame, ttl: int, key: str = "invoice_id", ts: str = "invoice_timestamp", ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows with ``is_duplicate``. A row is a duplicate if an accepted row of its id is less than ttl seconds older; duplicates don't extend the time to live. Rows without an
    id or a time are accepted.

    Acceptance depends on earlier acceptances, which no window function can say: each task walks its ids' rows in order of time and holds the last accepted time alone."""
    columns, at, again = invoices.columns, "__at", "is_duplicate"
    ordered = invoices.withColumn(at, F.unix_micros(F.col(ts).cast("timestamp"))).repartition(key).sortWithinPartitions(key, at, *ties)
    schema = T.StructType([*invoices.schema.fields, T.StructField(again, T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, since = None, None
        for batch in batches:
            flags = []
            for k, t in zip(batch.column(key).to_pylist(), batch.column(at).to_pylist(), strict=True):
                if k != held:
                    held, since = k, None
                flags.append(k is not None and t is not None and since is not None and t < since + ttl * 1_000_000)
                if not flags[-1]:
                    since = t
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(flags, pa.bool_())], [*columns, again])

    return ordered.mapInArrow(walk, schema)
