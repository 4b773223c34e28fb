"""The layers as Parquet tables, partitioned by date: append, overwrite of days, upsert, insert of missing keys, truncate."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.schemas import LAYERS, conform

#: The partition column that is added to every dated layer, and the days that are looked up one by one; of more, all between the first and the last are read.
DAY, LISTED_DAYS = "day", 1000


class Store:
    """Tables of the layers under one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def read(self, layer: str, since=None, until=None, days: list[dt.date] | None = None) -> DataFrame:
        """The layer, of days from since to until or of the days given (partitions outside are not read). A layer whose contract requires it must be given a date."""
        if LAYERS[layer].filter_required and since is None and until is None and days is None:
            raise ValueError(f"{layer} is read by date: give since, until or days")
        return self._all(layer, since, until, days)

    def stream(self, layer: str) -> DataFrame:
        """The layer's rows as a stream, in the order of its files; for layers that are only appended to."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)
        return self.spark.readStream.schema(self._schema(layer)).parquet(self.path(layer)).select(*LAYERS[layer].schema.fieldNames())

    def _schema(self, layer: str) -> T.StructType:
        """The columns of a layer's files, and its day."""
        held = LAYERS[layer]
        return T.StructType([*held.schema, *([T.StructField(DAY, T.DateType())] if held.date_of else [])])

    def _exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _dated(self, df: DataFrame, layer: str) -> DataFrame:
        """Conforming rows with their day, dealt by day and sorted by the layer's order, so that files can be skipped by their ranges."""
        held = LAYERS[layer]
        rows = conform(df, layer)
        if held.date_of is None:
            return rows
        rows = rows.withColumn(DAY, F.to_date(held.date_of))
        return rows.hint("rebalance", DAY).sortWithinPartitions(DAY, *held.cluster)

    def append(self, df: DataFrame, layer: str) -> None:
        writer = self._dated(df, layer).write.mode("append")
        (writer.partitionBy(DAY) if LAYERS[layer].date_of else writer).parquet(self.path(layer))

    def insert_missing(self, df: DataFrame, layer: str, lookback: int | None = 0) -> None:
        """Appends rows whose key the layer doesn't have (null equals null); of new rows with one key any one. Of a dated layer only the days from ``lookback`` before the first
        new row's to the last's are read; None: all days, for keys that may come again at any later date."""
        held, key = LAYERS[layer], list(LAYERS[layer].key)
        new, since, until = conform(df, layer), None, None
        if held.date_of and lookback is not None:
            since, until = new.agg(F.min(F.to_date(held.date_of)), F.max(F.to_date(held.date_of))).first()
            if since is None:
                return
            since -= dt.timedelta(lookback)
        there = self._all(layer, since, until).select(*(F.col(k).alias(f"__{k}") for k in key))
        same = functools.reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key))
        self.append(new.dropDuplicates(key).join(there, same, "left_anti"), layer)

    def overwrite_days(self, df: DataFrame, layer: str) -> None:
        """Replaces the days that df has rows of; run again, it gives the same table."""
        writer = self._dated(df, layer).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(DAY) if LAYERS[layer].date_of else writer).parquet(self.path(layer))

    def upsert(self, df: DataFrame, layer: str, columns: Iterable[str] | None = None, insert: bool = True) -> None:
        """Rows of the same key take df's values (of ``columns``, if given; columns that df lacks stay), other rows stay; new keys are inserted unless insert is False.

        Days that df has rows of are rewritten, no others, and no others are read; they are read before they are replaced, through a written copy."""
        held, key = LAYERS[layer], list(LAYERS[layer].key)
        new = conform(df.select(*df.columns), layer) if columns is None else df
        names = [c for c in (columns or [c for c in held.schema.fieldNames() if c in df.columns]) if c not in key]
        days = self.days(new, layer)
        if days == []:
            return
        new = new.dropDuplicates(key).select(*key, *(F.col(c).alias(f"__{c}") for c in names), F.lit(True).alias("__new"))
        both = self._all(layer, days=days).join(new, key, "full_outer" if insert and columns is None else "left")
        rows = both.select(*key, *(F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in held.schema.fieldNames() if c not in key))
        copy = f"{self.root}/_pending_{layer}_{uuid.uuid4().hex[:12]}"
        conform(rows, layer).write.parquet(copy)
        self.overwrite_days(self.spark.read.schema(held.schema).parquet(copy), layer)
        self._delete(copy)

    def days(self, df: DataFrame, layer: str) -> list[dt.date] | None:
        """The days that df has rows of, in order; None for a layer without dates."""
        if LAYERS[layer].date_of is None:
            return None
        return sorted(r[0] for r in df.select(F.to_date(LAYERS[layer].date_of)).distinct().collect() if r[0] is not None)  # a row for each day of the calendar at most

    def _all(self, layer: str, since: dt.date | None = None, until: dt.date | None = None, days: list[dt.date] | None = None) -> DataFrame:
        """The layer, of days from since to until or of the days given: other partitions are not read. A layer that was not written is empty; one that can't be read raises."""
        if not self._exists(self.path(layer)):
            return self.spark.createDataFrame([], LAYERS[layer].schema)
        df = self.spark.read.schema(self._schema(layer)).parquet(self.path(layer))
        if days is not None and len(days) > LISTED_DAYS:
            since, until = days[0], days[-1]
        elif days is not None:
            df = df.where(F.col(DAY).isin(days))
        if since is not None:
            df = df.where(F.col(DAY) >= F.lit(since))
        if until is not None:
            df = df.where(F.col(DAY) <= F.lit(until))
        return df.select(*LAYERS[layer].schema.fieldNames())

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """df written beside the layers and read again, for what several layers are made of; staged_drop() deletes it."""
        path = f"{self.root}/_staged_{name}_{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def staged_drop(self, *tables: DataFrame) -> None:
        for t in tables:
            for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
                self._delete(folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def truncate(self, *layers: str) -> None:
        """Empties the layers, all of them if none is named."""
        for layer in layers or LAYERS:
            self._delete(self.path(layer))

    def counts(self) -> DataFrame:
        """(layer, row_count) of all layers."""
        parts = [self._all(name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count") for name in LAYERS]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def write_jdbc(self, df: DataFrame, url: str, table: str, key: list[str] | None = None, batch: int = 500, **options: str) -> None:
        """Writes by JDBC in batches; the table is made if there is none.

        With a key (columns that are not null), rows go to a staging table first, which is written anew, and one statement then inserts those whose key the table lacks: tasks and jobs that run again change
        nothing. Without, rows are appended, and those of a task that runs again may be there twice."""
        there = {"url": url, "batchsize": str(batch), **options}
        df.limit(0).write.format("jdbc").options(dbtable=table, **there).mode("ignore").save()
        if key is None:
            df.write.format("jdbc").options(dbtable=table, **there).mode("append").save()
            return
        staging = f"{table}_staging"
        df.dropDuplicates(key).write.format("jdbc").options(dbtable=staging, **there).mode("overwrite").save()
        names, same = ", ".join(f'"{c}"' for c in df.columns), " AND ".join(f't."{k}" = s."{k}"' for k in key)
        said = self.spark._jvm.java.util.Properties()
        for k in ("user", "password"):
            if k in options:
                said.setProperty(k, options[k])
        held = self.spark._jvm.java.sql.DriverManager.getConnection(url, said)
        try:
            held.createStatement().executeUpdate(f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})")
        finally:
            held.close()


def refreshed(store: Store, rows: DataFrame, source: str, date_of: str, made: Callable[[DataFrame], DataFrame], layer: str) -> None:
    """Makes the vendor-days that rows touch anew from their source layer, of which only these days are read: one row a vendor-day, however often it is touched."""
    touched = rows.select("vendor_id", F.to_date(date_of).alias("feature_date")).distinct()
    days = store.days(rows, source)
    if days:
        found = made(store.read(source, days=days)).join(touched, ["vendor_id", "feature_date"], "left_semi")
        store.upsert(found.withColumn("computed_at", F.current_timestamp()), layer)
