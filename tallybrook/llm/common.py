"""Helpers shared by the corpus operators: the shared folder, materialised tables, row ids and size-checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.session import shared_dir

#: White space of all operators here: space and the controls from tab to carriage return.
WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that may be broadcast at most, about 16 bytes each; larger sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Mark, in its metadata, of a column of written row numbers.
ROW = "tallybrook.row"


def materialise(spark: SparkSession, df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts lineage and survives lost executors."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table of materialise() that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)


def row_id() -> Column:
    """A row's number, for one scan only: another scan may split files otherwise (as cores come and go) and number rows anew."""
    return F.monotonically_increasing_id()


def numbered(spark: SparkSession, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """df, or the named columns of it, with its rows' numbers, written once, so that all scans of the copy see the same numbers; df itself if it has them.
    The numbers are in a column with a name that df does not use; metadata mark it."""
    if is_numbered(df):
        return df
    kept = df.select(*dict.fromkeys(columns)) if columns else df
    return materialise(spark, kept.withColumn(fresh_name(df, "row"), row_id().alias("row", metadata={ROW: True})), "numbered")


def is_numbered(df: DataFrame) -> bool:
    return any(ROW in f.metadata for f in df.schema)


def fresh_name(df: DataFrame, like: str) -> str:
    """A column name that df does not have, whatever the case of its names."""
    used, name = {c.lower() for c in df.columns}, f"__{like}"
    while name in used:
        name += "_"
    return name


def row_name(df: DataFrame) -> str:
    """The name of the column with the numbers of numbered()."""
    return next(f.name for f in df.schema if ROW in f.metadata)


def row_column(df: DataFrame) -> Column:
    """The numbers of numbered()."""
    return df[row_name(df)]


def short_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """From now on Arrow batches of this session hold at most so many rows and bytes: whole texts make long rows, and both sides hold a batch in memory. Results are
    made when they are asked for, so the settings stay; they change no result."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def tidy() -> None:
    """Give memory that a worker no longer uses back to the machine; workers live on from task to task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df to be broadcast if its counted rows are within the limit; else as it is, to be shuffled."""
    return F.broadcast(df) if rows <= limit else df


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WS}+", " ")


def n_words(text: Column) -> Column:
    """Number of runs of other than white space; null: 0. Counts marks left in place of the words, so no word is copied."""
    marks = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{WS}+", ""), f"{NOT_WS}+{WS}*", "x")
    return F.length(marks).cast("long")


def ranked(spark: SparkSession, df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """df with ``place``, a row's number from 0 within its group in ascending order (nulls first), and ``members``, the rows of the group. Groups hold rows whose columns
    ``group`` are equal, null with null; ``order`` must not leave ties between rows that differ. df has no
    columns named place or members.

    Rows are dealt by ranges of (group, order) and written in order, so a group of any size is spread over tasks. What a part has of a group is counted; running sums of these counts, at most as many
    as parts and groups together, give each part's first place."""
    part, at, n, first = fresh_name(df, "part"), fresh_name(df, "at"), fresh_name(df, "n"), fresh_name(df, "first")
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialise(spark, dealt.withColumns({part: F.spark_partition_id(), at: row_id()}), name)
    each = rows.groupBy(*group, part).agg(F.min(at).alias(first), F.count("*").alias(n))
    within = Window.partitionBy(*group or [F.lit(0)])
    before = F.sum(n).over(within.orderBy(part)) - F.col(n)
    starts = each.select(*(F.col(c).alias(f"{part}_{c}") for c in group), F.col(part).alias(f"{part}_"), (before - F.col(first)).alias(first), F.sum(n).over(within).alias("members"))
    starts = materialise(spark, starts, f"{name}-starts")
    same = functools.reduce(Column.__and__, [F.col(part) == F.col(f"{part}_"), *(F.col(c).eqNullSafe(F.col(f"{part}_{c}")) for c in group)])
    return rows.join(small(starts, starts.count()), same).withColumn("place", F.col(at) + F.col(first)).select(*df.columns, "place", "members")
