"""Summaries of a day that can be added up over days: moments and quantile sketches of vendors, hours of alerts, and bitmaps for exact distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.functions.columns import money

#: Size of a quantile sketch, and the error of a rank that it makes at most, with 99 % confidence. Sketches of no more values than the size are exact.
SKETCH, RANK_ERROR = 200, 0.0165


def vendor_days(invoices: DataFrame, size: int = SKETCH) -> DataFrame:
    """(vendor_id, feature_date, n, total, squares, sketch) of the amounts of a vendor's day; sums are exact decimals, the sketch is a KLL sketch."""
    days = invoices.withColumn("feature_date", F.to_date("invoice_timestamp")).where(F.col("feature_date").isNotNull() & F.col("vendor_id").isNotNull())
    amount = F.col("invoice_amount").cast("decimal(15,2)")
    return days.groupBy("vendor_id", "feature_date").agg(
        F.count("*").alias("n"), F.sum(amount).alias("total"), F.sum((amount * amount).cast("decimal(28,4)")).alias("squares"), F.kll_sketch_agg_double(amount.cast("double"), size).alias("sketch"),
    )


def baseline(days: DataFrame, cfg: Config) -> DataFrame:
    """The baseline of features.baseline() from summaries of days, without a look at invoices. Its 99th percentile is the sketches' (a value that occurs, whose rank may be off by RANK_ERROR), not interpolated."""
    held = days.where((F.col("feature_date") > F.date_sub(F.lit(cfg.as_of), cfg.history_days)) & (F.col("feature_date") <= F.lit(cfg.as_of)))
    found = held.groupBy("vendor_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.kll_merge_agg_double("sketch").alias("sketch"), F.count("*").alias("days"))
    n = F.col("n").cast("double")
    mean = F.col("total").cast("double") / n
    # n * squares - total^2 in decimals: no digits cancel
    spread = (F.col("n").cast("decimal(10,0)") * F.col("squares").cast("decimal(27,4)") - F.col("total").cast("decimal(18,2)") * F.col("total").cast("decimal(18,2)")).cast("double")
    return found.select(
        "vendor_id", money(mean).alias("avg_invoice_amount"), money(F.sqrt(F.greatest(spread, F.lit(0.0))) / n).alias("stddev_invoice_amount"),
        money(F.kll_sketch_get_quantile_double("sketch", F.lit(0.99))).alias("p99_invoice_amount"), F.floor(F.col("n") / F.col("days")).cast("long").alias("avg_daily_invoice_cnt"), "n",
    )


def rank_holds(below: Column, at_most: Column, n: Column, share: float, error: float = RANK_ERROR) -> Column:
    """Whether a value with so many values below and so many at most its own may stand for the quantile ``share`` of n."""
    return (below / n <= share + error) & (at_most / n >= share - error)


def alert_hours(alerts: DataFrame, size: int = SKETCH) -> DataFrame:
    """(hour_bucket, rule_name, severity, alerts, score_sum, low, high, first_alert, last_alert, sketch) of each hour of alerts."""
    score = F.col("fraud_score")
    return alerts.groupBy(F.date_trunc("hour", "detected_at").cast("timestamp_ntz").alias("hour_bucket"), "rule_name", "severity").agg(
        F.count("*").alias("alerts"), F.sum(score).alias("score_sum"), F.min(score).alias("low"), F.max(score).alias("high"), F.min("detected_at").alias("first_alert"), F.max("detected_at").alias("last_alert"),
        F.count_if((score < 0) | (score > 100)).alias("invalid"), F.kll_sketch_agg_bigint(score, size).alias("sketch"),
    )


def alert_sums(alerts: DataFrame) -> DataFrame:
    """The figures of alert_hours() without its sketch: sums, counts, least and greatest of each hour of alerts."""
    score = F.col("fraud_score")
    return alerts.groupBy(F.date_trunc("hour", "detected_at").cast("timestamp_ntz").alias("hour_bucket"), "rule_name", "severity").agg(
        F.count("*").alias("alerts"), F.sum(score).alias("score_sum"), F.min("detected_at").alias("first_alert"), F.max("detected_at").alias("last_alert"),
    )


def numbered(ids: DataFrame, write) -> DataFrame:
    """(id, number): distinct ids, each with a number of its own, without gaps from 0. ``write`` writes a table and reads it again, so that all later reads see the same numbers.

    Ids are dealt by ranges; what a part holds is counted, and running sums of the counts, one a part, are added."""
    parts = write(ids.select("id").where("id is not null").distinct().repartitionByRange("id").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    each = parts.groupBy("part").agg(F.min("at").alias("from"), F.count("*").alias("n"))
    starts = each.select("part", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("n") - F.col("from")).alias("shift"))  # a row a part
    return write(parts.join(F.broadcast(starts), "part").select("id", (F.col("at") + F.col("shift")).alias("number")))


def alert_bits(alerts: DataFrame, numbers: dict[str, DataFrame]) -> DataFrame:
    """(hour_bucket, rule_name, severity, kind, bucket, bits): for each kind of id (a column of alerts, with its numbers) the ids of an hour's alerts, as bitmaps of ranges of numbers."""
    out = None
    for kind, held in numbers.items():
        rows = alerts.select(F.date_trunc("hour", "detected_at").cast("timestamp_ntz").alias("hour_bucket"), "rule_name", "severity", F.col(kind).alias("id")).join(held, "id")
        bits = rows.groupBy("hour_bucket", "rule_name", "severity", F.lit(kind).alias("kind"), F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        out = bits if out is None else out.unionByName(bits)
    return out


def distinct(bits: DataFrame, *by: str) -> DataFrame:
    """(by, kind, n): how many ids of each kind there are, exactly: bitmaps of a range are or-ed, and their counts added. No id is shuffled."""
    return bits.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).groupBy(*by, "kind").agg(F.sum("n").alias("n"))
