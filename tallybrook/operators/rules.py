"""The alert rules: velocity, anomaly, fallback, and their union."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.functions.columns import amount_key, rounded, safe_divide

#: The columns of an alert, before the time of detection.
ALERT = ["invoice_id", "vendor_id", "rule_name", "severity", "reason", "evidence", "window_start", "window_end", "fraud_score", "alert_source", "invoice_timestamp"]
#: Why an invoice of a vendor without a baseline can't be scored.
NO_BASELINE = "No baseline available"


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(k) for k, c in fields.items())), {"ignoreNullFields": "false"})


def _keyed(invoices: DataFrame, cfg: Config) -> DataFrame:
    """Invoices that can be in a group, with ``amount_key`` and the number of the ``bucket`` of time that holds them: windows are made of whole buckets."""
    unit = math.gcd(cfg.window, cfg.slide) * 1_000_000
    keyed = invoices.withColumn("amount_key", amount_key(F.col("invoice_amount"), cfg.amount_step)).where(F.col("amount_key").isNotNull() & F.col("vendor_id").isNotNull() & F.col("invoice_timestamp").isNotNull())
    return keyed.withColumn("bucket", _bucket(F.col("invoice_timestamp"), unit))


def _bucket(moment: Column, unit: int) -> Column:
    at = F.unix_micros(moment.cast("timestamp"))
    return ((at - F.pmod(at, F.lit(unit))) / unit).cast("long")


def _windows(bucket: Column, cfg: Config) -> Column:
    """The starts, in buckets, of the windows that hold a bucket, aligned to the epoch, [start, end)."""
    unit = math.gcd(cfg.window, cfg.slide)
    slide, length = cfg.slide // unit, cfg.window // unit
    starts = F.transform(F.sequence(F.lit(0), F.lit(-(-length // slide) - 1)), lambda i: _start(bucket, i, slide))
    return F.filter(starts, lambda s: s + length > bucket)


def _start(bucket: Column, place: Column, slide: int) -> Column:
    """The start of the window that is so many slides before the last one that holds a bucket."""
    return bucket - F.pmod(bucket, F.lit(slide)) - place * slide


def velocity_sizes(invoices: DataFrame, cfg: Config) -> DataFrame:
    """(vendor_id, amount_key, start, occurrences) of the groups of like amounts in a window that are large enough.

    Invoices are counted by bucket where they are read, before anything is shuffled or put into windows, so a vendor with very many like amounts costs no
    task more than another."""
    return _sizes(_counts(invoices, cfg), cfg)


def _counts(invoices: DataFrame, cfg: Config) -> DataFrame:
    return _keyed(invoices, cfg).groupBy("vendor_id", "amount_key", "bucket").agg(F.count("*").alias("n"))


def _sizes(counts: DataFrame, cfg: Config) -> DataFrame:
    placed = counts.select("vendor_id", "amount_key", F.explode(_windows(F.col("bucket"), cfg)).alias("start"), "n")
    return placed.groupBy("vendor_id", "amount_key", "start").agg(F.sum("n").alias("occurrences")).where(F.col("occurrences") >= cfg.min_repeats)


def velocity_groups(invoices: DataFrame, cfg: Config) -> DataFrame:
    """(window_start, window_end, vendor_id, amount, occurrences, invoice_ids, members) of the groups of like amounts in a window that are large enough. A group's members come by
    an equi-join of invoices with the buckets of the groups' windows."""
    unit = math.gcd(cfg.window, cfg.slide)
    sizes = velocity_sizes(invoices, cfg)
    buckets = sizes.withColumn("bucket", F.explode(F.sequence(F.col("start"), F.col("start") + cfg.window // unit - 1)))
    rows = _keyed(invoices, cfg).select("vendor_id", "amount_key", "bucket", F.struct("invoice_timestamp", "invoice_id").alias("member"))
    held = rows.join(buckets, ["vendor_id", "amount_key", "bucket"]).groupBy("vendor_id", "amount_key", "start").agg(F.max("occurrences").alias("occurrences"), F.array_sort(F.collect_list("member")).alias("members"))
    moment = lambda bucket: F.timestamp_micros(bucket * (unit * 1_000_000))
    return held.select(moment(F.col("start")).alias("window_start"), moment(F.col("start") + cfg.window // unit).alias("window_end"), "vendor_id", F.col("amount_key").alias("amount"), "occurrences", F.col("members.invoice_id").alias("invoice_ids"), "members")


def velocity_members(invoices: DataFrame, cfg: Config) -> DataFrame:
    """Invoices that are in a group, a row each, with ``amount_key`` and ``sizes``: how many invoices each group holds that this one is in, by the windows that hold it, the last one first; 0 where
    there is no group. It says what velocity_alerts() says without a row for each window, and without the ids of a group in each of its alerts: rows are no more than the invoices.

    Counts of buckets are dealt by (vendor, amount) once; from there on windows are made and added up without a shuffle. A vendor's amount has as many rows as buckets of time at most."""
    unit = math.gcd(cfg.window, cfg.slide)
    slide, length = cfg.slide // unit, cfg.window // unit
    key = ["vendor_id", "amount_key"]
    within = Window.partitionBy(*key).orderBy("bucket")
    # a group's first bucket has enough invoices from it on, within a window's length; buckets that no such one is near are in no group, and are left out of no group's count
    counts = _counts(invoices, cfg).repartition(*key).withColumn("ahead", F.sum("n").over(within.rangeBetween(0, length - 1)))
    counts = counts.withColumn("best", F.max("ahead").over(within.rangeBetween(1 - length, 0))).where(F.col("best") >= cfg.min_repeats).select(*key, "bucket", "n")
    sizes = _sizes(counts, cfg).select(*key, F.col("start").alias("bucket"), F.struct("start", F.col("occurrences").cast("int").alias("size")).alias("group"), F.lit(False).alias("held"))
    both = sizes.unionByName(counts.select(*key, "bucket", F.lit(None).cast(sizes.schema["group"].dataType).alias("group"), F.lit(True).alias("held")))
    near = both.withColumn("groups", F.map_from_entries(F.collect_list("group").over(within.rangeBetween(1 - length, 0)))).where(F.col("held") & (F.size("groups") > 0))
    buckets = near.select(*key, "bucket", F.transform(_windows(F.col("bucket"), cfg), lambda s: F.coalesce(F.try_element_at("groups", s), F.lit(0))).alias("sizes"))
    return _keyed(invoices, cfg).join(buckets, [*key, "bucket"]).drop("bucket")


def velocity_windows(members: DataFrame, cfg: Config, moment: str = "invoice_timestamp") -> DataFrame:
    """Rows of velocity_members() for each of their groups, with its ``window_start``, ``window_end`` and ``occurrences``; rows whose ``sizes`` are null stay as they are."""
    micros = math.gcd(cfg.window, cfg.slide) * 1_000_000
    start = _start(_bucket(F.col(moment), micros), F.col("place"), cfg.slide * 1_000_000 // micros)
    every = members.select("*", F.posexplode_outer("sizes").alias("place", "occurrences")).where(F.col("sizes").isNull() | (F.col("occurrences") > 0))
    return every.withColumns({
        "window_start": F.timestamp_micros(start * micros), "window_end": F.timestamp_micros(start * micros + cfg.window * 1_000_000), "occurrences": F.col("occurrences").cast("long"),
    }).drop("place", "sizes")


def velocity_reason(amount: Column, occurrences: Column, cfg: Config) -> Column:
    return F.concat(occurrences.cast("string"), F.lit(" invoices @ $"), amount.cast("string"), F.lit(f" in {cfg.window}s window"))


def velocity_score(occurrences: Column) -> Column:
    return F.least(F.lit(100), occurrences * 10).cast("long")


def velocity_alerts(invoices: DataFrame, cfg: Config) -> DataFrame:
    """One alert for each member of each group: an invoice has one for every window that overlaps."""
    return velocity_rows(velocity_groups(invoices, cfg), cfg)


def velocity_rows(groups: DataFrame, cfg: Config) -> DataFrame:
    """The alerts of velocity_groups()."""
    reason = velocity_reason(F.col("amount"), F.col("occurrences"), cfg)
    evidence = _json(amount=F.col("amount"), occurrences=F.col("occurrences"), invoice_ids=F.col("invoice_ids"), window_duration_seconds=F.lit(cfg.window), fraud_pattern=F.lit("rapid_duplicate_amounts"))
    made = groups.select("vendor_id", "window_start", "window_end", reason.alias("reason"), evidence.alias("evidence"), velocity_score(F.col("occurrences")).alias("fraud_score"), F.explode("members").alias("m"))
    return made.select(
        F.col("m.invoice_id").alias("invoice_id"), "vendor_id", F.lit("VELOCITY").alias("rule_name"), F.lit("HIGH").alias("severity"), "reason", "evidence", "window_start", "window_end", "fraud_score",
        F.lit("velocity_check").alias("alert_source"), F.col("m.invoice_timestamp").alias("invoice_timestamp"),
    )


def scored(invoices: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """Invoices with their vendor's baseline, ``z`` and ``fallback_reason`` (null where the invoice can be scored).

    The baseline has a row a vendor; adaptive execution broadcasts it while it is small and shuffles it beyond."""
    held = baseline.select("vendor_id", F.col("avg_invoice_amount").cast("double").alias("avg"), F.col("stddev_invoice_amount").cast("double").alias("sd"), F.lit(True).alias("known"))
    amount = F.col("invoice_amount").cast("double")
    joined = invoices.join(held, "vendor_id", "left").withColumn("z", safe_divide(amount - F.col("avg"), F.col("sd")))
    broken = F.isnan(amount) | (F.abs(amount) == float("inf"))
    reason = (
        F.when(F.col("known").isNull(), NO_BASELINE)
        .when(F.col("avg").isNull() | F.col("sd").isNull(), "Incomplete baseline")
        .when(F.col("sd") <= 0, "Degenerate stddev")
        .when(broken & ~F.isnan(amount), "Scoring error: amount is infinite")
        .when((F.col("avg") == 0) & (F.abs("z") >= cfg.z_threshold), "Scoring error: average is zero")
    )
    return joined.withColumn("fallback_reason", reason)


def anomaly_alerts(invoices: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """Invoices far from their vendor's average, to either side; an amount that is no number alerts nothing."""
    z = F.col("z")
    out = scored(invoices, baseline, cfg).where(F.col("fallback_reason").isNull() & ~F.isnan(z) & (F.abs(z) >= cfg.z_threshold))
    amount = F.col("invoice_amount").cast("double")
    # format_number rounds the binary value, ties to even, as C's printf and so the SQL does; format_string rounds half up what Java prints
    reason = F.concat(F.lit("Invoice $"), F.format_number(amount, 2), F.lit(" is "), F.call_function("format_number", F.abs(z), F.lit("0.0")), F.lit("σ from vendor avg $"), F.format_number("avg", 2))
    evidence = _json(
        amount=F.col("invoice_amount").cast("decimal(15,2)"), baseline_avg=F.col("avg").cast("decimal(15,2)"), baseline_stddev=F.col("sd").cast("decimal(15,2)"),
        z_score=rounded(z, 3), deviation_pct=rounded((amount - F.col("avg")) / F.col("avg") * 100, 2), fraud_pattern=F.lit("statistical_outlier"),
    )
    return _alert(out, "ANOMALY", F.when(F.abs(z) >= cfg.z_critical, "CRITICAL").otherwise("HIGH"), reason, evidence, F.least(F.lit(100.0), F.floor(F.abs(z) * 10)).cast("long"), "anomaly_check")


def fallback_alerts(invoices: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """Every invoice that can't be scored."""
    out = scored(invoices, baseline, cfg).where(F.col("fallback_reason").isNotNull())
    evidence = _json(amount=F.col("invoice_amount").cast("decimal(15,2)"), fallback_reason=F.col("fallback_reason"), fraud_pattern=F.lit("unknown_vendor"))
    return _alert(out, "FALLBACK", F.lit("MEDIUM"), F.concat(F.lit("Review Required - Fallback Mode: "), F.col("fallback_reason")), evidence, F.lit(cfg.fallback_score).cast("long"), "fallback_path")


def _alert(rows: DataFrame, rule: str, severity: Column, reason: Column, evidence: Column, score: Column, source: str) -> DataFrame:
    none = F.lit(None).cast("timestamp")
    return rows.select("invoice_id", "vendor_id", F.lit(rule).alias("rule_name"), severity.alias("severity"), reason.alias("reason"), evidence.alias("evidence"), none.alias("window_start"), none.alias("window_end"), score.alias("fraud_score"), F.lit(source).alias("alert_source"), "invoice_timestamp")


def gold(invoices: DataFrame, baseline: DataFrame, cfg: Config, detected_at: Column | None = None, days: list[dt.date] | None = None) -> DataFrame:
    """All alerts, with the time of detection: of the invoice unless another is given. With ``days``, alerts on their invoices alone; other invoices count in windows with them."""
    mine = (lambda df: df) if days is None else (lambda df: df.where(F.to_date("invoice_timestamp").isin(days)))
    every = mine(velocity_alerts(invoices, cfg)).unionByName(anomaly_alerts(mine(invoices), baseline, cfg)).unionByName(fallback_alerts(mine(invoices), baseline, cfg))
    return every.withColumn("detected_at", F.col("invoice_timestamp") if detected_at is None else detected_at).drop("invoice_timestamp")
