"""Vendor-day features, the baseline, the features view and the rolling sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.functions.columns import money, rounded, safe_divide, seconds_between

RISK_COUNTS = ["anomaly_alert_count", "velocity_alert_count", "duplicate_alert_count", "total_alert_count"]


def behavioral(invoices: DataFrame) -> DataFrame:
    """A row for each vendor and day of invoices; deviation of the population; invoices an hour over the span from first to last."""
    days = invoices.withColumn("feature_date", F.to_date("invoice_timestamp")).where(F.col("feature_date").isNotNull() & F.col("vendor_id").isNotNull())
    amount = F.col("invoice_amount")
    found = days.groupBy("vendor_id", "feature_date").agg(
        F.count("*").alias("invoice_count"), F.sum(amount).alias("total"), F.min(amount).alias("min_invoice_amount"), F.max(amount).alias("max_invoice_amount"),
        F.stddev_pop(amount.cast("double")).alias("sd"), F.min("invoice_timestamp").alias("first"), F.max("invoice_timestamp").alias("latest_invoice_timestamp"),
    )
    n, hours = F.col("invoice_count"), seconds_between(F.col("first"), F.col("latest_invoice_timestamp")) / 3600
    rate = F.when(n <= 1, 0.0).when(hours == 0, n.cast("double")).otherwise(safe_divide(n, hours))
    return found.select(
        "vendor_id", "feature_date", "invoice_count", F.col("total").cast("decimal(15,2)").alias("total_invoice_amount"), money(F.col("total").cast("double") / n).alias("avg_invoice_amount"),
        "min_invoice_amount", "max_invoice_amount", F.when(n <= 1, F.lit(0)).otherwise(money(F.col("sd"))).cast("decimal(15,2)").alias("stddev_invoice_amount"),
        rounded(rate, 2).cast("double").alias("avg_invoices_per_hour"), "latest_invoice_timestamp",
    )


def risk(alerts: DataFrame, date_of: str = "detected_at") -> DataFrame:
    """A row for each vendor and day with alerts; the total counts fallback alerts too."""
    days = alerts.withColumn("feature_date", F.to_date(date_of)).where(F.col("feature_date").isNotNull() & F.col("vendor_id").isNotNull())
    rule = lambda name: F.count_if(F.col("rule_name") == name)
    return days.groupBy("vendor_id", "feature_date").agg(rule("ANOMALY").alias("anomaly_alert_count"), rule("VELOCITY").alias("velocity_alert_count"), rule("DUPLICATE").alias("duplicate_alert_count"), F.count("*").alias("total_alert_count"))


def features_view(behave: DataFrame, risks: DataFrame) -> DataFrame:
    """Behaviour with its day's alerts; days without alerts have zero. Join sides are one row a vendor-day."""
    joined = behave.join(risks, ["vendor_id", "feature_date"], "left")
    zero = [c for c in risks.columns if c not in ("vendor_id", "feature_date", "computed_at")]
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})


def baseline(invoices: DataFrame, cfg: Config) -> DataFrame:
    """Average, deviation, 99th percentile and invoices a day of each vendor over the days of history up to as_of."""
    day = F.to_date("invoice_timestamp")
    held = invoices.where((day > F.date_sub(F.lit(cfg.as_of), cfg.history_days)) & (day <= F.lit(cfg.as_of)) & F.col("vendor_id").isNotNull())
    amount = F.col("invoice_amount").cast("double")
    found = held.groupBy("vendor_id").agg(F.count("*").alias("n"), F.sum("invoice_amount").alias("total"), F.stddev_pop(amount).alias("sd"), F.percentile(amount, 0.99).alias("p99"), F.size(F.collect_set(day)).alias("days"))  # as many days as history has at most
    return found.select("vendor_id", money(F.col("total").cast("double") / F.col("n")).alias("avg_invoice_amount"), money(F.col("sd")).alias("stddev_invoice_amount"), money(F.col("p99")).alias("p99_invoice_amount"), F.floor(F.col("n") / F.col("days")).cast("long").alias("avg_daily_invoice_cnt"))


def _recent(rows: DataFrame, cfg: Config) -> DataFrame:
    """The history that rolling sums see; cut before the windows, as that changes their first rows."""
    return rows.where((F.col("feature_date") >= F.date_sub(F.lit(cfg.as_of), cfg.history_days)) & (F.col("feature_date") <= F.lit(cfg.as_of)))


def _over(rows: int) -> Window:
    """The last so many rows of a vendor (rows, not days)."""
    return Window.partitionBy("vendor_id").orderBy("feature_date").rowsBetween(1 - rows, 0)


def rolling_behavioral(behave: DataFrame, cfg: Config) -> DataFrame:
    """Counts and unweighted means of daily means over the last 7 and 30 rows; one sort serves all four."""
    def mean(n: int) -> Column:
        return money(F.avg(F.col("avg_invoice_amount").cast("double")).over(_over(n)))

    count = lambda n: F.sum("invoice_count").over(_over(n))
    return _recent(behave, cfg).withColumns({"invoice_count_7d": count(cfg.short_rows), "avg_invoice_amount_7d": mean(cfg.short_rows), "invoice_count_30d": count(cfg.long_rows), "avg_invoice_amount_30d": mean(cfg.long_rows)})


def rolling_risk(risks: DataFrame, cfg: Config) -> DataFrame:
    names = ["anomaly_alert_count", "velocity_alert_count", "total_alert_count"]
    return _recent(risks, cfg).withColumns({f"{c}_30d": F.sum(c).over(_over(cfg.long_rows)) for c in names})


def alert_ratio(risks: DataFrame, behave: DataFrame, cfg: Config) -> DataFrame:
    """Alerts for each invoice of a vendor-day; above 1 where windows multiply alerts."""
    ratio = safe_divide(F.col("total_alert_count"), F.col("invoice_count"))
    return _recent(risks, cfg).join(behave.select("vendor_id", "feature_date", "invoice_count"), ["vendor_id", "feature_date"]).select("vendor_id", "feature_date", "total_alert_count", "invoice_count", ratio.alias("high_risk_alert_ratio"))


def running(rows: DataFrame, held: DataFrame, values: list[str]) -> DataFrame:
    """(vendor_id, feature_date, values, k, and a running sum of each value) of vendor-days from the first on that ``held``, rows of the same form from earlier runs, lacks or has other values of.

    A vendor's rows are numbered in order of their dates; k is the number. Where nothing came late, these are the new days alone; after a late day they are all later days of that vendor."""
    on = ["vendor_id", "feature_date"]
    known = held.select(*on, F.struct(*values).alias("__known"))
    changed = rows.join(known, on, "left").where(F.col("__known").isNull() | ~F.struct(*values).eqNullSafe(F.col("__known")))
    first = changed.groupBy("vendor_id").agg(F.min("feature_date").alias("__from"))
    before = _before(held, first).groupBy("vendor_id").agg(F.max_by(F.struct("k", *(f"{v}_sum" for v in values)), "feature_date").alias("__base"))
    todo = rows.join(first, "vendor_id").where("feature_date >= __from").join(before, "vendor_id", "left")
    order = Window.partitionBy("vendor_id").orderBy("feature_date")
    zero = F.lit(0)
    sums = [(F.coalesce(F.col(f"__base.{v}_sum"), zero) + F.sum(F.coalesce(v, zero)).over(order)).alias(f"{v}_sum") for v in values]
    return todo.select(*on, *values, (F.coalesce(F.col("__base.k"), zero) + F.row_number().over(order)).cast("long").alias("k"), *sums)


def _before(held: DataFrame, first: DataFrame) -> DataFrame:
    """Rows of vendors that have something new, from before it."""
    return held.join(first, "vendor_id").where("feature_date < __from").drop("__from")


def rolled(new: DataFrame, held: DataFrame, values: list[str], spans: dict[str, int]) -> DataFrame:
    """(vendor_id, feature_date, and for each span and value the sum over the vendor's last so many rows, named value_span, with the number of rows as rows_span) of the rows of running().

    A sum is a difference of two running sums; the earlier one is looked up by its number among the vendor's rows of the history, of which there is one a day at most."""
    names = ["k", *(f"{v}_sum" for v in values)]
    first = new.groupBy("vendor_id").agg(F.min("feature_date").alias("__from"))
    every = _before(held, first).select("vendor_id", *values, *names).unionByName(new.select("vendor_id", *values, *names))
    of_vendor = every.groupBy("vendor_id").agg(F.array_sort(F.collect_list(F.struct(*names, *values))).alias("__rows"))
    joined = new.join(of_vendor, "vendor_id")
    start = F.col("__rows")[0]
    out = []
    for name, n in spans.items():
        low = F.col("k") - n  # the number of the last row that is not in the span
        at = F.try_element_at("__rows", F.greatest(low - start["k"] + 1, F.lit(1)).cast("int"))
        inside = low >= start["k"]
        out.append(F.when(inside, F.lit(n)).otherwise(F.col("k") - start["k"] + 1).cast("long").alias(f"rows_{name}"))
        for v in values:
            earlier = F.when(inside, at[f"{v}_sum"]).otherwise(start[f"{v}_sum"] - F.coalesce(start[v], F.lit(0)))
            out.append((F.col(f"{v}_sum") - earlier).alias(f"{v}_{name}"))
    return joined.select("vendor_id", "feature_date", *out)
