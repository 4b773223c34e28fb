"""The batch job from JSON lines to features, and the nightly jobs: rolling features, trust scores, rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.functions.columns import money, safe_divide
from tallybrook.operators import dedup, features, layers, rules, scores
from tallybrook.plans.store import Store, refreshed
from tallybrook.sources import jsonl


def run_batch(spark: SparkSession, store: Store, erp: str | None, wms: str | None, baseline: DataFrame, cfg: Config, detected_at=None) -> dict[str, int]:
    """Reads the feeds, writes bronze, silver, gold, dead letters and the vendor-day features; returns rows by layer.

    A feed is parsed once, into a staged table that holds masked lines of dead letters and typed columns of the others. Rows and dead letters without an id of their own have
    one made from their line, so that a job that runs again changes nothing. Only what the run's own invoices can change is made anew: see judged(). Time of detection is now, or as given."""
    good = receipts = None
    staged = []
    if erp:
        good, staged = _ingested(store, jsonl.parse_erp(jsonl.read_lines(spark, erp)), "ERP", staged)
    if wms:
        receipts, staged = _ingested(store, jsonl.parse_wms(jsonl.read_lines(spark, wms)), "WMS", staged)
    store.insert_missing(layers.bronze(good, receipts), "bronze_raw_events")
    if good is not None:
        order = ["invoice_timestamp", "vendor_id", "invoice_amount", "event_uuid"]
        store.insert_missing(layers.silver(dedup.unique(good, "invoice_id", order)), "silver_deduplicated_invoices", None)
        judged(store, good, baseline, cfg, detected_at)
    store.staged_drop(*staged)
    return {r["layer"]: r["row_count"] for r in store.counts().collect()}


def judged(store: Store, invoices: DataFrame, baseline: DataFrame, cfg: Config, detected_at=None) -> None:
    """Behaviour, alerts and risk of what invoices, which are in silver by now, can change; all other days of silver, gold and the features are neither read nor written.

    An invoice changes the behaviour of its own day, and alerts of the days around it that a window with it reaches; these alerts need silver as far again. With a time of detection given,
    alerts are dated by it, and those that gold lacks are added instead of days being replaced."""
    reach = -(-cfg.window // 86_400)
    days = store.days(invoices, "silver_deduplicated_invoices")
    if not days:
        return
    around = lambda days, n: sorted({d + dt.timedelta(k) for d in days for k in range(-n, n + 1)})
    refreshed(store, invoices, "silver_deduplicated_invoices", "invoice_timestamp", features.behavioral, "vendor_daily_behavioral_features")
    touched = around(days, reach)
    silver = store.read("silver_deduplicated_invoices", days=around(touched, reach))
    alerts = rules.gold(silver, baseline, cfg, detected_at, days=touched)
    alerts = store.staged(layers.gold_rows(alerts), "gold")
    if detected_at is None:
        store.overwrite_days(alerts, "gold_fraud_alerts")
    else:
        store.insert_missing(alerts, "gold_fraud_alerts", None)
    refreshed(store, alerts, "gold_fraud_alerts", "detected_at", features.risk, "vendor_daily_risk_features")
    store.staged_drop(alerts)


def _ingested(store: Store, parsed: DataFrame, feed: str, staged: list[DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """The feed's good rows; its dead letters are inserted into their layer."""
    kept = parsed.withColumns({"line_id": jsonl.line_id(F.col("raw")), "line": F.when(F.col("err").isNotNull(), jsonl.masked(F.col("raw")))}).drop("raw")
    held = store.staged(kept, feed.lower())
    bad = held.where("err is not null").select("line_id", F.col("line").alias("raw"), "err", F.lit(feed).alias("feed"), F.current_timestamp().alias("ingested_at"))
    store.insert_missing(bad, "dead_letter")
    return held.where("err is null").drop("err", "line", "line_id"), [*staged, held]


def refresh_baseline(store: Store, cfg: Config) -> None:
    """The baseline from the last days of silver."""
    found = features.baseline(store.read("silver_deduplicated_invoices", since=cfg.as_of - dt.timedelta(cfg.history_days)), cfg)
    store.overwrite_days(found.withColumn("refreshed_at", F.current_timestamp()), "vendor_90day_baseline")


def nightly_rolling(store: Store, cfg: Config) -> None:
    """Rolling columns and the alert ratio of the vendor-days that are new or came late since the last run, and of the later days of vendors with late ones; other days are not written.

    Running sums are kept in layers of their own; a span's sum is a difference of two of them."""
    since = cfg.as_of - dt.timedelta(cfg.history_days)
    short, long = cfg.short_rows, cfg.long_rows
    behave = store.read("vendor_daily_behavioral_features", since=since, until=cfg.as_of)
    values = ["invoice_count", "avg_invoice_amount"]
    found, new = _run(store, "vendor_running_behavior", behave, values, {"7d": short, "30d": long}, since, cfg)
    mean = lambda span: money(F.col(f"avg_invoice_amount_{span}").cast("double") / F.col(f"rows_{span}")).alias(f"avg_invoice_amount_{span}")
    names = ["invoice_count_7d", "invoice_count_30d", "avg_invoice_amount_7d", "avg_invoice_amount_30d"]
    store.upsert(found.select("vendor_id", "feature_date", "invoice_count_7d", "invoice_count_30d", mean("7d"), mean("30d")), "vendor_daily_behavioral_features", names)
    store.staged_drop(new, found)
    risk = store.read("vendor_daily_risk_features", since=since, until=cfg.as_of)
    values = ["anomaly_alert_count", "velocity_alert_count", "total_alert_count"]
    rolled, new = _run(store, "vendor_running_risk", risk, values, {"30d": long}, since, cfg)
    counts = store.read("vendor_daily_behavioral_features", since=since, until=cfg.as_of).select("vendor_id", "feature_date", "invoice_count")  # its files are new
    ratio = safe_divide(F.col("total_alert_count"), F.col("invoice_count")).alias("high_risk_alert_ratio")
    found = rolled.join(new.select("vendor_id", "feature_date", "total_alert_count"), ["vendor_id", "feature_date"]).join(counts, ["vendor_id", "feature_date"], "left")
    names = [f"{v}_30d" for v in values]
    store.upsert(found.select("vendor_id", "feature_date", *names, ratio), "vendor_daily_risk_features", [*names, "high_risk_alert_ratio"])
    store.staged_drop(new, rolled)


def _run(store: Store, layer: str, rows: DataFrame, values: list[str], spans: dict[str, int], since: dt.date, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """The rolled sums of new rows, and these rows with their running sums, staged; the layer of running sums holds them after it."""
    held = store.read(layer, since=since, until=cfg.as_of)
    new = store.staged(features.running(rows.select("vendor_id", "feature_date", *values), held, values), layer)
    found = store.staged(features.rolled(new, held, values, spans), f"{layer}_rolled")
    store.upsert(new, layer)
    return found, new


def features_view(store: Store, since: dt.date, until: dt.date, name: str = "vendor_daily_features_view") -> DataFrame:
    """Behaviour with its day's alerts, from both feature layers, also as a temporary view that SQL can name."""
    risk = store.read("vendor_daily_risk_features", since=since, until=until).select("vendor_id", "feature_date", *features.RISK_COUNTS)
    found = features.features_view(store.read("vendor_daily_behavioral_features", since=since, until=until), risk)
    found.createOrReplaceTempView(name)
    return found


def nightly_trust(store: Store, cfg: Config) -> None:
    """Scores of the day; run again, they replace themselves."""
    day = cfg.as_of
    found = scores.trust_scores(features_view(store, day, day), cfg, day)
    store.overwrite_days(found.withColumn("computed_at", F.current_timestamp()), "vendor_trust_scores")


def nightly_rankings(store: Store, cfg: Config) -> None:
    """Ranks of the day, against the day before."""
    day = cfg.as_of
    held = scores.rankings(store.read("vendor_trust_scores", since=day - dt.timedelta(1), until=day)).where(F.col("ranking_date") == F.lit(day))
    store.overwrite_days(held.withColumn("computed_at", F.current_timestamp()), "vendor_risk_rankings")


def nightly(store: Store, cfg: Config) -> None:
    nightly_rolling(store, cfg)
    nightly_trust(store, cfg)
    nightly_rankings(store, cfg)
