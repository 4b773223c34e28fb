"""Trust scores, their explanation, and risk rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.functions.columns import risk_level


def trust_scores(features: DataFrame, cfg: Config, as_of=None) -> DataFrame:
    """A score for each vendor-day of features (of one day, if given): 100 less weighted alert counts, at least 0, with its explanation as JSON."""
    rows = features if as_of is None else features.where(F.col("feature_date") == F.lit(as_of))
    parts = {"anomaly": cfg.weight_anomaly, "velocity": cfg.weight_velocity, "duplicate": cfg.weight_duplicate}
    penalty = sum((F.col(f"{k}_alert_count") * w for k, w in parts.items()), F.lit(0)).cast("long")
    rows = rows.withColumn("risk_penalty", penalty).withColumn("total_penalty", F.col("risk_penalty"))
    rows = rows.withColumn("trust_score", F.greatest(F.lit(0), 100 - F.col("total_penalty")).cast("long"))
    rows = rows.withColumn("risk_level", risk_level(F.col("trust_score"), cfg.excellent, cfg.good, cfg.moderate))
    reasoning = F.when(F.col("risk_level") == "EXCELLENT", "No or few alerts").when(F.col("risk_level") == "GOOD", "Some alerts, worth a look").when(F.col("risk_level") == "MODERATE", "Repeated alerts, review advised").otherwise("Many alerts, act now")
    part = lambda k, w: F.struct(F.col(f"{k}_alert_count").alias("count"), F.lit(w).alias("weight"), (F.col(f"{k}_alert_count") * w).alias("penalty")).alias(f"{k}_alerts")
    context = F.struct("invoice_count", "avg_invoice_amount", "stddev_invoice_amount").alias("behavioral_context")
    explanation = F.struct(F.lit(100).alias("base_score"), *(part(k, w) for k, w in parts.items()), "total_penalty", F.col("trust_score").alias("final_score"), "risk_level", reasoning.alias("reasoning"), context)
    return rows.select(
        "vendor_id", F.col("feature_date").alias("score_date"), "trust_score", "risk_level", F.lit(0).cast("long").alias("behavioral_penalty"), "risk_penalty", "total_penalty",
        "anomaly_alert_count", "velocity_alert_count", "duplicate_alert_count", "total_alert_count", F.to_json(explanation, {"ignoreNullFields": "false"}).alias("score_explanation"),
        F.lit(None).cast("double").alias("ml_fraud_probability"), F.lit(None).cast("string").alias("ml_model_version"),
    )


def rankings(scores: DataFrame) -> DataFrame:
    """Ranks of all days from the riskiest (1), ties by vendor; the change against the day before, negative: riskier, null: new.

    A day's vendors are ranked in parts, by score and the beginning of the vendor's name, which follow each other in rank; parts are counted first, so no task has to sort a whole day."""
    head = F.substring("vendor_id", 1, 3).alias("head")
    rows = scores.select(F.col("score_date").alias("ranking_date"), "vendor_id", "trust_score", "risk_level", head)
    part = ["ranking_date", "trust_score", "head"]
    counts = rows.groupBy(*part).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("ranking_date").orderBy("trust_score", "head").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*part, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy(*part).orderBy("vendor_id"))
    ranked = rows.withColumn("k", within).join(before, part).select("ranking_date", "vendor_id", "trust_score", "risk_level", (F.col("before") + F.col("k")).cast("long").alias("risk_rank"))
    days = Window.partitionBy("vendor_id").orderBy("ranking_date")
    follows = F.lag("ranking_date").over(days) == F.date_sub("ranking_date", 1)
    change = F.when(follows, F.col("risk_rank") - F.lag("risk_rank").over(days))
    return ranked.select("ranking_date", "vendor_id", "trust_score", "risk_rank", "risk_level", change.alias("rank_change"))
