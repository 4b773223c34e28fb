"""Contracts of the layers: columns, partition date and order within files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(*columns: str) -> T.StructType:
    """Columns as "name type" or "name type!" for those that may not be null."""
    kinds = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "money": T.DecimalType(15, 2), "sum": T.DecimalType(38, 2), "ts": T.TimestampType(), "date": T.DateType()}
    return T.StructType([T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")) for name, kind in (c.split() for c in columns)])


WMS_EVENT = _struct("wh_id string", "po_no string", "vendor_id string", "upc_no string", "qty_received long", "received_timestamp ts", "event_uuid string")
ERP_EVENT = _struct("invoice_id string", "po_no string", "vendor_id string", "invoice_amount double", "invoice_timestamp ts", "bank_account_hash string", "upc_no string", "email_id string", "event_uuid string")
BASELINE = _struct("vendor_id string!", "avg_invoice_amount money", "stddev_invoice_amount money", "p99_invoice_amount money", "avg_daily_invoice_cnt long", "refreshed_at ts")


@dataclass(frozen=True)
class Layer:
    """A table of the store: its schema, the column its partition date comes from, the columns that files are sorted by, and its key."""

    schema: T.StructType
    date_of: str | None = None
    cluster: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    filter_required: bool = False


LAYERS = {
    "bronze_raw_events": Layer(_struct("event_uuid string!", "source_system string!", "event_type string!", "event_timestamp ts!", "payload string", "ingested_at ts"), "event_timestamp", ("source_system", "event_type"), ("event_uuid",)),
    "silver_deduplicated_invoices": Layer(_struct("invoice_id string!", "po_no string", "vendor_id string!", "upc_no string", "invoice_amount money!", "invoice_timestamp ts!", "bank_account_hash string", "email_id string", "ingested_at ts"), "invoice_timestamp", ("vendor_id",), ("invoice_id",)),
    "gold_fraud_alerts": Layer(_struct("invoice_id string!", "vendor_id string!", "rule_name string!", "severity string!", "reason string", "evidence string", "window_start ts", "window_end ts", "fraud_score long", "alert_source string", "detected_at ts"), "detected_at", ("rule_name", "severity"), ("invoice_id", "rule_name", "window_start")),
    "vendor_daily_behavioral_features": Layer(_struct("vendor_id string!", "feature_date date!", "invoice_count long!", "total_invoice_amount money!", "avg_invoice_amount money!", "min_invoice_amount money!", "max_invoice_amount money!", "stddev_invoice_amount money", "avg_invoices_per_hour double!", "latest_invoice_timestamp ts", "invoice_count_7d long", "invoice_count_30d long", "avg_invoice_amount_7d money", "avg_invoice_amount_30d money", "computed_at ts"), "feature_date", ("vendor_id",), ("vendor_id", "feature_date"), True),
    "vendor_daily_risk_features": Layer(_struct("vendor_id string!", "feature_date date!", "anomaly_alert_count long!", "velocity_alert_count long!", "duplicate_alert_count long!", "total_alert_count long!", "high_risk_alert_ratio double", "anomaly_alert_count_30d long", "velocity_alert_count_30d long", "total_alert_count_30d long", "computed_at ts"), "feature_date", ("vendor_id",), ("vendor_id", "feature_date"), True),
    "vendor_trust_scores": Layer(_struct("vendor_id string!", "score_date date!", "trust_score long!", "risk_level string!", "behavioral_penalty long!", "risk_penalty long!", "total_penalty long!", "anomaly_alert_count long!", "velocity_alert_count long!", "duplicate_alert_count long!", "total_alert_count long!", "score_explanation string", "ml_fraud_probability double", "ml_model_version string", "computed_at ts"), "score_date", ("vendor_id", "trust_score"), ("vendor_id", "score_date"), True),
    "vendor_risk_rankings": Layer(_struct("ranking_date date!", "vendor_id string!", "trust_score long!", "risk_rank long!", "risk_level string!", "rank_change long", "computed_at ts"), "ranking_date", ("vendor_id", "risk_rank"), ("ranking_date", "vendor_id"), True),
    "vendor_90day_baseline": Layer(BASELINE, None, (), ("vendor_id",)),
    "vendor_running_behavior": Layer(_struct("vendor_id string!", "feature_date date!", "invoice_count long", "avg_invoice_amount money", "k long!", "invoice_count_sum long", "avg_invoice_amount_sum sum"), "feature_date", ("vendor_id",), ("vendor_id", "feature_date"), True),
    "vendor_running_risk": Layer(_struct("vendor_id string!", "feature_date date!", "anomaly_alert_count long", "velocity_alert_count long", "total_alert_count long", "k long!", "anomaly_alert_count_sum long", "velocity_alert_count_sum long", "total_alert_count_sum long"), "feature_date", ("vendor_id",), ("vendor_id", "feature_date"), True),
    "dead_letter": Layer(_struct("line_id string!", "raw string", "err string", "feed string!", "ingested_at ts"), None, (), ("line_id", "feed")),
}


#: Columns whose default is the time of writing.
DEFAULT_NOW = ("ingested_at", "computed_at", "refreshed_at")


def conform(df: DataFrame, layer: str) -> DataFrame:
    """df with exactly the layer's columns and types, missing nullable ones as their default or null; a missing column that may not be null raises."""
    from pyspark.sql import functions as F

    schema = LAYERS[layer].schema
    if gone := [f.name for f in schema if f.name not in df.columns and not f.nullable]:
        raise ValueError(f"{layer} needs {', '.join(gone)}")
    return df.select(*((F.col(f.name) if f.name in df.columns else F.current_timestamp() if f.name in DEFAULT_NOW else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
