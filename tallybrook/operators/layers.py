"""The layers' row formats: bronze from both feeds, silver, gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _payload(*names: str) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


#: Type, time and payload of each feed's events.
EVENTS = {
    "ERP": ("INVOICE", "invoice_timestamp", ("invoice_id", "po_no", "vendor_id", "upc_no", "invoice_amount", "bank_account_hash", "email_id")),
    "WMS": ("RECEIVING", "received_timestamp", ("wh_id", "po_no", "vendor_id", "upc_no", "qty_received")),
}


def event(feed: str, columns: list[str], now: Column) -> list[Column]:
    """The columns of a raw event from a feed with these columns."""
    kind, ts, names = EVENTS[feed]
    return [F.col("event_uuid"), F.lit(feed).alias("source_system"), F.lit(kind).alias("event_type"), F.col(ts).alias("event_timestamp"), _payload(*(c for c in names if c in columns)).alias("payload"), now.alias("ingested_at")]


def bronze(invoices: DataFrame | None, receipts: DataFrame | None, now: Column | None = None) -> DataFrame:
    """Both feeds as raw events: system, type, event time and the payload as JSON."""
    now = F.current_timestamp() if now is None else now
    parts = [df.select(*event(feed, df.columns, now)) for feed, df in (("ERP", invoices), ("WMS", receipts)) if df is not None]
    if not parts:
        raise ValueError("bronze needs a feed")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def silver(unique_invoices: DataFrame, now: Column | None = None) -> DataFrame:
    """Deduplicated invoices with exact money, without event ids."""
    return unique_invoices.drop("event_uuid").withColumn("invoice_amount", F.col("invoice_amount").try_cast("decimal(15,2)")).withColumn("ingested_at", F.current_timestamp() if now is None else now)


def gold_rows(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("alert_source", F.coalesce("alert_source", F.lit("unknown")))
