"""Structured Streaming: dedup with and without its duplicates, anomaly against the baseline, daily windows, and the whole job with its sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallybrook.config import Config
from tallybrook.operators import features, layers, rules
from tallybrook.plans.store import Store, refreshed
from tallybrook.sources import jsonl
from tallybrook.streaming.ledger import Ledger
from tallybrook.streaming.velocity import velocity_stream


def dedup_stream(invoices: DataFrame, cfg: Config, ts: str = "invoice_timestamp") -> DataFrame:
    """The first row of each id within the time to live; state goes as the watermark passes. Kept ids may be held up to twice the time to live."""
    return invoices.withWatermark(ts, f"{cfg.dedup_ttl} seconds").dropDuplicatesWithinWatermark(["invoice_id"])


class FirstSeen(StatefulProcessor):
    """Holds the event time of an id's accepted row; rows less than ttl later are duplicates and don't extend it. A timer cleans up."""

    def __init__(self, ttl: int, columns: list[str], ts: str) -> None:
        self.ttl, self.columns, self.ts = ttl, columns, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.since = handle.getValueState("since", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.since.get()[0] if self.since.exists() else None
        for row in sorted(rows, key=lambda r: r[self.ts]):  # within a batch rows arrive in any order
            at = int(row[self.ts].timestamp() * 1000)
            again = held is not None and at < held + self.ttl * 1000
            if not again:
                held = at
                self.since.update((at,))
                self.handle.registerTimer(at + self.ttl * 1000)
            yield Row(**{c: row[c] for c in self.columns}, is_duplicate=again)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.since.exists() and self.since.get()[0] + self.ttl * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.since.clear()
        return iter(())

    def close(self) -> None:
        pass


def dedup_with_duplicates(invoices: DataFrame, cfg: Config, ts: str = "invoice_timestamp") -> DataFrame:
    """All rows with ``is_duplicate``; needs the RocksDB state store (use_rocksdb)."""
    schema = T.StructType([*invoices.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    watered = invoices.withWatermark(ts, f"{cfg.lateness} seconds")
    return watered.groupBy("invoice_id").transformWithState(FirstSeen(cfg.dedup_ttl, invoices.columns, ts), schema, "Append", "EventTime", eventTimeColumnName=ts)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def anomaly_stream(invoices: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """Anomaly and fallback alerts, row by row against a static baseline."""
    return rules.anomaly_alerts(invoices, baseline, cfg).unionByName(rules.fallback_alerts(invoices, baseline, cfg))


def daily_stream(invoices: DataFrame, cfg: Config, ts: str = "invoice_timestamp") -> DataFrame:
    """Counts and sums by vendor and day, complete when the watermark has passed the day."""
    days = invoices.withWatermark(ts, f"{cfg.lateness} seconds").groupBy(F.window(ts, "1 day"), "vendor_id")
    return days.agg(F.count("*").alias("invoice_count"), F.sum("invoice_amount").alias("total_invoice_amount")).select("vendor_id", F.to_date("window.start").alias("feature_date"), "invoice_count", "total_invoice_amount")


def _started(writer: DataStreamWriter, cfg: Config, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{cfg.trigger} seconds")).start()


def to_files(df: DataFrame, path: str, checkpoint: str, cfg: Config, once: bool = False) -> StreamingQuery:
    """Append to Parquet files; availableNow with once, else every trigger interval."""
    return _started(df.writeStream.format("parquet").outputMode("append").option("path", path), cfg, checkpoint, once)


def to_layer(df: DataFrame, store: Store, layer: str, checkpoint: str, cfg: Config, once: bool = False) -> StreamingQuery:
    """Each batch's rows whose keys the layer lacks are appended, so that a batch that runs again changes nothing. Keys come again within the time to live: only its days are read."""

    def write(batch: DataFrame) -> dict[str, int]:
        store.insert_missing(batch, layer, _days(cfg.dedup_ttl))
        return {}

    return written(df, write, store.spark, checkpoint, cfg, once)


def _days(seconds: int) -> int:
    return -(-seconds // 86_400)


def written(df: DataFrame, write: Callable[[DataFrame], dict[str, int]], spark: SparkSession, checkpoint: str, cfg: Config, once: bool = False) -> StreamingQuery:
    """Starts a query that hands each batch to ``write``, the one writer of its layers, and notes the figures that it returns in the ledger beside the checkpoint: a batch that was noted is not written again."""
    ledger = Ledger(spark, f"{checkpoint}/written")

    def run(batch: DataFrame, k: int) -> None:
        if not ledger.has(k):
            ledger.note(k, write(batch))

    return _started(df.writeStream.outputMode("append").foreachBatch(run), cfg, checkpoint, once)


def metrics(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """The sums of a query's figures over all its batches, also those before a restart."""
    return Ledger(spark, f"{checkpoint}/written").sums()


def observed_duplicates(flagged: DataFrame, name: str = "dedup") -> DataFrame:
    """Accepted and suppressed invoices of dedup_with_duplicates() in each batch's progress."""
    return flagged.observe(name, F.count_if(~F.col("is_duplicate")).alias("accepted"), F.count_if("is_duplicate").alias("suppressed"))


def _feed(parsed: DataFrame, feed: str) -> DataFrame:
    """A parsed feed as rows that are either events of bronze or dead letters, whose lines are masked."""
    bad = F.col("err").isNotNull()
    return parsed.select(
        F.lit(feed).alias("feed"), jsonl.line_id(F.col("raw")).alias("line_id"), F.when(bad, jsonl.masked(F.col("raw"))).alias("raw"), "err",
        *layers.event(feed, parsed.columns, F.current_timestamp()),
    )


def bronze_query(erp: DataFrame | None, wms: DataFrame | None, store: Store, checkpoint: str, cfg: Config, once: bool = False) -> StreamingQuery:
    """Bronze and dead letters of both feeds, which are one stream here: a layer has one writer, as two that append at once disturb each other."""
    parts = [_feed(parse(lines), feed) for feed, parse, lines in (("ERP", jsonl.parse_erp, erp), ("WMS", jsonl.parse_wms, wms)) if lines is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    feed, bad = F.col("feed"), F.col("err").isNotNull()

    def write(batch: DataFrame) -> dict[str, int]:
        seen = Observation()
        counts = {f"{f.lower()}_{name}": F.count_if((feed == f) & test) for f in ("ERP", "WMS") for name, test in (("lines", F.lit(True)), ("dead_letters", bad))}
        rows = store.staged(batch.observe(seen, *(c.alias(k) for k, c in counts.items())), "bronze")
        store.insert_missing(rows.where("err is null"), "bronze_raw_events")
        store.insert_missing(rows.where("err is not null").select("line_id", "raw", "err", "feed", "ingested_at"), "dead_letter")
        store.staged_drop(rows)
        return seen.get

    return written(both, write, store.spark, checkpoint, cfg, once)


def silver_query(unique: DataFrame, store: Store, checkpoint: str, cfg: Config, once: bool = False) -> StreamingQuery:
    """Invoices that silver lacks are appended; then, in the same batch, the behaviour of the vendor-days that it touches is made anew from silver."""

    def write(batch: DataFrame) -> dict[str, int]:
        seen = Observation()
        rows = store.staged(batch.observe(seen, F.count("*").alias("invoices")), "silver")
        store.insert_missing(rows, "silver_deduplicated_invoices", _days(cfg.dedup_ttl))
        refreshed(store, rows, "silver_deduplicated_invoices", "invoice_timestamp", features.behavioral, "vendor_daily_behavioral_features")
        store.staged_drop(rows)
        return seen.get

    return written(unique, write, store.spark, checkpoint, cfg, once)


def gold_query(alerts: DataFrame, store: Store, checkpoint: str, cfg: Config, once: bool = False) -> StreamingQuery:
    """Alerts that gold lacks are appended, and the risk of the vendor-days that they touch is made anew from gold. Figures: alerts by rule, and invoices whose vendor has no baseline."""
    rule = F.col("rule_name")

    def write(batch: DataFrame) -> dict[str, int]:
        seen = Observation()
        counts = [F.count("*").alias("all"), *(F.count_if(rule == r).alias(r.lower()) for r in ("VELOCITY", "ANOMALY", "FALLBACK")), F.count_if(F.endswith("reason", F.lit(rules.NO_BASELINE))).alias("no_baseline")]
        rows = store.staged(layers.gold_rows(batch).observe(seen, *counts), "gold")
        store.insert_missing(rows, "gold_fraud_alerts", _days(cfg.window + cfg.lateness))
        refreshed(store, rows, "gold_fraud_alerts", "detected_at", features.risk, "vendor_daily_risk_features")
        store.staged_drop(rows)
        return seen.get

    return written(alerts, write, store.spark, checkpoint, cfg, once)


def gold_stream(invoices: DataFrame, baseline: DataFrame, cfg: Config) -> DataFrame:
    """All alerts of deduplicated invoices with a watermark: anomaly and fallback row by row, velocity as windows close. Detected when the invoice was."""
    velocity = rules.velocity_rows(velocity_stream(invoices, cfg, watermarked=True), cfg)
    every = velocity.unionByName(anomaly_stream(invoices, baseline, cfg))
    return every.withColumnRenamed("invoice_timestamp", "detected_at")


def run_stream(spark: SparkSession, store: Store, erp: DataFrame, wms: DataFrame | None, baseline: DataFrame, cfg: Config, checkpoint: str, once: bool = False) -> dict[str, StreamingQuery]:
    """The whole job over feeds of lines (value), as three queries by name: ``bronze`` (with dead letters), ``silver`` (with behaviour) and ``gold`` (with risk). Each layer has one writer.

    Gold follows the files of silver, so that invoices are parsed and deduplicated once for both. Each query inserts what its layers lack or replaces what it touches, so that after a restart from its
    checkpoint, or from none, the layers are the same. With once, all that is there is read, and the queries have ended on return. The state is kept in RocksDB."""
    use_rocksdb(spark)
    started: dict[str, StreamingQuery] = {}

    def go(name: str, start: Callable[[str], StreamingQuery]) -> None:
        started[name] = start(f"{checkpoint}/{name}")
        if once:
            started[name].awaitTermination()

    go("bronze", lambda c: bronze_query(erp, wms, store, c, cfg, once))
    good = jsonl.split_ok(jsonl.parse_erp(erp))[0]
    go("silver", lambda c: silver_query(layers.silver(dedup_stream(good, cfg)), store, c, cfg, once))
    invoices = store.stream("silver_deduplicated_invoices").withWatermark("invoice_timestamp", f"{cfg.lateness} seconds")
    go("gold", lambda c: gold_query(gold_stream(invoices, baseline, cfg), store, c, cfg, once))
    return started
