from __future__ import annotations

import dataclasses
import datetime as dt
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.operators import dedup, rules
from tallybrook.operators.features import risk as risk_of
from tallybrook.plans import batch
from tallybrook.plans.store import Store
from tallybrook.schemas import LAYERS
from tallybrook.sources import fixtures, jsonl, tables
from tallybrook.streaming import jobs
from tallybrook.streaming.ledger import Ledger
from tallybrook.streaming.velocity import Bursts

CFG = Config()


def _in_order(folder: Path) -> None:
    """Gives the files times in the order of their names, in which streams read them."""
    for k, path in enumerate(sorted(folder.glob("*.jsonl"))):
        os.utime(path, (1_704_067_200 + k, 1_704_067_200 + k))


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    """One file of invoices, and one whose late-dated row lets the watermark pass all windows."""
    folder = tmp_path_factory.mktemp("feed")
    rows = fixtures.invoices(60)
    fixtures.write_lines(str(folder / "a.jsonl"), rows)
    close = rows[0] | {"invoice_id": "CLOSE", "vendor_id": "V-1002", "event_uuid": "close", "invoice_timestamp": "2024-01-03T00:00:00+00:00"}
    fixtures.write_lines(str(folder / "b.jsonl"), [close])
    _in_order(folder)
    return str(folder)


def _stream(spark, feed):
    good, _ = jsonl.split_ok(jsonl.parse_erp(jsonl.stream_lines(spark, feed, 1)))
    return good


def _batch(spark, feed):
    good, _ = jsonl.split_ok(jsonl.parse_erp(jsonl.read_lines(spark, feed)))
    return dedup.unique(good, "invoice_id", ["invoice_timestamp", "event_uuid"])


@pytest.fixture(autouse=True)
def rocksdb(spark):
    jobs.use_rocksdb(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_streamed_velocity_equals_batch(spark, feed, tmp_path):
    found = jobs.velocity_stream(jobs.dedup_stream(_stream(spark, feed), CFG), CFG, watermarked=True)
    jobs.to_files(found, str(tmp_path / "out"), str(tmp_path / "check"), CFG, once=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    want = rules.velocity_groups(_batch(spark, feed), CFG)
    key = lambda df: sorted((str(r["window_start"]), r["vendor_id"], str(r["amount"]), r["occurrences"]) for r in df.collect())
    assert key(rows) == key(want) and key(want)


def test_streamed_anomalies_equal_batch(spark, feed, tmp_path):
    base = tables.seed_baseline(spark)
    found = jobs.anomaly_stream(jobs.dedup_stream(_stream(spark, feed), CFG), base, CFG)
    jobs.to_files(found.select("invoice_id", "rule_name"), str(tmp_path / "out"), str(tmp_path / "check"), CFG, once=True).awaitTermination()
    rows = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    rows_ = _batch(spark, feed)
    want = rules.anomaly_alerts(rows_, base, CFG).unionByName(rules.fallback_alerts(rows_, base, CFG))
    assert rows == sorted(map(tuple, want.select("invoice_id", "rule_name").collect()))


def test_duplicates_come_out_too(spark, feed, tmp_path):
    flagged = jobs.dedup_with_duplicates(_stream(spark, feed), CFG)
    jobs.to_files(flagged, str(tmp_path / "out"), str(tmp_path / "check"), CFG, once=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.where("is_duplicate").count() == 3 and rows.count() == int(0.85 * 60) + 28 + 1


def test_silver_and_features_are_idempotent(spark, feed, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for run in range(2):
        silver = jobs.dedup_stream(_stream(spark, feed), CFG).withColumn("ingested_at", F.current_timestamp())
        jobs.silver_query(silver, store, str(tmp_path / f"c{run}"), CFG, once=True).awaitTermination()
    held = store.read("silver_deduplicated_invoices")
    assert held.count() == held.select("invoice_id").distinct().count() == int(0.85 * 60) + 25 + 1
    features = store.read("vendor_daily_behavioral_features", since="2024-01-01")
    assert features.count() == features.select("vendor_id", "feature_date").distinct().count()
    assert features.agg(F.sum("invoice_count")).first()[0] == held.count()


def test_the_whole_job_twice(spark, feed, tmp_path):
    folder = tmp_path / "feeds"
    (folder / "erp").mkdir(parents=True)
    (folder / "wms").mkdir()
    for name in ("a.jsonl", "b.jsonl"):
        (folder / "erp" / name).write_text((Path(feed) / name).read_text())
    fixtures.write_lines(str(folder / "erp" / "c.jsonl"), [], tuple(fixtures.BAD_INVOICES))
    fixtures.write_lines(str(folder / "wms" / "a.jsonl"), fixtures.receipts(20), ("no json",))
    _in_order(folder / "erp")
    store, base = Store(spark, str(tmp_path / "store")), tables.seed_baseline(spark)
    seen = []
    for run in range(2):
        erp, wms = (jsonl.stream_lines(spark, str(folder / f), 1) for f in ("erp", "wms"))
        started = jobs.run_stream(spark, store, erp, wms, base, CFG, str(tmp_path / f"check{run}"), once=True)
        assert set(started) == {"bronze", "silver", "gold"}
        bronze = jobs.metrics(spark, str(tmp_path / f"check{run}" / "bronze"))
        assert bronze == {"erp_lines": int(0.85 * 60) + 28 + 1 + len(fixtures.BAD_INVOICES), "erp_dead_letters": len(fixtures.BAD_INVOICES), "wms_lines": 21, "wms_dead_letters": 1}
        seen.append({r["layer"]: r["row_count"] for r in store.counts().collect()})
        if not run:  # the second run's gold follows the same files again
            alerts = jobs.metrics(spark, str(tmp_path / "check0" / "gold"))
            held = {r[0].lower(): r[1] for r in store.read("gold_fraud_alerts").groupBy("rule_name").count().collect()}
            assert {k: alerts[k] for k in held} == held and len(held) == 3 and 0 < alerts["no_baseline"] <= alerts["fallback"]
    assert seen[0] == seen[1]
    assert seen[0]["dead_letter"] == len(fixtures.BAD_INVOICES) + 1 and seen[0]["bronze_raw_events"] == int(0.85 * 60) + 28 + 1 + 20
    unique = _batch(spark, feed)
    want = rules.gold(unique, base, CFG)
    key = lambda df: sorted((r["invoice_id"], r["rule_name"], str(r["window_start"]), r["fraud_score"], str(r["detected_at"])) for r in df.collect())
    gold = store.read("gold_fraud_alerts")
    assert key(gold) == key(want) and seen[0]["silver_deduplicated_invoices"] == unique.count()
    risk = {(r["vendor_id"], r["feature_date"]): (r["total_alert_count"], r["velocity_alert_count"]) for r in store.read("vendor_daily_risk_features", since="2023-01-01").collect()}
    assert risk == {(r["vendor_id"], r["feature_date"]): (r["total_alert_count"], r["velocity_alert_count"]) for r in risk_of(gold).collect()}
    assert store.read("vendor_daily_behavioral_features", since="2023-01-01").agg(F.sum("invoice_count")).first()[0] == unique.count()


def test_both_feeds_at_intervals_equal_the_batch_job(spark, tmp_path):
    """Some thirty batches of both feeds by three queries side by side; then a restart from the checkpoint."""
    cfg = dataclasses.replace(CFG, trigger=0)
    rows = fixtures.invoices(100)
    close = rows[0] | {"invoice_id": "CLOSE", "vendor_id": "V-1002", "event_uuid": "close", "invoice_timestamp": "2024-01-03T00:00:00+00:00"}
    receipts = fixtures.receipts(40)
    for name in ("erp", "wms"):
        (tmp_path / name).mkdir()
    rows.sort(key=lambda r: r["invoice_timestamp"])
    for k in range(10):
        fixtures.write_lines(str(tmp_path / "erp" / f"{k:02}.jsonl"), rows[k * len(rows) // 10 : (k + 1) * len(rows) // 10], tuple(fixtures.BAD_INVOICES)[:1] if k == 3 else ())
        fixtures.write_lines(str(tmp_path / "wms" / f"{k:02}.jsonl"), receipts[3 * k : 3 * k + 3], ("no json",) if k == 4 else ())
        _in_order(tmp_path / "erp")
        _in_order(tmp_path / "wms")
    store, base, check = Store(spark, str(tmp_path / "store")), tables.seed_baseline(spark), str(tmp_path / "check")

    def run() -> None:
        erp, wms = (jsonl.stream_lines(spark, str(tmp_path / f), 1) for f in ("erp", "wms"))
        started = jobs.run_stream(spark, store, erp, wms, base, cfg, check)
        try:
            for name in ("bronze", "silver", "gold"):  # gold follows silver's files
                started[name].processAllAvailable()
            assert all(q.isActive and q.exception() is None for q in started.values())
        finally:
            for q in started.values():
                q.stop()

    run()
    fixtures.write_lines(str(tmp_path / "erp" / "18.jsonl"), [close])
    fixtures.write_lines(str(tmp_path / "wms" / "18.jsonl"), receipts[30:])
    _in_order(tmp_path / "erp")
    _in_order(tmp_path / "wms")
    run()
    figures = jobs.metrics(spark, f"{check}/bronze")
    assert figures == {"erp_lines": len(rows) + 2, "erp_dead_letters": 1, "wms_lines": 41, "wms_dead_letters": 1}
    other = Store(spark, str(tmp_path / "other"))
    batch.run_batch(spark, other, str(tmp_path / "erp"), str(tmp_path / "wms"), base, cfg)
    times = ("ingested_at", "computed_at")
    for layer in ("bronze_raw_events", "dead_letter", "silver_deduplicated_invoices", "gold_fraud_alerts", "vendor_daily_behavioral_features", "vendor_daily_risk_features"):
        one, two = (sorted(map(repr, s.read(layer, since=dt.date(2023, 1, 1)).drop(*times).collect())) if LAYERS[layer].date_of else sorted(map(repr, s.read(layer).drop(*times).collect())) for s in (store, other))
        assert one == two and one, layer


def test_streamed_velocity_over_many_triggers(spark, tmp_path):
    """Groups across batches come out once; a slice is forgotten as soon as no open window holds it; rows that come too late are in no window that is over."""
    cfg = dataclasses.replace(CFG, window=600, slide=240, lateness=60, min_repeats=2)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rng, rows = random.Random(4), []
    for k in range(12):
        part = [{"invoice_id": f"i{k}-{j}", "vendor_id": rng.choice(["a", "b"]), "invoice_amount": rng.choice([5.0, 7.5]), "invoice_timestamp": (start + dt.timedelta(seconds=200 * k + rng.randrange(200))).isoformat()} for j in range(6)]
        fixtures.write_lines(str(tmp_path / f"{k:02}.jsonl"), part)
        rows += part
    fixtures.write_lines(str(tmp_path / "12.jsonl"), [rows[0] | {"invoice_id": "close", "vendor_id": "c", "invoice_timestamp": (start + dt.timedelta(days=1)).isoformat()}])
    fixtures.write_lines(str(tmp_path / "13.jsonl"), [rows[0] | {"invoice_id": "late"}])
    _in_order(tmp_path)
    schema = "invoice_id string, vendor_id string, invoice_amount double, invoice_timestamp timestamp"
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(str(tmp_path / "*.jsonl"))
    jobs.to_files(jobs.velocity_stream(lines, cfg), str(tmp_path / "out"), str(tmp_path / "check"), cfg, once=True).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    want = rules.velocity_groups(spark.read.schema(schema).json([str(tmp_path / f"{k:02}.jsonl") for k in range(13)]), cfg)
    key = lambda df: sorted(repr((r["window_start"], r["window_end"], r["vendor_id"], r["amount"], r["occurrences"], sorted(map(tuple, r["members"])))) for r in df.collect())
    assert key(found) == key(want) and found.count() > 10


def test_windows_of_slices():
    for window, slide in ((600, 60), (600, 240), (100, 100), (90, 60)):
        held = Bursts(window, slide, 3)
        for start in range(0, 2000, held.unit):
            for after in (0, 500, 1234):
                ends = [s + window for s in range(-window // slide * slide - slide, 4000, slide) if s + window > after and (s <= start < s + window or s + window > start + window)]
                assert held.first_end(start, after) == min(e for e in ends if e > start and e > after), (window, slide, start, after)


def test_the_ledger_lasts(spark, tmp_path):
    held = Ledger(spark, str(tmp_path / "written"))
    for k in range(250):
        assert not held.has(k)
        held.note(k, {"rows": k, "none": None})
    again = Ledger(spark, str(tmp_path / "written"))
    assert again.sums() == {"rows": sum(range(250)), "none": 0} and all(again.has(k) for k in range(250)) and not again.has(250)
    assert len([p for p in (tmp_path / "written").iterdir() if not p.name.startswith(".")]) == 50


def test_suppressed_duplicates_are_counted(spark, feed, tmp_path):
    flagged = jobs.observed_duplicates(jobs.dedup_with_duplicates(_stream(spark, feed), CFG))
    query = jobs.to_files(flagged, str(tmp_path / "out"), str(tmp_path / "check"), CFG, once=True)
    query.awaitTermination()
    rows = [p.observedMetrics["dedup"].asDict() for p in query.recentProgress if "dedup" in p.observedMetrics]
    assert {k: sum(r[k] for r in rows) for k in rows[0]} == {"accepted": int(0.85 * 60) + 25 + 1, "suppressed": 3}


def test_a_stream_at_intervals_runs_until_it_is_stopped(spark, feed, tmp_path):
    found = jobs.anomaly_stream(_stream(spark, feed), tables.seed_baseline(spark), CFG).select("invoice_id", "rule_name")
    query = jobs.to_files(found, str(tmp_path / "out"), str(tmp_path / "check"), dataclasses.replace(CFG, trigger=1))
    query.processAllAvailable()
    assert query.isActive and spark.read.parquet(str(tmp_path / "out")).count() > 0
    query.stop()


def test_daily_windows(spark, feed, tmp_path):
    days = jobs.daily_stream(_stream(spark, feed), CFG)
    jobs.to_files(days, str(tmp_path / "out"), str(tmp_path / "check"), CFG, once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("invoice_count")).first()[0] == int(0.85 * 60) + 28
