from __future__ import annotations

import datetime as dt
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.operators import features
from tallybrook.plans import batch
from tallybrook.plans.store import Store
from tallybrook.schemas import LAYERS, conform
from tallybrook.sources import fixtures, jsonl, tables


def test_batch_and_nightly_twice_give_the_same(spark, tmp_path):
    erp = fixtures.write_lines(str(tmp_path / "erp.jsonl"), fixtures.invoices(100), tuple(fixtures.BAD_INVOICES))
    wms = fixtures.write_lines(str(tmp_path / "wms.jsonl"), fixtures.receipts(50))
    store, cfg = Store(spark, str(tmp_path / "store")), Config(as_of=dt.date(2024, 1, 1))
    found = []
    for _ in range(2):
        counts = batch.run_batch(spark, store, erp, wms, tables.seed_baseline(spark), cfg, F.col("invoice_timestamp"))
        batch.nightly(store, cfg)
        trust = store.read("vendor_trust_scores", since=cfg.as_of)
        assert counts["dead_letter"] == len(fixtures.BAD_INVOICES)
        found.append(({k: v for k, v in counts.items() if k not in ("vendor_trust_scores", "vendor_risk_rankings", "vendor_running_behavior", "vendor_running_risk")}, sorted(tuple(r) for r in trust.select("vendor_id", "trust_score").collect()), store.read("vendor_risk_rankings", since=cfg.as_of).count()))
    (a, scores, ranks), (b, scores_again, ranks_again) = found
    assert a == b and scores == scores_again and ranks == ranks_again == len(scores) == 7
    assert a["bronze_raw_events"] == b["bronze_raw_events"] == 113 + 50 and a["silver_deduplicated_invoices"] == b["silver_deduplicated_invoices"] == 110
    assert b["gold_fraud_alerts"] == a["gold_fraud_alerts"] and b["vendor_daily_behavioral_features"] == 7
    viewed = spark.sql("SELECT count(*) AS n, sum(total_alert_count) AS alerts FROM vendor_daily_features_view").first()
    assert viewed["n"] == 7 and viewed["alerts"] == b["gold_fraud_alerts"]
    assert store.read("silver_deduplicated_invoices").where("ingested_at is null").count() == 0
    rolled = store.read("vendor_daily_behavioral_features", since=cfg.as_of)
    assert rolled.where("invoice_count_7d is null").count() == 0
    batch.refresh_baseline(store, cfg)
    assert store.counts().where("layer = 'vendor_90day_baseline'").first()["row_count"] == 7
    store.truncate()
    assert store.counts().agg(F.sum("row_count")).first()[0] == 0


def test_reading_by_date_is_required_and_prunes(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="by date"):
        store.read("vendor_trust_scores")
    df = spark.createDataFrame([("a", dt.date(2024, 1, k), k) for k in (1, 2, 3)], "vendor_id string, score_date date, trust_score long").selectExpr("*", "'GOOD' as risk_level", "0L as behavioral_penalty", "0L as risk_penalty", "0L as total_penalty", "0L as anomaly_alert_count", "0L as velocity_alert_count", "0L as duplicate_alert_count", "0L as total_alert_count")
    store.append(df, "vendor_trust_scores")
    held = store.read("vendor_trust_scores", since=dt.date(2024, 1, 3))
    assert held.count() == 1 and "PartitionFilters: [isnotnull(day" in held._jdf.queryExecution().toString()
    store.upsert(df.where("trust_score = 3").withColumn("trust_score", F.lit(9)), "vendor_trust_scores")
    assert sorted(r[0] for r in store.read("vendor_trust_scores", since=dt.date(2024, 1, 1)).select("trust_score").collect()) == [1, 2, 9]


def test_a_feed_without_event_ids_twice_gives_the_same(spark, tmp_path):
    rows = [{k: v for k, v in r.items() if k != "event_uuid"} | {"bank_account_details": "DE00 1234"} for r in fixtures.invoices(20)]
    broken = (*fixtures.BAD_INVOICES, '{"invoice_id": "I", "bank_account_details": "DE00 \\" 99", "po_no": ')
    erp = fixtures.write_lines(str(tmp_path / "erp.jsonl"), rows, broken)
    store = Store(spark, str(tmp_path / "store"))
    first, again = (batch.run_batch(spark, store, erp, None, tables.seed_baseline(spark), Config(), F.col("invoice_timestamp")) for _ in range(2))
    assert first == again and first["dead_letter"] == len(broken) and first["bronze_raw_events"] == len({str(r) for r in rows})
    kept = store.read("dead_letter").collect()
    assert {r["raw"]: r["err"] for r in kept if r["raw"] in fixtures.BAD_INVOICES} == fixtures.BAD_INVOICES
    assert not any("DE00" in r["raw"] or "99" in r["raw"] for r in kept) and not list((tmp_path / "store").glob("_*"))


def test_missing_rows_are_looked_for_in_their_days_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    row = lambda i, day, start=None: (i, "v", "ANOMALY", "HIGH", 1, start, dt.datetime(2024, 1, day))
    made = lambda *rows: spark.createDataFrame(rows, "invoice_id string, vendor_id string, rule_name string, severity string, fraud_score long, window_start timestamp, detected_at timestamp")
    for _ in range(2):
        store.insert_missing(made(row("a", 1), row("a", 1), row("b", 1, dt.datetime(2024, 1, 1)), row("b", 1)), "gold_fraud_alerts")
    assert store.read("gold_fraud_alerts").count() == 3
    store.insert_missing(made(row("a", 3)), "gold_fraud_alerts", 2)
    assert store.read("gold_fraud_alerts").count() == 3
    store.insert_missing(made(row("a", 3)), "gold_fraud_alerts", 1)
    store.insert_missing(made(row("a", 9)), "gold_fraud_alerts", None)
    store.insert_missing(made(), "gold_fraud_alerts")
    assert store.read("gold_fraud_alerts").count() == 4


def test_jdbc_there_and_back(spark, tmp_path):
    url, store = "jdbc:derby:memory:tallybrook;create=true", Store(spark, str(tmp_path))
    try:
        spark._jvm.java.sql.DriverManager.getConnection(url).close()
    except Exception:
        pytest.skip("no Derby driver")
    seed = tables.seed_baseline(spark)
    short = {"createTableColumnTypes": "vendor_id VARCHAR(64)"}  # Derby does not compare the long texts that it would get
    for _ in range(2):
        store.write_jdbc(seed, url, "vendor_90day_baseline", ["vendor_id"], **short)
    store.write_jdbc(seed.withColumn("vendor_id", F.concat("vendor_id", F.lit("x"))).union(seed), url, "vendor_90day_baseline", ["vendor_id"], batch=2, **short)
    found = tables.jdbc_baseline(spark, url, partitionColumn='"avg_daily_invoice_cnt"', lowerBound="0", upperBound="40", numPartitions="3")
    assert found.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, seed.drop("refreshed_at").union(seed.drop("refreshed_at").withColumn("vendor_id", F.concat("vendor_id", F.lit("x")))).collect()))
    store.write_jdbc(seed.select("vendor_id"), url, "plain")
    store.write_jdbc(seed.select("vendor_id"), url, "plain")
    assert spark.read.format("jdbc").options(url=url, dbtable="plain").load().count() == 10


def test_a_missing_required_column_raises(spark):
    with pytest.raises(ValueError, match="vendor_id"):
        conform(spark.range(1).withColumnRenamed("id", "x"), "gold_fraud_alerts")
    assert all(k in layer.schema.fieldNames() for layer in LAYERS.values() for k in layer.key)


def test_rolling_by_running_sums_is_that_of_windows(spark, tmp_path):
    """Ten nights, one of them with days that came late, one vendor with gaps: the same columns as by windows over all days; on a plain night only the new day is written."""
    rng, store = random.Random(3), Store(spark, str(tmp_path / "store"))
    start, last = dt.date(2024, 1, 1), 45
    day = lambda k: start + dt.timedelta(k)
    behave = [(v, day(k), rng.randint(1, 9), Decimal(rng.randint(100, 99_999)) / 100) for v in "abc" for k in range(last) if v != "c" or k % 3]
    risk = [(v, d, rng.randint(0, 2), rng.randint(0, 3)) for v, d, *_ in behave if rng.random() < 0.8]
    late = {day(20), day(21)}

    def put(test) -> None:
        some = [r for r in behave if test(r[1])]
        df = spark.createDataFrame(some, "vendor_id string, feature_date date, invoice_count long, avg_invoice_amount decimal(15,2)")
        df = df.selectExpr("*", "avg_invoice_amount as total_invoice_amount", "avg_invoice_amount as min_invoice_amount", "avg_invoice_amount as max_invoice_amount", "1.0D as avg_invoices_per_hour")
        store.upsert(df, "vendor_daily_behavioral_features")
        df = spark.createDataFrame([r for r in risk if test(r[1])], "vendor_id string, feature_date date, anomaly_alert_count long, velocity_alert_count long")
        store.upsert(df.selectExpr("*", "0L as duplicate_alert_count", "anomaly_alert_count + velocity_alert_count as total_alert_count"), "vendor_daily_risk_features")

    put(lambda d: d < day(36) and d not in late)
    for night in range(10):
        at = day(35 + night)
        if night:
            put(lambda d, at=at: d == at)
        if night == 6:
            put(lambda d: d in late)
        cfg = Config(as_of=at)
        began = time.time()
        batch.nightly_rolling(store, cfg)
        if night == 3:
            written = {p.parent.name for p in (tmp_path / "store" / "vendor_daily_behavioral_features").rglob("*.parquet") if p.stat().st_mtime >= began}
            assert written == {f"day={at}"}
    read = lambda layer: store.read(layer, since=start)
    cfg, kept = Config(as_of=day(last - 1)), read("vendor_daily_behavioral_features")
    names = ["vendor_id", "feature_date", "invoice_count_7d", "invoice_count_30d", "avg_invoice_amount_7d", "avg_invoice_amount_30d"]
    want = features.rolling_behavioral(kept.select("vendor_id", "feature_date", "invoice_count", "avg_invoice_amount"), cfg)
    assert sorted(map(tuple, kept.select(*names).collect())) == sorted(map(tuple, want.select(*names).collect())) and kept.count() == len(behave)
    kept = read("vendor_daily_risk_features")
    names = ["vendor_id", "feature_date", "anomaly_alert_count_30d", "velocity_alert_count_30d", "total_alert_count_30d"]
    want = features.rolling_risk(kept.select("vendor_id", "feature_date", "anomaly_alert_count", "velocity_alert_count", "total_alert_count"), cfg)
    assert sorted(map(tuple, kept.select(*names).collect())) == sorted(map(tuple, want.select(*names).collect())) and kept.where("high_risk_alert_ratio is null").count() == 0


def _spoil(folder) -> None:
    for p in folder.glob("*.parquet"):
        p.write_bytes(b"no parquet")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)


def test_an_upsert_reads_its_days_alone_and_what_cannot_be_read_raises(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    made = lambda *days: spark.createDataFrame([("a", dt.date(2024, 1, k), k) for k in days], "vendor_id string, score_date date, trust_score long").selectExpr("*", "'GOOD' as risk_level", *(f"0L as {c}" for c in ("behavioral_penalty", "risk_penalty", "total_penalty", "anomaly_alert_count", "velocity_alert_count", "duplicate_alert_count", "total_alert_count")))
    store.append(made(1, 2, 3), "vendor_trust_scores")
    _spoil(tmp_path / "vendor_trust_scores" / "day=2024-01-01")
    store.upsert(made(3).withColumn("trust_score", F.lit(9)), "vendor_trust_scores")
    assert [r[0] for r in store.read("vendor_trust_scores", since=dt.date(2024, 1, 2)).orderBy("score_date").select("trust_score").collect()] == [2, 9]
    with pytest.raises(Exception, match="(?i)parquet"):
        store.read("vendor_trust_scores", since=dt.date(2024, 1, 1)).collect()
    with pytest.raises(Exception, match="(?i)parquet"):  # not taken for an empty layer and written over
        store.upsert(made(1), "vendor_trust_scores")


def test_a_batch_reads_and_writes_the_days_it_touches(spark, tmp_path):
    """Alerts and features of other days are not looked at: they could not be read."""
    store, base = Store(spark, str(tmp_path / "store")), tables.seed_baseline(spark)
    first = fixtures.write_lines(str(tmp_path / "a.jsonl"), fixtures.invoices(40))
    later = [r | {"invoice_id": f"L{k}", "event_uuid": f"l{k}"} for k, r in enumerate(fixtures.invoices(40, fixtures.START + dt.timedelta(30)))]
    second = fixtures.write_lines(str(tmp_path / "b.jsonl"), later)
    batch.run_batch(spark, store, first, None, base, Config())
    for layer in ("gold_fraud_alerts", "vendor_daily_behavioral_features", "vendor_daily_risk_features"):
        _spoil(tmp_path / "store" / layer / "day=2024-01-01")
    batch.judged(store, _parsed(spark, second), base, Config())  # nothing of it is in silver yet: no alerts
    with pytest.raises(Exception, match="(?i)parquet"):
        batch.judged(store, _parsed(spark, first), base, Config())


def _parsed(spark, path):
    return jsonl.split_ok(jsonl.parse_erp(jsonl.read_lines(spark, path)))[0]
