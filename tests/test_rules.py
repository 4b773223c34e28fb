from __future__ import annotations

import collections
import datetime as dt
import json

import pytest

from tallybrook.config import Config
from tallybrook.operators import dedup, rules, scores
from tallybrook.operators.features import behavioral
from tallybrook.sources import fixtures, jsonl, tables

CFG = Config()


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    path = fixtures.write_lines(str(tmp_path_factory.mktemp("feed") / "erp.jsonl"), fixtures.invoices(1000))
    good, _ = jsonl.split_ok(jsonl.parse_erp(jsonl.read_lines(spark, path)))
    return dedup.unique(good, "invoice_id", ["invoice_timestamp", "event_uuid"]).cache()


def test_planted_cases(spark, planted):
    assert planted.count() == 875
    alerts = rules.gold(planted, tables.seed_baseline(spark), CFG).collect()
    by = collections.Counter((a["rule_name"], a["severity"]) for a in alerts)
    assert by["ANOMALY", "CRITICAL"] == 7 and by["ANOMALY", "HIGH"] == 2
    assert sorted(a["fraud_score"] for a in alerts if a["rule_name"] == "ANOMALY") == [33, 33, 50, 55, 62, 100, 100, 100, 100]
    burst = [a for a in alerts if a["rule_name"] == "VELOCITY" and a["vendor_id"] == "V-1003"]
    assert 67 <= len(burst) <= 70 and len({a["invoice_id"] for a in burst}) == 7 and max(a["fraud_score"] for a in burst) == 70
    burst = [a for a in alerts if a["rule_name"] == "VELOCITY" and a["vendor_id"] == "V-1001"]
    assert 48 <= len(burst) <= 50 and len({a["invoice_id"] for a in burst}) == 5 and max(a["fraud_score"] for a in burst) == 50
    assert {a["vendor_id"] for a in alerts if a["rule_name"] == "FALLBACK"} == {"V-9001", "V-9002"}
    assert by["FALLBACK", "MEDIUM"] == planted.where("vendor_id like 'V-9%'").count()
    evidence = json.loads(burst[0]["evidence"])
    assert evidence["fraud_pattern"] == "rapid_duplicate_amounts" and evidence["window_duration_seconds"] == 600 and len(evidence["invoice_ids"]) == evidence["occurrences"]


def _score(spark, amounts, baseline):
    rows = spark.createDataFrame([(f"i{k}", "V", float(a), dt.datetime(2024, 1, 1)) for k, a in enumerate(amounts)], "invoice_id string, vendor_id string, invoice_amount double, invoice_timestamp timestamp")
    base = spark.createDataFrame([("V", *baseline)], "vendor_id string, avg_invoice_amount double, stddev_invoice_amount double")
    found = rules.anomaly_alerts(rows, base, CFG).unionByName(rules.fallback_alerts(rows, base, CFG)).collect()
    return {a["invoice_id"]: (a["rule_name"], a["severity"], a["fraud_score"]) for a in found}


def test_thresholds_and_broken_numbers(spark):
    found = _score(spark, [130, 129.9, 150, 70, float("nan"), float("inf")], (100.0, 10.0))
    assert found == {"i0": ("ANOMALY", "HIGH", 30), "i2": ("ANOMALY", "CRITICAL", 50), "i3": ("ANOMALY", "HIGH", 30), "i5": ("FALLBACK", "MEDIUM", 25)}
    assert _score(spark, [5], (100.0, 0.0)) == {"i0": ("FALLBACK", "MEDIUM", 25)}
    assert _score(spark, [500], (0.0, 10.0)) == {"i0": ("FALLBACK", "MEDIUM", 25)}
    assert _score(spark, [5], (None, 10.0)) == {"i0": ("FALLBACK", "MEDIUM", 25)}


def test_empty_baseline_sends_all_to_fallback(spark, planted, tmp_path):
    none = tables.load_baseline(spark, str(tmp_path / "gone"))
    assert rules.fallback_alerts(planted, none, CFG).count() == 875 and rules.anomaly_alerts(planted, none, CFG).count() == 0


def test_behavioral_edges(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("a", 10.0, t), ("b", 10.0, t), ("b", 20.0, t), ("c", 1.0, t), ("c", 3.0, t + dt.timedelta(hours=4))]
    df = spark.createDataFrame([(str(k), *r) for k, r in enumerate(rows)], "invoice_id string, vendor_id string, invoice_amount double, invoice_timestamp timestamp").withColumn("invoice_amount", dt_money())
    found = {r["vendor_id"]: (float(r["stddev_invoice_amount"]), r["avg_invoices_per_hour"]) for r in behavioral(df).collect()}
    assert found == {"a": (0.0, 0.0), "b": (5.0, 2.0), "c": (1.0, 0.5)}


def dt_money():
    from pyspark.sql import functions as F

    return F.col("invoice_amount").cast("decimal(15,2)")


def test_trust_and_ranks(spark):
    d = dt.date(2024, 1, 1)
    rows = [("a", d, 0, 0, 0, 0), ("b", d, 9, 0, 0, 9), ("c", d, 1, 1, 1, 3), ("a", d + dt.timedelta(1), 5, 0, 0, 5), ("c", d + dt.timedelta(1), 0, 0, 0, 0), ("a", d + dt.timedelta(3), 0, 0, 0, 0)]
    df = spark.createDataFrame([(*r, 1, 1.0, 0.0) for r in rows], "vendor_id string, feature_date date, anomaly_alert_count long, velocity_alert_count long, duplicate_alert_count long, total_alert_count long, invoice_count long, avg_invoice_amount double, stddev_invoice_amount double")
    s = scores.trust_scores(df, CFG)
    assert {(r["vendor_id"], r["score_date"].day): (r["trust_score"], r["risk_level"]) for r in s.collect()} == {("a", 1): (100, "EXCELLENT"), ("b", 1): (0, "HIGH"), ("c", 1): (70, "GOOD"), ("a", 2): (25, "HIGH"), ("c", 2): (100, "EXCELLENT"), ("a", 4): (100, "EXCELLENT")}
    ranks = {(r["vendor_id"], r["ranking_date"].day): (r["risk_rank"], r["rank_change"]) for r in scores.rankings(s).collect()}
    assert ranks == {("b", 1): (1, None), ("c", 1): (2, None), ("a", 1): (3, None), ("a", 2): (1, -2), ("c", 2): (2, 0), ("a", 4): (1, None)}
