from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallybrook.config import Config
from tallybrook.operators import daily, features

CFG = Config(as_of=dt.date(2024, 3, 1))


@pytest.fixture(scope="module")
def invoices(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [(str(k), rng.choice("abc"), round(rng.lognormvariate(5, 1), 2), start + dt.timedelta(minutes=4 * k)) for k in range(20_000)]
    rows += [("x", None, 5.0, start), ("y", "a", None, start), ("z", "one", 7.25, start), ("old", "a", 1e6, start - dt.timedelta(days=400))]
    return spark.createDataFrame(rows, "invoice_id string, vendor_id string, amount double, invoice_timestamp timestamp_ntz").withColumn("invoice_amount", F.col("amount").cast("decimal(15,2)")).cache()


def test_baseline_of_days_is_that_of_invoices(spark, invoices):
    """Means, deviations and counts are exact; the percentile's rank is off by RANK_ERROR at most, and exact for few invoices."""
    found = {r["vendor_id"]: r for r in daily.baseline(daily.vendor_days(invoices.where("invoice_amount is not null")), CFG).collect()}
    want = {r["vendor_id"]: r for r in features.baseline(invoices.where("invoice_amount is not null"), CFG).collect()}
    assert set(found) == set(want) == {"a", "b", "c", "one"}
    values = defaultdict(list)
    for r in invoices.where("vendor_id is not null and invoice_amount is not null and invoice_id <> 'old'").collect():
        if r["invoice_timestamp"].date() <= CFG.as_of:
            values[r["vendor_id"]].append(float(r["invoice_amount"]))
    for v, r in found.items():
        assert (r["avg_invoice_amount"], r["stddev_invoice_amount"], r["avg_daily_invoice_cnt"]) == tuple(want[v][c] for c in ("avg_invoice_amount", "stddev_invoice_amount", "avg_daily_invoice_cnt"))
        assert r["n"] == len(values[v]) and abs(float(r["stddev_invoice_amount"]) - statistics.pstdev(values[v])) < 0.01
        p99 = float(r["p99_invoice_amount"])
        assert sum(x < p99 for x in values[v]) / len(values[v]) <= 0.99 + daily.RANK_ERROR and sum(x <= p99 for x in values[v]) / len(values[v]) >= 0.99 - daily.RANK_ERROR
    assert float(found["one"]["p99_invoice_amount"]) == 7.25


def test_bitmaps_count_distinct_ids_over_hours(spark, tmp_path):
    rng = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"v{rng.randrange(300)}", f"i{rng.randrange(90_000)}", rng.choice(["VELOCITY", "ANOMALY"]), rng.choice(["HIGH", "CRITICAL"]), rng.randrange(101), start + dt.timedelta(minutes=rng.randrange(600))) for _ in range(60_000)]
    alerts = spark.createDataFrame(rows, "vendor_id string, invoice_id string, rule_name string, severity string, fraud_score long, detected_at timestamp_ntz").cache()
    at = iter(range(100))

    def write(df):
        path = str(tmp_path / f"t{next(at)}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    numbers = {k: daily.numbered(alerts.select(F.col(k).alias("id")), write) for k in ("vendor_id", "invoice_id")}
    held = [r["number"] for r in numbers["invoice_id"].collect()]
    assert sorted(held) == list(range(len({r[1] for r in rows}))) and len(held) > 32_768  # more than one bitmap
    bits = write(daily.alert_bits(alerts, numbers))
    found = {(r["rule_name"], r["severity"], r["kind"]): r["n"] for r in daily.distinct(bits, "rule_name", "severity").collect()}
    want = defaultdict(set)
    for v, i, rule, severity, *_ in rows:
        want[rule, severity, "vendor_id"].add(v)
        want[rule, severity, "invoice_id"].add(i)
    assert found == {k: len(x) for k, x in want.items()}
    hour = {(r["hour_bucket"], r["kind"]): r["n"] for r in daily.distinct(bits, "hour_bucket").collect()}
    assert hour[start, "vendor_id"] == len({r[0] for r in rows if r[5] < start + dt.timedelta(hours=1)})
    plan = daily.distinct(bits, "rule_name")._jdf.queryExecution().executedPlan().toString()
    assert "invoice_id" not in plan and "number" not in plan


def test_scores_of_hours_are_those_of_alerts(spark):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = [("VELOCITY", "HIGH", rng.choice([10, 20, 70, 100, -5, 101]), start + dt.timedelta(minutes=rng.randrange(3000))) for _ in range(9000)]
    alerts = spark.createDataFrame(rows, "rule_name string, severity string, fraud_score long, detected_at timestamp_ntz")
    r = daily.alert_hours(alerts).agg(F.sum("alerts"), F.sum("score_sum"), F.sum("invalid"), F.kll_merge_agg_bigint("sketch").alias("s")).select("*", *(F.kll_sketch_get_quantile_bigint("s", F.lit(p)) for p in (0.5, 0.9))).first()
    scores = [x[2] for x in rows]
    assert r[:3] == (len(rows), sum(scores), sum(not 0 <= s <= 100 for s in scores))
    for value, share in ((r[4], 0.5), (r[5], 0.9)):
        assert sum(s < value for s in scores) / len(rows) <= share + daily.RANK_ERROR and sum(s <= value for s in scores) / len(rows) >= share - daily.RANK_ERROR
