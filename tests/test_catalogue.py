from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from tests.oracle import assert_same, connect

from tallybrook.config import Config
from tallybrook.operators import rules
from tallybrook.plans import catalogue, oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert_same(catalogue.queries()[name](spark, SF), con, oracle.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())


def test_the_last_day_is_read_alone(spark):
    x = catalogue.Layers(spark, SF)
    last = x.latest("trust")
    days = {f.rpartition("/")[0].rpartition("=")[2] for f in last.where("trust_score >= 0")._jdf.queryExecution().executedPlan().toString().split() if "day=" in f}
    assert last.select("score_date").distinct().count() == 1 and last.first()["score_date"] == x.trust.agg(F.max("score_date")).first()[0] and len(days) <= 1
    assert "PartitionFilters: [isnotnull(day" in last._jdf.queryExecution().toString()


def test_layers_follow_tables_that_are_written_anew(spark, tmp_path):
    folder = str(tmp_path)
    for name in ("events", "orders"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    before = catalogue.Layers(spark, folder).silver.count()
    half = spark.read.parquet(f"{SF}/events.parquet").where("event_id < 500")
    half.write.mode("overwrite").parquet(f"{folder}/events.parquet")
    spark.catalog.refreshByPath(f"{folder}/events.parquet")
    assert before == 1000 and catalogue.Layers(spark, folder).silver.count() == 500


def test_rank_gaps_are_those_of_a_sorted_day(spark):
    rng, rows, want = random.Random(8), [], 0
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        ranks = sorted(rng.choices(range(1, 40), k=30))
        rows += [(day, r) for r in ranks]
        want += sum(b - a != 1 for a, b in zip(ranks, ranks[1:], strict=False))
    df = spark.createDataFrame(rows, "ranking_date string, risk_rank long")
    assert catalogue.rank_gaps(df).first()[0] == want and catalogue.rank_gaps(df.limit(0)).first()[0] == 0


def test_reports_read_the_days_they_ask_for(spark):
    x = catalogue.Layers(spark, SF)
    plan = x.recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "layers-" in plan
    assert x.recent.count() == x.gold.where(F.to_date("detected_at") >= F.lit(catalogue.SINCE)).count() < x.gold.count()


@pytest.mark.parametrize(("window", "slide"), [(600, 60), (90, 60), (100, 40)])
def test_velocity_against_brute_force(spark, window, slide):
    rng = random.Random(window)
    cfg = Config(window=window, slide=slide)
    rows = [(str(k), rng.choice("ab"), rng.choice([5.0, 7.5]), rng.randrange(2000) * 1_000_000 + rng.randrange(1_000_000)) for k in range(250)]
    df = spark.createDataFrame(rows, "invoice_id string, vendor_id string, invoice_amount double, at long").withColumn("invoice_timestamp", F.timestamp_micros("at"))
    groups: dict = {}
    for i, v, a, at in rows:
        s = at // (slide * 1_000_000) * slide
        while s * 1_000_000 > at - window * 1_000_000:
            groups.setdefault((s, v, a), set()).add(i)
            s -= slide
    want = {k: ids for k, ids in groups.items() if len(ids) >= 3}
    found = rules.velocity_groups(df, cfg).select(F.unix_seconds("window_start").alias("s"), F.unix_seconds("window_end").alias("e"), "vendor_id", "amount", "occurrences", "invoice_ids").collect()
    assert {(r["s"], r["vendor_id"], float(r["amount"])): set(r["invoice_ids"]) for r in found} == want
    assert len(found) == len(want) and all(r["occurrences"] == len(r["invoice_ids"]) and r["e"] - r["s"] == window for r in found)


def test_invariants(spark):
    x = catalogue.Layers(spark, SF)
    assert x.silver.count() == x.silver.select("invoice_id").distinct().count() == x.behavioral.agg({"invoice_count": "sum"}).first()[0]
    assert x.trust.where("trust_score < 0 or trust_score > 100").count() == 0
    assert x.ranks.groupBy("ranking_date").agg({"risk_rank": "max", "vendor_id": "count"}).where("`max(risk_rank)` <> `count(vendor_id)`").count() == 0


def test_z_is_printed_as_the_sql_prints_it(spark):
    baseline = spark.createDataFrame([("a", 27.68, 1.0), ("b", 41.73, 32.88), ("c", 1.2, 0.52), ("d", 0.5, 0.5)], "vendor_id string, avg_invoice_amount double, stddev_invoice_amount double")
    rows = [("1", "a", 54.33), ("2", "a", 3.53), ("3", "b", 214.35), ("4", "c", 145.37), ("5", "d", 617.625)]
    invoices = spark.createDataFrame(rows, "invoice_id string, vendor_id string, invoice_amount double").withColumn("invoice_timestamp", F.timestamp_micros(F.lit(0)))
    of = {"a": (27.68, 1.0), "b": (41.73, 32.88), "c": (1.2, 0.52), "d": (0.5, 0.5)}
    found = {r["invoice_id"]: r["reason"] for r in rules.anomaly_alerts(invoices, baseline, Config()).collect()}
    assert {i: said.partition(" is ")[2].partition("σ")[0] for i, said in found.items()} == {i: f"{abs((x - of[v][0]) / of[v][1]):.1f}" for i, v, x in rows}


def test_all_repeated_ids_are_reported(spark, tmp_path):
    folder = str(tmp_path)
    late = spark.range(183 * 20).select(F.col("id").alias("event_id"), F.lit("2024-01-30 01:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), F.col("id").cast("double").alias("value"), F.lit('{"k": 1}').alias("props"))
    late.write.parquet(f"{folder}/events.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").write.parquet(f"{folder}/orders.parquet")
    assert_same(catalogue.queries()["streaming_duplicates"](spark, folder), connect(folder), oracle.oracle_sql()["streaming_duplicates"])
    assert catalogue.queries()["streaming_duplicates"](spark, folder).count() == 60


@pytest.mark.parametrize(("window", "slide"), [(600, 60), (90, 60), (100, 40), (60, 60)])
def test_members_with_windows_are_the_velocity_alerts(spark, window, slide):
    rng = random.Random(window + slide)
    cfg = Config(window=window, slide=slide)
    rows = [(str(k), rng.choice("ab"), rng.choice([5.0, 7.5, None]), rng.randrange(2000) * 1_000_000 + rng.randrange(1_000_000)) for k in range(300)]
    df = spark.createDataFrame(rows, "invoice_id string, vendor_id string, invoice_amount double, at long").withColumn("invoice_timestamp", F.timestamp_micros("at"))
    members = rules.velocity_members(df, cfg)
    held = rules.velocity_windows(members, cfg)
    amount, size = F.col("amount_key"), F.col("occurrences")
    made = held.select("invoice_id", "vendor_id", rules.velocity_reason(amount, size, cfg), "window_start", "window_end", rules.velocity_score(size), "invoice_timestamp").collect()
    want = rules.velocity_alerts(df, cfg).select("invoice_id", "vendor_id", "reason", "window_start", "window_end", "fraud_score", "invoice_timestamp").collect()
    assert sorted(map(tuple, made)) == sorted(map(tuple, want)) and made
    assert members.count() == members.select("invoice_id").distinct().count() <= 300


def test_gold_says_what_its_evidence_says(spark):
    x = catalogue.Layers(spark, SF)
    names = ["invoice_id", "vendor_id", "rule_name", "severity", "reason", "window_start", "window_end", "fraud_score", "alert_source", "detected_at", *catalogue.FIELDS]
    held, want = x.gold.select(*names), catalogue._with_fields(x.evident).select(*names)
    assert held.schema.simpleString() == want.schema.simpleString()
    assert held.exceptAll(want).count() == want.exceptAll(held).count() == 0 < held.count()


def test_an_alert_does_not_list_its_group_in_the_layers(spark, tmp_path):
    """A burst twice as large takes twice the rows of the layer, and a row is no longer for it."""
    sizes = []
    for n in (400, 800):
        folder = str(tmp_path / str(n))
        rows = spark.range(n).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-30 01:00:00' + make_dt_interval(0, 0, 0, id / 10)").alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit(5.0).alias("value"), F.lit('{"k": 1}').alias("props"))
        rows.write.parquet(f"{folder}/events.parquet")
        spark.read.parquet(f"{SF}/orders.parquet").write.parquet(f"{folder}/orders.parquet")
        x = catalogue.Layers(spark, folder)
        flags = x.since("flags").where("rule_name = 'VELOCITY'")
        sizes.append((flags.count(), flags.select(F.length(F.to_json(F.struct("*"))).alias("n")).agg(F.max("n")).first()[0]))
        assert_same(catalogue.queries()["alerts_by_rule"](spark, folder), connect(folder), oracle.oracle_sql()["alerts_by_rule"])
        assert_same(catalogue.queries()["velocity_alerts"](spark, folder), connect(folder), oracle.oracle_sql()["velocity_alerts"])
    assert [n for n, _ in sizes] == [400, 800] and sizes[1][1] <= sizes[0][1] + 2
