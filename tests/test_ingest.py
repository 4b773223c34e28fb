from __future__ import annotations

import datetime as dt
import hashlib
import json
import random
import re

from pyspark.sql import functions as F

from tallybrook.operators import dedup, layers
from tallybrook.sources import fixtures, jsonl, tables


def test_bad_invoice_lines_are_dead_letters_with_a_reason(spark, tmp_path):
    path = fixtures.write_lines(str(tmp_path / "erp.jsonl"), fixtures.invoices(20), tuple(fixtures.BAD_INVOICES))
    good, bad = jsonl.split_ok(jsonl.parse_erp(jsonl.read_lines(spark, path)))
    assert {r["raw"]: r["err"] for r in bad.collect()} == fixtures.BAD_INVOICES
    assert good.count() == int(0.85 * 20) + 28
    assert "raw" not in good.columns and not any("bank_account_details" in c for c in good.columns)


def test_coercions(spark):
    base = {"invoice_id": 7, "po_no": "P", "vendor_id": "V", "invoice_amount": "12.5", "invoice_timestamp": "2024-01-01T02:00:00+02:00"}
    other = base | {"invoice_timestamp": "2024-01-01T00:00:00", "bank_account_details": "X", "event_uuid": "u"}
    lines = spark.createDataFrame([(json.dumps(base),), (json.dumps(other),)], "value string")
    rows = jsonl.parse_erp(lines).orderBy("event_uuid").collect()
    assert all(r["err"] is None and r["invoice_id"] == "7" and r["invoice_amount"] == 12.5 and r["invoice_timestamp"] == dt.datetime(2024, 1, 1) for r in rows)
    assert {r["bank_account_hash"] for r in rows} == {hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"X").hexdigest()}
    assert sum(r["event_uuid"] == "u" for r in rows) == 1 and all(r["event_uuid"] for r in rows)


def test_quantities(spark):
    base = {"wh_id": "W", "po_no": "P", "vendor_id": "V", "upc_no": "U", "received_timestamp": "2024-01-01"}
    lines = spark.createDataFrame([(json.dumps(base | {"qty_received": q}),) for q in (7.9, "7", "7.9", "x", 3)], "value string")
    assert [(r["qty_received"], r["err"]) for r in jsonl.parse_wms(lines).collect()] == [(7, None), (7, None), (None, "bad qty_received"), (None, "bad qty_received"), (3, None)]


def test_dedup_with_time_to_live(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = spark.createDataFrame([("a", t(0)), ("a", t(50)), ("a", t(99)), ("a", t(100)), ("a", t(150)), ("b", t(0))], "invoice_id string, invoice_timestamp timestamp")
    found = {(r["invoice_id"], r["invoice_timestamp"]): r["is_duplicate"] for r in dedup.with_ttl(rows, 100).collect()}
    assert found == {("a", t(0)): False, ("a", t(50)): True, ("a", t(99)): True, ("a", t(100)): False, ("a", t(150)): True, ("b", t(0)): False}


def test_dedup_with_time_to_live_of_one_hot_id(spark):
    times = sorted(random.Random(2).choices(range(100_000), k=3000))
    rows = spark.createDataFrame([("hot" if k % 3 else None, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), {"k": k}) for k, t in enumerate(times)], "invoice_id string, invoice_timestamp timestamp, props map<string,int>")
    found = dedup.with_ttl(rows.repartition(5), 70).collect()
    accepted, last = set(), None
    for k, t in enumerate(times):
        if k % 3 and (last is None or t >= last + 70):
            accepted.add(t)
            last = t
    hot = [r for r in found if r["invoice_id"]]
    assert {int((r["invoice_timestamp"] - dt.datetime(2024, 1, 1)).total_seconds()) for r in hot if not r["is_duplicate"]} == accepted
    assert sum(not r["is_duplicate"] for r in hot) == len(accepted) and not any(r["is_duplicate"] for r in found if not r["invoice_id"]) and len(found) == 3000


def test_kafka_options():
    found = jsonl.kafka_options("h:1", "t", "latest", 500, kafka__security__protocol="SSL")
    assert found["startingOffsets"] == "latest" and found["maxOffsetsPerTrigger"] == "500" and found["kafka.security.protocol"] == "SSL" and found["subscribe"] == "t"


def test_messages_are_decoded_and_lines_have_lasting_ids(spark):
    lines = jsonl.decoded(spark.createDataFrame([(bytearray("ä€", "utf-8"),), (None,)], "value binary"))
    assert [r["value"] for r in lines.collect()] == ["ä€", None]
    ids = [r[0] for r in spark.createDataFrame([("x",), ("x",), ("y",)], "raw string").select(jsonl.line_id(F.col("raw"))).collect()]
    assert ids[0] == ids[1] != ids[2] and re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", ids[0])


def test_bronze_of_both_feeds(spark, tmp_path):
    erp = fixtures.write_lines(str(tmp_path / "erp.jsonl"), fixtures.invoices(10))
    wms = fixtures.write_lines(str(tmp_path / "wms.jsonl"), fixtures.receipts(10))
    good, _ = jsonl.split_ok(jsonl.parse_erp(jsonl.read_lines(spark, erp)))
    receipts, _ = jsonl.split_ok(jsonl.parse_wms(jsonl.read_lines(spark, wms)))
    found = {(r[0], r[1]): r[2] for r in layers.bronze(good, receipts).groupBy("source_system", "event_type").count().collect()}
    assert found == {("ERP", "INVOICE"): 36, ("WMS", "RECEIVING"): 10}


def test_baseline_sources(spark, tmp_path):
    assert tables.load_baseline(spark, str(tmp_path / "none")).count() == 0
    seed = tables.seed_baseline(spark)
    seed.write.parquet(str(tmp_path / "base"))
    assert tables.load_baseline(spark, str(tmp_path / "base")).count() == 5
    assert tables.columns_of(spark, {"b": seed}).count() == 6
