"""Deterministic feeds with planted cases: duplicates, bursts of one amount, outliers, vendors without a baseline, and malformed lines."""

from __future__ import annotations

import datetime as dt
import json
import random
from pathlib import Path

from tallybrook.sources.tables import SEED_BASELINE

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
UNKNOWN = ("V-9001", "V-9002")


def _invoice(k: int, vendor: str, amount: float, at: dt.datetime, invoice_id: str | None = None) -> dict:
    return {"event_uuid": f"erp-{k:08d}", "invoice_id": invoice_id or f"INV-{k:012d}", "po_no": f"PO-{100000 + k}", "vendor_id": vendor, "invoice_amount": round(amount, 2), "invoice_timestamp": at.isoformat(), "bank_account_details": f"IBAN{k:06d}", "upc_no": "4006381333931", "email_id": "billing@example.com"}


def invoices(n: int, start: dt.datetime = START, seed: int = 42) -> list[dict]:
    """int(0.85 n) normal invoices within 15 % of their vendor's average, then 28 planted ones."""
    rng = random.Random(seed)
    average = {v: float(a) for v, a, *_ in SEED_BASELINE} | dict.fromkeys(UNKNOWN, 800.0)
    vendors, at, out = sorted(average), start, []
    for k in range(int(0.85 * n)):
        v = vendors[rng.randrange(len(vendors))]
        out.append(_invoice(k, v, average[v] * rng.uniform(0.85, 1.15), at))
        at += dt.timedelta(seconds=rng.randint(2, 8))

    # fixed values: amounts on either side of the rules' thresholds for the seed baseline, and the bursts and repeated ids that the tests count
    def plant(vendor: str, amounts: list[float], step: int, invoice_id: str | None = None) -> None:
        nonlocal at
        for a in amounts:
            out.append(_invoice(len(out), vendor, a, at, invoice_id))
            at += dt.timedelta(seconds=step)

    plant("V-1001", [1350.0] * 3, 20, "INV-DUP-1")
    plant("V-1002", [4700.0] * 2, 30, "INV-DUP-2")
    plant("V-1003", [999.99] * 7, 15)
    plant("V-1001", [1500.0] * 5, 12)
    plant("V-1005", [2500.0, 800.0, 500.0, 400.0], 60)
    plant("V-1001", [3000.0, 2100.0, 1800.0], 60)
    plant("V-1003", [2500.0, 1600.0], 60)
    plant("V-9001", [640.0], 60)
    plant("V-9002", [920.0], 60)
    return out


def receipts(n: int, start: dt.datetime = START, seed: int = 43) -> list[dict]:
    rng = random.Random(seed)
    return [{"event_uuid": f"wms-{k:08d}", "wh_id": f"WH-{rng.randint(1, 25):03d}", "po_no": f"PO-{100000 + k}", "vendor_id": f"V-{rng.randint(1001, 1005)}", "upc_no": "4006381333931", "qty_received": rng.randint(1, 500), "received_timestamp": (start + dt.timedelta(seconds=3 * k)).isoformat()} for k in range(n)]


#: Lines that are no good invoices, and why.
BAD_INVOICES = {
    "not json": "not a JSON object",
    '{"po_no": "P", "vendor_id": "V", "invoice_amount": 1, "invoice_timestamp": "2024-01-01"}': "missing invoice_id",
    '{"invoice_id": "I", "po_no": "P", "vendor_id": null, "invoice_amount": 1, "invoice_timestamp": "2024-01-01"}': "missing vendor_id",
    '{"invoice_id": "I", "po_no": "P", "vendor_id": "V", "invoice_amount": "x", "invoice_timestamp": "2024-01-01"}': "bad invoice_amount",
    '{"invoice_id": "I", "po_no": "P", "vendor_id": "V", "invoice_amount": 1, "invoice_timestamp": "soon"}': "bad invoice_timestamp",
}


def write_lines(path: str, rows: list[dict], extra: tuple[str, ...] = ()) -> str:
    Path(path).write_text("\n".join([*map(json.dumps, rows), *extra]) + "\n", encoding="utf-8")
    return path
