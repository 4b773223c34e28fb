"""Velocity as a stream with state of its own: members by slices of time, a group given out once, when the watermark has passed its window."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallybrook.config import Config
from tallybrook.functions.columns import amount_key


class Bursts(StatefulProcessor):
    """For a vendor and an amount: the invoices of each slice of time, of which windows are made, and the end of the next window to look at.

    A row is put into its slice alone, however many windows overlap, and the windows are looked at when they are over. A slice goes as soon as no open window holds it, so state
    has (window + lateness) / slice entries of a key at most, and one timer. Rows of windows that are over are left out of them."""

    def __init__(self, window: int, slide: int, least: int) -> None:
        self.window, self.slide, self.least = window, slide, least
        self.unit = math.gcd(window, slide)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        members = T.StructType([T.StructField("times", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(T.StringType()))])
        self.slices = handle.getMapState("slices", T.StructType([T.StructField("start", T.LongType())]), members)
        self.next = handle.getValueState("next", T.StructType([T.StructField("end", T.LongType())]))

    def first_end(self, start: int, after: int) -> int:
        """The end of the first window that holds the slice from ``start`` on and is open after the second ``after``."""
        off = self.window % self.slide
        return max((start - self.window) // self.slide * self.slide + self.slide + self.window, (after - off) // self.slide * self.slide + self.slide + off)

    def due(self, end: int) -> None:
        self.next.update((end,))
        self.handle.registerTimer(end * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        new: dict[int, tuple[list[int], list[str]]] = {}
        for r in rows:
            start = r["at"] // 1_000_000 // self.unit * self.unit
            times, ids = new.setdefault(start, ([], []))
            times.append(r["at"])
            ids.append(r["invoice_id"])
        ends = []
        for start, (times, ids) in new.items():
            end = self.first_end(start, passed)
            if end - self.window > start:
                continue  # every window of the slice is over
            held = self.slices.getValue((start,)) if self.slices.containsKey((start,)) else ([], [])
            self.slices.updateValue((start,), ([*held[0], *times], [*held[1], *ids]))
            ends.append(end)
        if ends:
            held = self.next.get()[0] if self.next.exists() else None
            if held is None or min(ends) < held:
                if held is not None:
                    self.handle.deleteTimer(held * 1000)
                self.due(min(ends))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.next.exists():
            return
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        end = self.next.get()[0]
        slices = {k[0]: (v[0], v[1]) for k, v in self.slices.iterator()}
        gone: list[int] = []
        while slices and end <= passed:
            inside = [s for s in sorted(slices) if end - self.window <= s < end]
            if sum(len(slices[s][0]) for s in inside) >= self.least:
                members = sorted((at, i) for s in inside for at, i in zip(*slices[s], strict=True))
                yield Row(vendor_id=key[0], amount=key[1], end=end, times=[at for at, _ in members], ids=[i for _, i in members])
            for s in [s for s in slices if s < end + self.slide - self.window]:
                gone.append(s)
                del slices[s]
            if slices:
                end = max(end + self.slide, self.first_end(min(slices), end))
        for s in gone:
            self.slices.removeKey((s,))
        if slices:
            self.due(end)
        else:
            self.next.clear()

    def close(self) -> None:
        pass


def velocity_stream(invoices: DataFrame, cfg: Config, ts: str = "invoice_timestamp", watermarked: bool = False) -> DataFrame:
    """Groups of like amounts in sliding windows, each once, complete, when the watermark has passed its window. Needs the RocksDB state store (use_rocksdb).

    Rows without a vendor, an amount or a time are in no group."""
    rows = invoices if watermarked else invoices.withWatermark(ts, f"{cfg.lateness} seconds")
    rows = rows.withColumn("amount", amount_key(F.col("invoice_amount"), cfg.amount_step)).where(f"amount is not null and vendor_id is not null and {ts} is not null")
    rows = rows.select("vendor_id", "amount", ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), F.coalesce("invoice_id", F.lit("")).alias("invoice_id"))
    kinds = {f.name: f.dataType for f in rows.schema}
    out = T.StructType([T.StructField("vendor_id", kinds["vendor_id"]), T.StructField("amount", kinds["amount"]), T.StructField("end", T.LongType()), T.StructField("times", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(T.StringType()))])
    found = rows.groupBy("vendor_id", "amount").transformWithState(Bursts(cfg.window, cfg.slide, cfg.min_repeats), out, "Append", "EventTime")
    moment = lambda c: F.timestamp_micros(c * 1_000_000)
    members = F.transform(F.arrays_zip("times", "ids"), lambda m: F.struct(F.timestamp_micros(m["times"]).alias("invoice_timestamp"), m["ids"].alias("invoice_id")))
    return found.select(
        moment(F.col("end") - cfg.window).alias("window_start"), moment(F.col("end")).alias("window_end"), "vendor_id", "amount", F.size("ids").cast("long").alias("occurrences"),
        F.col("ids").alias("invoice_ids"), members.alias("members"),
    )
