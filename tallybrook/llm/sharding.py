"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, with DataFrame operations only.

Every shard has VNODES points on a ring of 64-bit numbers. A row's key stands where its text's hash is, so equal texts stand side by side; the stretch of the ring before a point is that
point's arc. Rows ask the shard at the end of their arc first. A shard that is full turns rows away, and they ask the next point clockwise, until one has room.

Who is turned away depends on counts alone: in each round the arcs ask in the order of the ring, each for its rows that are left, and a shard takes the first of
them, by place on the ring and then by id, as long as it has room. Rows are therefore counted by arc in Spark; the rounds are walked over these counts, of which
there are shards x VNODES at most; and what results is a table of spans of places within arcs, which rows look up by their own place.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import materialise, ranked, row_id

#: Points of a shard on the ring.
VNODES = 128


def points(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard) of all points in the order of the ring; a shard's points don't depend on how many shards there are."""
    at = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big", signed=True)
    return sorted((at(s, v), s) for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may hold. Without slack they add up to the rows, and differ by one at most; with it all have room for so much more than the mean."""
    if slack > 0:
        return [-(-int(rows * (1 + slack) + 1) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def spans(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first place, place after the last, shard, slot of the first) of rows counted by arc."""
    room, taken, given = list(room), [0] * len(room), [0] * len(counts)
    left, out = [a for a, n in enumerate(counts) if n], []
    for step in range(len(owners)):
        for arc in left:
            shard = owners[(arc + step) % len(owners)]
            n = min(room[shard], counts[arc] - given[arc])
            if n:
                out.append((arc, given[arc], given[arc] + n, shard, taken[shard]))
                given[arc], room[shard], taken[shard] = given[arc] + n, room[shard] - n, taken[shard] + n
        left = [a for a in left if given[a] < counts[a]]
        if not left:
            break
    return out


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table, as a value within the plan."""
    names = [c.split()[0] for c in schema.split(", ")]
    held = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(held), f"array<struct<{', '.join(c.replace(' ', ': ') for c in schema.split(', '))}>>")))


def shard(spark: SparkSession, docs: DataFrame, shards: int = 8, slack: float = 0.0, vnodes: int = VNODES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, size (UTF-8 bytes of the text and 1), text_crc32, arc, shard and slot (from 0 in each shard, without gaps).

    Without slack the shards' rows differ by one at most, whatever the keys; a text that is repeated more often than a shard has room goes on clockwise like any other rows. With slack fewer rows leave
    their own shard, and fewer move when shards are added. Null counts as the empty text. Rows of equal text stand in order of id, null first; repeated rows each have a slot, and which of
    them has which is open. An empty table gives no rows. Other columns are not read."""
    if shards < 1 or vnodes < 1 or slack < 0:
        raise ValueError("shards and vnodes must be positive, and slack not negative")
    ring = points(shards, vnodes)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("at"),
        row_id().alias("row"),
    )
    # the ring in equal stretches, each with the number of points before it and the points in it
    stretches = 1 << max(1, (len(ring) - 1).bit_length())
    bits = stretches.bit_length() - 1
    inside: list[list[int]] = [[] for _ in range(stretches)]
    for p, _ in ring:
        inside[(p + (1 << 63)) >> (64 - bits)].append(p)
    before = [0]
    for x in inside:
        before.append(before[-1] + len(x))
    held = _table(spark, [(k, before[k], x) for k, x in enumerate(inside)], "stretch long, before long, points array<long>")
    stretch = F.shiftrightunsigned(F.col("at").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits)
    placed = rows.withColumn("stretch", stretch).join(F.broadcast(held), "stretch")
    placed = placed.withColumn("arc", (F.col("before") + F.size(F.filter("points", lambda p: p < F.col("at")))) % len(ring)).drop("stretch", "before", "points")
    placed = ranked(spark, materialise(spark, placed, "ring"), ["arc"], ["at", "id", "row"], "ring-ranked")
    counts = [0] * len(ring)
    for r in placed.groupBy("arc").agg(F.count("*").alias("n")).collect():  # as many rows as the ring has points at most
        counts[r["arc"]] = r["n"]
    found = spans(counts, [s for _, s in ring], capacities(sum(counts), shards, slack))
    plan = _table(spark, found, "arc long, first long, after long, shard int, slot long").withColumnRenamed("slot", "from")
    mine = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("after"))
    joined = placed.join(F.broadcast(plan.withColumnRenamed("arc", "arc_")), (F.col("arc") == F.col("arc_")) & mine)
    return joined.select("id", "size", "text_crc32", F.col("arc").cast("int").alias("arc"), "shard", (F.col("from") + F.col("place") - F.col("first")).alias("slot"))
