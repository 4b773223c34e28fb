"""Exact dedup by an extendible-hash index on shared files, with DataFrame operations only.

A scan writes one light entry a row: its id, a 64-bit key and the SHA-256 of its normalised text. Distinct keys, counted before they are
shuffled, fill buckets by their leading bits. The directory starts with one bucket and doubles until no bucket holds more than
``capacity`` distinct keys; copies share a key, so a large group of copies never overfills a bucket. Buckets are key ranges, and the
index is written in their order, a bucket in one file.

Rows whose key is alone in its bucket need no comparison. Texts of all others go to the task that owns their bucket, which walks its keys in order
and chains the rows of a key by comparing whole normalised texts. Before that, keys with very many rows are dealt out to several parts of
their bucket, where equal texts become one link. Links are written with their members, and the owner meets the links alone, a few for each key; members are joined to
what it finds by their link's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import fresh_name, materialise, normalised, row_id, small

#: Distinct keys that a bucket may hold.
CAPACITY = 4096
#: Rows of a key that one part of its bucket gets.
PART_ROWS = 1000


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, sha) of every row; key: XXH64 of the normalised text, sha: its SHA-256 in hex."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return texts.select("id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("sha"))


def directory(keys: DataFrame, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Buckets as (prefix, local depth), in key order, for distinct ``key``s. One bucket at first; an overfull one splits by its next bit,
    and the directory doubles when such a bucket was as deep as the directory. Holds about rows/capacity entries."""
    counts: dict[int, int] = {0: keys.count()}
    done, depth = [], 0
    while counts:
        full = {p for p, n in counts.items() if n > capacity and depth < 62}
        done += [(p, depth) for p in counts if p not in full]
        if not full:
            break
        step = min(62 - depth, max(1, max(counts[p] for p in full).bit_length() - capacity.bit_length() + 1))
        fine = keys.groupBy(_prefix(depth + step).alias("p")).agg(F.count("*").alias("n"))
        if depth:
            fine = fine.where(F.shiftright("p", step).isin(list(full)))
        held = {r["p"]: r["n"] for r in fine.collect()}
        for k in range(step):  # level by level, so that a bucket is not split further than it must be
            below = depth + k + 1
            counts = {}
            for p in full:
                for child in (2 * p, 2 * p + 1):
                    shift = step - k - 1
                    counts[child] = sum(held.get((child << shift) + i, 0) for i in range(1 << shift))
            full = {p for p, n in counts.items() if n > capacity}
            if k + 1 < step:
                done += [(p, below) for p in counts if p not in full]
                if not full:
                    return _in_order(done)
        depth += step
    return _in_order(done)


def _in_order(buckets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return sorted(buckets, key=lambda b: b[0] << (62 - b[1]))


def _prefix(depth: int) -> F.Column:
    """The key's first bits below its sign and top bit: 62 are used, so that prefixes stay positive."""
    return F.shiftright(F.col("key").bitwiseAND(F.lit((1 << 62) - 1)), 62 - depth)


def bucketed(spark: SparkSession, keys: DataFrame, buckets: list[tuple[int, int]]) -> DataFrame:
    """keys with their ``bucket``, by way of a directory of 2**global depth cells that name the buckets; a key whose cell names none is lost."""
    deepest = max(d for _, d in buckets)
    if not deepest:
        return keys.withColumn("bucket", F.lit(0))
    cells = [((p << (deepest - d)) + i, b) for b, (p, d) in enumerate(buckets) for i in range(1 << (deepest - d))]
    table = spark.createDataFrame(cells, "cell long, bucket int")
    return keys.withColumn("cell", _prefix(deepest)).join(small(table, len(cells)), "cell").drop("cell")


def build_index(spark: SparkSession, keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The written index (bucket, key, n_rows) of keys (key), one row for each row of the data: in the order of buckets and keys, each bucket in one file."""
    counts = materialise(spark, keys.groupBy("key").agg(F.count("*").alias("n_rows")), "dedup-keys")
    index = bucketed(spark, counts, directory(counts, capacity))
    return materialise(spark, index.repartitionByRange("bucket").sortWithinPartitions("bucket", "key"), "dedup-index")


def chained(spark: SparkSession, docs: DataFrame, index: DataFrame, id_col: str, text_col: str, payload: list[str]) -> DataFrame:
    """(bucket, n, keep, first, members, sha, payload), one row a link of a chain: of the rows of docs whose key several rows have, those with equal texts in a part of their bucket. n and keep
    (last, id, row) are those of the whole chain; members: the link's ids and rows, about PART_ROWS; payload: the named columns of the link's first row."""
    several = index.where("n_rows > 1").select("bucket", "key", F.ceil(F.col("n_rows") / PART_ROWS).cast("int").alias("parts"))
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"))
    texts = docs.select(row_id().alias("row"), F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"), F.struct(*payload).alias("payload") if payload else F.lit(True).alias("payload"))
    met = texts.withColumn("key", F.xxhash64("norm")).join(small(several, several.count()), "key")
    met = met.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).repartition("bucket", "part")
    of_link = [F.count("*").alias("k"), F.min(order).alias("first"), F.min_by("payload", order).alias("payload"), F.collect_list(F.struct("id", "row")).alias("members")]
    links = materialise(spark, met.groupBy("bucket", "part", "key", "norm").agg(*of_link).withColumn("link", row_id()), "dedup-links")
    # the owner of a bucket: in order of its keys, and within a key of the bytes of its texts
    chain = Window.partitionBy("bucket", "key", "norm")
    owned = links.select("link", "bucket", "key", "norm", "k", "first").repartition("bucket")
    owned = owned.select("link", "bucket", F.sum("k").over(chain).alias("n"), F.min("first").over(chain).alias("keep"), F.sha2("norm", 256).alias("sha"))
    return materialise(spark, owned, "dedup-owned").join(links.select("link", "first", "members", "payload"), "link").drop("link")


def exact_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256, bucket.

    Texts are equal when their bytes are equal once each run of white space is one space; null counts as the empty text. The
    row with the smallest id stays; a null id comes after all others, and of rows with the same id one stays. No rows: no rows.
    Other columns of docs are not read, whatever their names."""
    rows = materialise(spark, entries(docs, id_col, text_col), "dedup-entries")
    index = build_index(spark, rows.select("key"), capacity)
    alone = rows.join(index.where("n_rows = 1"), "key")
    alone = alone.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "bucket")
    links = chained(spark, docs, index, id_col, text_col, []).drop("payload")
    members = links.select(F.explode("members").alias("m"), "keep", "n", "sha", "bucket")
    members = members.select("m.id", F.col("keep.id").alias("keep_id"), F.col("n").cast("long").alias("group_size"), (F.col("m.row") == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"), "bucket")
    return alone.union(members)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows of docs that stay, with all their columns: of rows with equal texts, as in exact_groups(), the one with the smallest id. No rows: no rows."""
    index = build_index(spark, docs.select(F.xxhash64(normalised(F.col(text_col))).alias("key")), capacity)
    key = fresh_name(docs, "key")
    several = index.where("n_rows > 1").select(F.col("key").alias(key))
    keyed = docs.withColumn(key, F.xxhash64(normalised(F.col(text_col))))
    stay = keyed.join(small(several, several.count()), key, "left_anti").drop(key)
    links = chained(spark, docs, index, id_col, text_col, docs.columns).where(F.col("first") == F.col("keep")).select("payload")
    return stay.union(links.select("payload.*"))
