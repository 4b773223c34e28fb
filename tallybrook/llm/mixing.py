"""Mixing sources to target weights by systematic sampling, with DataFrame operations only.

Within a source all documents expect the same number of copies, target / size of the source, so the prefix sum of expected copies at a
document is its rank times that rate. Ranks over a source that holds any share of all rows come in two levels: documents are put
into chunks by (source, size class, hash), a window numbers each chunk, and a running sum over the chunk counts moves them.
One random offset a source is added, and a document is emitted once for each integer boundary crossed. As the order is one of sizes, the
words taken stay near the target whatever the offset: they miss it by about the largest document at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import fresh_name, is_numbered, materialise, n_words, numbered, row_column, row_id, row_name, small

#: Repeating weights of the sources in order, the share of all sizes that is taken, and the most copies of a document.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: A chunk's rows: all rows by CHUNKS, within these bounds.
CHUNKS, CHUNK_ROWS = 8192, (200, 100_000)


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words to take from each source: its weight's part of share x all sizes, at most ``most`` times its size; what is above goes to the others
    by weight until none is above. Sources in code point order, null last. A source without words has target 0."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        by_weight = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if by_weight * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: by_weight * weight[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: row, id, source, size, source_size, target, copies, taken.

    Size: words of the text, null and empty: 0. The same rows give the same copies whatever their partitions: order within a source
    is by size class, chunk, size, hash of id and text, id; fully equal rows are alike. A null source is a source of its own, and a source without words takes nothing. No
    rows: no rows. row: its number, where docs was numbered() before; else a number for this scan alone.

    One row a source reaches the driver, for the targets."""
    row = row_column(docs) if is_numbered(docs) else row_id()
    light = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    light = materialise(spark, light.withColumn("class", F.floor(2 * F.log2(F.col("size") + 1)).cast("int")), "mix-sizes")
    held = light.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()
    total, sizes = sum(r["n"] for r in held), {r["source"]: r["words"] for r in held}
    target = targets(sizes, weights, share, most)
    per_chunk = min(CHUNK_ROWS[1], max(CHUNK_ROWS[0], total // CHUNKS))
    sources = spark.createDataFrame([(s, sizes[s], target[s]) for s in sizes], "source string, source_size long, target double")
    chunks = light.groupBy("source", "class").agg(F.ceil(F.count("*") / per_chunk).cast("int").alias("parts"))  # some thirty rows a source
    plan = chunks.alias("c").join(small(sources, len(sizes)).alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.*", "source_size", "target")
    plan = materialise(spark, plan, "mix-plan")
    on = F.col("l.source").eqNullSafe(F.col("p.source")) & (F.col("l.class") == F.col("p.class"))
    rows = light.alias("l").join(small(plan, plan.count()).alias("p"), on)
    rows = rows.select("row", "id", "l.source", "size", "h", "l.class", "source_size", "target", F.pmod("h", "parts").alias("part"))
    chunk = ["source", "class", "part"]
    counts = rows.groupBy(*chunk).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = materialise(spark, counts.select(*chunk, before.alias("before")), "mix-chunks")
    placed = rows.withColumn("k", F.row_number().over(Window.partitionBy(*chunk).orderBy("size", "h", "id")))
    same = F.col("n.source").eqNullSafe(F.col("m.source")) & (F.col("n.class") == F.col("m.class")) & (F.col("n.part") == F.col("m.part"))
    ranked = placed.alias("n").join(small(moved, moved.count()).alias("m"), same).select("n.*", (F.col("before") + F.col("k")).alias("rank"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("source")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    crossed = F.floor(F.col("rank") * rate + offset) - F.floor((F.col("rank") - 1) * rate + offset)
    copies = F.least(crossed, F.lit(int(most))).cast("long")
    return ranked.select("row", "id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows that the mix takes, with all their columns, each as often as it is taken. Null and empty texts have no words: they are taken at their source's rate.
    Repeated rows are rows of their own. No rows: no rows."""
    docs = numbered(spark, docs)
    row, copies, again = row_name(docs), fresh_name(docs, "copies"), fresh_name(docs, "again")
    taken = materialise(spark, mix(spark, docs).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies)), "mix-taken")
    held = docs.join(small(taken, taken.count()), row)
    return held.withColumn(again, F.explode(F.array_repeat(F.lit(True), F.col(copies).cast("int")))).drop(row, copies, again)
