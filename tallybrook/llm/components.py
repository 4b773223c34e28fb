"""Connected components: of few edges in one task, of more by alternating large and small stars; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, materialise


#: Edges that one task may join, 16 bytes each; more go through rounds of stars.
ONE_TASK = 200_000


def labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number in the component of each of 0 to n-1, for edges (i, j)."""
    of = np.arange(n)
    while len(i):
        a, b = of[i], of[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(of, np.maximum(a, b), np.minimum(a, b))
        while (of[of] != of).any():
            of = of[of]
    return of


def components(spark: SparkSession, edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root) for every node of edges (a, b: long); root: the smallest node it reaches. Loops and repeated edges do no harm."""
    edge = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edge = materialise(spark, edge, "edges")
    if edge.count() > one_task:
        return _stars(spark, edge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1) for b in batches]
        names, ends = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *held]), return_inverse=True)
        ends = ends.reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[labels(len(names), ends[:, 0], ends[:, 1])])], ["node", "root"])

    out = materialise(spark, edge.coalesce(1).mapInArrow(run, "node long, root long"), "roots")
    drop_table(spark, edge)
    return out


def _stars(spark: SparkSession, stars: DataFrame) -> DataFrame:
    """components() of written edges (u > v).

    Each round hooks a node's neighbours to the smallest of them, first the larger neighbours, then the smaller ones; the number of
    rounds grows with the logarithm of the nodes. Every round is a written table. Smallest neighbours are found by pre-aggregated
    groups and handed out by an equi-join, which adaptive execution splits where a node has very many."""
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = materialise(spark, small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        drop_table(spark, stars)
        stars = new
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
