"""Approximate nearest neighbours: a forest of random-projection trees searched through one priority queue, then exact reranking.

The trees' planes are fitted on a bounded sample of rows, chosen by hash, on the driver; every row is indexed. Equal vectors share
one entry, so a very common vector fills no leaf: an entry holds the 2 k smallest ids of its vector, all that k nearest with ties to the
smaller id can ever use; repeated rows count as often as they occur. A query walks all trees through one queue ordered by the smallest distance to a plane crossed on the way, and
takes leaves until they hold enough sample points. Queries meet the entries of their leaves in an equi-join; distances are exact,
in double precision. While few rows are indexed, a query's leaves are all leaves, and the search is exact.

The share of the sample points that a query visits is fixed, so what it measures grows with the rows: vectors without clusters, as the tables' are, cannot be found with
recall 0.9 in a number of candidates that stays the same. README has figures.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import materialise, row_id, short_batches

#: Vectors that planes are fitted on at most, trees, sample points of a leaf at most, and the share of the trees' sample points that a query visits (but at least LEAST_SEEN).
SAMPLE, TREES, LEAF, SEEN, LEAST_SEEN = 16_384, 12, 32, 0.05, 4_000
#: Entries, and queries, of a leaf that are measured at once.
BLOCK = 512


@dataclass
class Tree:
    """Nodes from 0, the root; left and right: children, or -1 and the leaf's number; a plane is normal . x - offset."""

    normal: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray
    points: np.ndarray


def grow(x: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> Tree:
    """A tree over the rows of x: each plane lies halfway between two random rows' projections on their difference; points that no plane parts share a leaf."""
    normal, offset, left, right, points = [], [], [], [], []

    def node() -> int:
        for a, v in ((normal, np.zeros(x.shape[1], np.float32)), (offset, 0.0), (left, -1), (right, -1), (points, 0)):
            a.append(v)
        return len(left) - 1

    todo = [(node(), np.arange(len(x)))]
    leaves = 0
    while todo:
        at, rows = todo.pop()
        side = None
        if len(rows) > leaf:
            for _ in range(5):
                i, j = rng.choice(rows, 2, replace=False)
                way = x[i] - x[j]
                if not way.any():
                    continue
                way = way / np.linalg.norm(way)
                cast = x[rows] @ way
                middle = float(np.median(cast))
                side = cast > middle
                if side.any() and not side.all():
                    break
                side = None
        if side is None:
            left[at], right[at], points[at] = -1, leaves, len(rows)
            leaves += 1
            continue
        normal[at], offset[at] = way, middle
        left[at], right[at] = node(), node()
        todo += [(left[at], rows[~side]), (right[at], rows[side])]
    return Tree(np.array(normal, np.float32), np.array(offset, np.float32), np.array(left), np.array(right), np.array(points))


def leaves_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(len(x), np.int64)
    while (inner := tree.left[at] >= 0).any():
        rows, nodes = np.flatnonzero(inner), at[inner]
        high = np.einsum("ij,ij->i", x[rows], tree.normal[nodes]) > tree.offset[nodes]
        at[rows] = np.where(high, tree.right[nodes], tree.left[nodes])
    return tree.right[at]


def search(forest: list[Tree], q: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of one queue over all trees, until their sample points are enough."""
    queue = [(-np.inf, t, 0) for t in range(len(forest))]
    heapq.heapify(queue)
    out, seen = [], 0
    margins = [tree.normal @ q - tree.offset for tree in forest]
    while queue and seen < enough:
        far, t, at = heapq.heappop(queue)
        tree = forest[t]
        while tree.left[at] >= 0:
            margin = float(margins[t][at])
            near, other = (tree.right[at], tree.left[at]) if margin > 0 else (tree.left[at], tree.right[at])
            heapq.heappush(queue, (max(far, abs(margin)), t, int(other)))
            at = near
        out.append((t, int(tree.right[at])))
        seen += int(tree.points[at])
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with v as array of float, where that is what it is, else of double; without null ids, null, empty or zero vectors, and those with null or non-finite components."""
    v = F.col("v")
    kind = dict(vectors.dtypes)[vector_col]
    kind = kind if kind == "array<float>" else "array<double>"  # what is sent is no longer than what was given
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def few(rows: DataFrame, most: int) -> DataFrame:
    """Distinct vectors among which are the ``most`` with the smallest hashes, and a few more, with their ``hash``. The hashes are counted by their first 16 bits, and vectors beyond the range that holds
    enough stay where they are: a sort with a limit would send the driver that many vectors of each task."""
    hashed = rows.select("v", F.xxhash64("v").alias("hash"))
    span = F.shiftright("hash", 48)
    counts = sorted(hashed.select("hash").distinct().groupBy(span.alias("span")).agg(F.count("*").alias("n")).collect())  # 65,536 rows at most
    before = np.cumsum([r["n"] for r in counts])
    if not len(before) or before[-1] <= most:
        return hashed.distinct()
    return hashed.where(span <= counts[int(np.searchsorted(before, most))]["span"]).distinct()


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 10, query_every: int = 100, trees: int = TREES, sample: int = SAMPLE, seen: float = SEEN, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable row whose id is divisible by query_every its k nearest other rows found, by Euclidean distance
    in double precision, ties to the smaller id. Rows of repeated ids are rows: an id may be found as often as it occurs, but never for its own
    query. Vectors of another length than most (of the sample's first) are not comparable and take no part. No rows: no rows."""
    short_batches(spark)
    rows = usable(vectors, id_col, vector_col)
    picked = [r["v"] for r in few(rows, sample).orderBy("hash").limit(sample).collect()]
    schema = "query_id long, rank int, vec_id long, score double"
    if not picked:
        return spark.createDataFrame([], schema)
    lengths = [len(v) for v in picked]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    x = np.array([v for v in picked if len(v) == dim])
    rng = np.random.default_rng(seed)
    forest = spark.sparkContext.broadcast([grow(x.astype(np.float32), rng) for _ in range(trees)])
    enough = max(LEAST_SEEN, seen * len(x) * trees)
    rows = rows.where(F.size("v") == dim)
    kind = dict(rows.dtypes)["v"]

    # the 2 k smallest ids of each vector, an id k times at most, so that k are left without the query's own: of a run of ids, each task keeps its own smallest before they meet
    counted = rows.groupBy("v", "id").agg(F.least(F.count("*"), F.lit(k)).alias("times")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = counted.withColumn("n", F.row_number().over(Window.partitionBy("v", "salt").orderBy("id"))).where(F.col("n") <= 2 * k)
    each = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", "times"))), lambda x: F.array_repeat(x["id"], x["times"].cast("int"))))
    entries = first.groupBy("v").agg(F.slice(each, 1, 2 * k).alias("ids"))  # at most 64 * 2 k ids meet
    entries = materialise(spark, entries.withColumn("entry", row_id()), "ann-entries")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(-1, dim)
            for t, tree in enumerate(forest.value):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(leaves_of(tree, v.astype(np.float32)).astype(np.int32)), batch.column("v"), batch.column("entry"), batch.column("ids")], ["tree", "leaf", "v", "entry", "ids"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(-1, dim)
            for i, q in zip(batch.column("id").to_pylist(), v, strict=True):
                found = np.array(search(forest.value, q.astype(np.float32), enough), np.int32).reshape(-1, 2)
                again = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * dim), pa.array(np.tile(q, len(found))))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), i)), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy()), again], ["query_id", "tree", "leaf", "q"])

    queries = rows.where(F.col("id") % query_every == 0).dropDuplicates(["id", "v"])
    n_entries, n_queries = entries.count(), queries.count()
    n_leaves = int(np.mean([(tree.left < 0).sum() for tree in forest.value]))
    rows_blocks = 1 + n_entries // n_leaves // BLOCK
    query_blocks = 1 + int(n_queries * enough / (len(x) * trees)) // BLOCK
    leaves = entries.mapInArrow(index, f"tree int, leaf int, v {kind}, entry long, ids array<long>").withColumn("block", F.pmod(F.xxhash64("v"), F.lit(rows_blocks)))
    leaves = leaves.repartition("tree", "leaf").groupBy("tree", "leaf", "block").agg(F.collect_list(F.struct("v", "entry", F.col("ids")[0].alias("least"), F.try_element_at("ids", F.lit(-1)).alias("most"))).alias("held"))
    walks = queries.select("id", "v").mapInArrow(walk, f"query_id long, tree int, leaf int, q {kind}").withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)))
    # a query becomes a row for each of its leaves, which the size of the queries does not tell: no broadcast, which would go through the driver; both sides are dealt by leaf once
    asked = walks.repartition("tree", "leaf").groupBy("tree", "leaf", "part").agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of a leaf's entries against blocks of its queries; of each query its k + 1 nearest entries leave, with ties. Entries of the query's own id alone are not measured."""
        for batch in batches:
            for r in range(batch.num_rows):
                held, asks = batch.column("held")[r].values, batch.column("asked")[r].values
                v, q = (x.flatten().to_numpy().reshape(-1, dim).astype(np.float64) for x in (held.field("v"), asks.field("q")))
                entry, least, last, qids = (x.to_numpy() for x in (held.field("entry"), held.field("least"), held.field("most"), asks.field("query_id")))
                far = _distances(q, v)
                far[(least[None, :] == qids[:, None]) & (last[None, :] == qids[:, None])] = np.inf
                most = np.partition(far, k, 1)[:, k] if len(v) > k + 1 else np.full(len(q), np.inf)
                row, e = np.nonzero((far <= most[:, None]) & (far < np.inf))
                yield pa.RecordBatch.from_arrays([pa.array(qids[row]), pa.array(entry[e]), pa.array(least[e]), pa.array(far[row, e])], ["query_id", "entry", "least", "score"])

    found = asked.hint("merge").join(leaves, ["tree", "leaf"]).select("held", "asked").mapInArrow(measure, "query_id long, entry long, least long, score double")
    once = found.groupBy("query_id", "entry").agg(F.min("least").alias("least"), F.min("score").alias("score"))
    # each entry gives one id at least, and the k nearest rows are in the first k + 1 entries by distance and smallest id; only then do entries become rows again
    near = once.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "least"))).where(F.col("n") <= k + 1)
    rows = near.join(entries.select("entry", "ids"), "entry").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _distances(queries: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of all pairs, squares added up component by component."""
    total = np.zeros((len(queries), len(v)))
    for j in range(v.shape[1]):
        d = queries[:, j, None] - v[None, :, j]
        total += d * d
    return np.sqrt(total)
