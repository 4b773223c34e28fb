"""Merkle manifest of a dataset: a tree of SHA-256 digests for each group of rows, one over the groups' roots, and a proof for every row.

A node's place in its level and the number of rows of its group say how many children its parent has: two, or one at the end of a level of odd length.
Trees grow by events. A digest that becomes known is handed to its parent, which holds the digests of its children by place; when their number meets
the parent's, the parent's own digest becomes known and is handed on. ``combineByKey`` does this for blocks of LEVELS levels: tasks gather what they have of a
block into partial parents, merge those of other tasks after the shuffle, and the tops of blocks, the frontier, are dealt out again as the lowest level of the next blocks.
Four rounds do for 10^12 rows of one group, and no task holds more than blocks of 2^LEVELS rows.

Proofs are made from the top down: a block learns the siblings above its top and walks the links from each of its lowest nodes to its parents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import materialise, ranked, row_id, short_batches

#: Levels of a tree that a block spans.
LEVELS = 10


def digest(*children: bytes) -> bytes:
    """SHA-256 of digests as one hex text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def leaf(*values: Column) -> Column:
    """SHA-256, in hex, of values: each ``-`` if null, else its number of UTF-8 bytes, ``:`` and the value as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def width(n: int, level: int) -> int:
    """Nodes of a level of a tree over n rows."""
    return -(-n >> level) if n else 0


class Partial:
    """What is known of a block: digests by (level, place in the tree), rows by place, and parents that lack children."""

    __slots__ = ("n", "nodes", "rows", "waiting")

    def __init__(self, n: int) -> None:
        self.n, self.nodes, self.rows, self.waiting = n, {}, {}, {}

    def known(self, level: int, at: int, value: bytes) -> None:
        """A digest has become known: hand it to its parent, and on, as long as parents are complete."""
        self.nodes[level, at] = value
        there = width(self.n, level)
        if level == LEVELS or there == 1:
            return
        parent = level + 1, at >> 1
        children = self.waiting.setdefault(parent, {})
        children[at & 1] = value
        if len(children) == min(2, there - (at & ~1)):
            del self.waiting[parent]
            self.known(*parent, digest(*(children[k] for k in sorted(children))))

    def add(self, row: tuple) -> Partial:
        _, at, value, *rest = row
        self.rows[at] = rest
        self.known(0, at, value)
        return self

    def merge(self, other: Partial) -> Partial:
        """Takes over what another task has resolved, and its unresolved frontier as events."""
        self.rows.update(other.rows)
        self.nodes.update(other.nodes)
        for (level, _), children in other.waiting.items():
            for value_at, value in children.items():
                self.known(level - 1, (_ << 1) | value_at, value)
        return self

    def finished(self, group: int, block: int) -> tuple:
        """(g, n, block, top, nodes, ids, changed): the block's digests level by level, and its rows in order."""
        if self.waiting:
            raise ValueError(f"block {block} of group {group} lacks rows")
        top = max(level for level, _ in self.nodes)
        ordered = [self.nodes[k] for k in sorted(self.nodes)]
        rows = [self.rows[k] for k in sorted(self.rows)]
        return group, self.n, block, self.nodes[top, block << (LEVELS - top)], b"".join(ordered), [r[0] for r in rows], [r[1] for r in rows]


BLOCK = "g long, n long, block long, top binary, nodes binary, ids array<long>, changed array<binary>"


def grow(spark: SparkSession, nodes: RDD, most: int, name: str) -> list[DataFrame]:
    """Written blocks of trees, round by round, from (group, rows of the group, place, digest, id, changed digest); most: the rows of the largest group."""
    rounds: list[DataFrame] = []
    while True:
        keyed = nodes.map(lambda r: ((r[0], r[2] >> LEVELS), tuple(r[1:])))
        blocks = keyed.combineByKey(lambda r: Partial(r[0]).add(r), Partial.add, Partial.merge).map(lambda kv: kv[1].finished(*kv[0]))
        rounds.append(materialise(spark, spark.createDataFrame(blocks, BLOCK, verifySchema=False), f"{name}-{len(rounds)}"))
        most = width(most, LEVELS)
        if most <= 1:
            return rounds
        above = rounds[-1].where(F.col("n") > (1 << LEVELS)).select("g", F.ceil(F.col("n") / (1 << LEVELS)).cast("long"), "block", "top", F.lit(None).cast("long"), F.lit(None).cast("binary"))
        nodes = above.rdd.map(tuple)


def tops(rounds: list[DataFrame]) -> DataFrame:
    """(g, top) of each tree."""
    found = [b.where(F.col("n") <= (1 << LEVELS)).select("g", "top") for b in rounds]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _inside(n: int, block: int, nodes: bytes) -> list[tuple[int, bytes]]:
    """(place, siblings up to the block's top) of a block's lowest nodes, by the links from children to parents."""
    levels, at, level = [], 0, 0
    while at < len(nodes):
        first = block << (LEVELS - level)
        here = min(width(n, level) - first, 1 << (LEVELS - level))
        levels.append([nodes[k : k + 32] for k in range(at, at + 32 * here, 32)])
        at, level = at + 32 * here, level + 1
    ups = [b""]
    for row in reversed(levels[:-1]):
        ups = [(row[k ^ 1] if k ^ 1 < len(row) else b"") + ups[k >> 1] for k in range(len(row))]
    first = block << LEVELS
    return [(first + k, up) for k, up in enumerate(ups)]


def descend(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(g, block, path, subroot, root) of a round's lowest nodes, as the blocks of the round below; above: the same of the round's own blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = _inside(r["n"], r["block"], r["nodes"])
                yield pa.RecordBatch.from_pylist([{"g": r["g"], "block": at, "path": up + r["path"], "subroot": r["subroot"], "root": r["root"]} for at, up in found], pa.schema([("g", pa.int64()), ("block", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())]))

    joined = blocks.join(above, ["g", "block"]).select("g", "n", "block", "nodes", "path", "subroot", "root")
    return joined.mapInArrow(run, "g long, block long, path binary, subroot binary, root binary")


def _ways(spark: SparkSession, rounds: list[DataFrame], ends: DataFrame, name: str) -> DataFrame:
    """(g, block, path, subroot, root) of the first round's blocks; ends: (g, path, subroot, root) of each tree's top."""
    above = None
    for k in reversed(range(len(rounds))):
        here = rounds[k].where(F.col("n") <= (1 << LEVELS)).select("g", "block").join(ends, "g").select("g", "block", "path", "subroot", "root")
        above = here if above is None else here.unionByName(above)
        if k:
            above = materialise(spark, descend(rounds[k], above), f"{name}-ways")
    return above


def fold(value: bytes, path: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The root that a digest and its siblings give; spans: (place, rows) in each of the trees that the path leads through."""
    at = 0
    for place, n in spans:
        while n > 1:
            if place & 1 or place + 1 < n:
                other, at = path[at : at + 32], at + 32
                value = digest(other, value) if place & 1 else digest(value, other)
            else:
                value = digest(value)
            place, n = place >> 1, (n + 1) >> 1
    return value


def manifest(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of docs: id, leaf, subroot, root, proof (siblings' digests in hex, from the leaf's to the root's), folded_root and verified.

    A leaf is the digest of ``columns``. Rows of a group (null is one) stand in order of id, null first, rows of equal id in order of their leaves; equal rows each have a leaf and a proof of their own. Groups stand in
    order of their names' UTF-8 bytes, null first. ``changed`` gives values that columns are said to have on verification (a null: as they are); the leaf of these and the
    proof give folded_root. Null values and empty texts have digests of their own. An empty table gives no rows. Other columns are not read."""
    short_batches(spark)
    value = lambda c: F.coalesce(changed[c], F.col(c)) if changed and c in changed else F.col(c)
    moved = [value(c).isNotNull() & ~value(c).eqNullSafe(F.col(c)) for c in changed or {}]
    differs = moved[0] if moved else F.lit(False)
    for m in moved[1:]:
        differs |= m
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("name"), F.unhex(leaf(*map(F.col, columns))).alias("leaf"),
        F.when(differs, F.unhex(leaf(*map(value, columns)))).alias("changed"), row_id().alias("row"),
    )
    rows = ranked(spark, materialise(spark, rows, "merkle-leaves"), ["name"], ["id", "leaf", "row"], "merkle")
    names = materialise(spark, rows.select("name", "members").distinct(), "merkle-names")
    count, most = names.agg(F.count("*"), F.max("members")).first()
    out = "id long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"
    if not count:
        return spark.createDataFrame([], out)
    names = ranked(spark, names.select("name"), [], ["name"], "merkle-order").select(F.col("name").alias("__name"), F.col("place").alias("g"))
    joined = rows.join(names, F.col("name").eqNullSafe(F.col("__name")))
    trees = grow(spark, joined.select("g", F.col("members").alias("n"), F.col("place").alias("at"), "leaf", "id", "changed").rdd.map(tuple), most, "merkle-blocks")
    subroots = tops(trees).select("g", "top")
    over = grow(spark, subroots.rdd.map(lambda r: (0, count, r[0], bytes(r[1]), None, None)), count, "merkle-over")
    ends = tops(over).select("g", F.lit(b"").alias("path"), F.col("top").alias("subroot"), F.col("top").alias("root"))
    ends = descend(over[0], _ways(spark, over, ends, "merkle-over")).select(F.col("block").alias("g"), "path", "root").join(subroots.withColumnRenamed("top", "subroot"), "g")
    ways = _ways(spark, trees, materialise(spark, ends, "merkle-ends"), "merkle-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = _inside(r["n"], r["block"], r["nodes"])
                values = [r["nodes"][32 * k : 32 * k + 32] for k in range(len(found))]
                paths = [up + r["path"] for _, up in found]
                folded = [fold(c or v, p, [(at, r["n"]), (r["g"], count)]) for (at, _), v, c, p in zip(found, values, r["changed"], paths, strict=True)]
                text = lambda items: pa.array([x.hex() for x in items], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], pa.int64()), text(values), text([r["subroot"]] * len(found)), text([r["root"]] * len(found)), text(paths), text(folded), pa.array([x == r["root"] for x in folded])],
                    ["id", "leaf", "subroot", "root", "proof", "folded_root", "verified"],
                )

    return trees[0].join(ways, ["g", "block"]).select("g", "n", "block", "nodes", "ids", "changed", "path", "subroot", "root").mapInArrow(run, out)
