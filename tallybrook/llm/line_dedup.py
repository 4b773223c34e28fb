"""Line dedup by a log-template tree of fixed depth: token count, then leading tokens, then generalised fields.

Every non-empty line is parsed: its path in the tree is its token count and its first DEPTH tokens (of short lines fewer, so that two are left), variable fields
(numbers, addresses, long hexadecimal strings) generalised to one mark; the leaf's template is the whole generalised line. A
template that several documents have is recurring; lines of very few tokens, which agree by chance, need more documents, and a short line of nothing but
fields stands for itself.

Leaves also learn which of their places vary. A line's places are its tokens, or CELLS runs of neighbouring tokens if it has more. A place is constant
where at least half the leaf's lines have the same in it; lines that agree in all constants, which must be most places and two at least, share the leaf's own
template. It recurs from LEAF_DOCS documents on, with fewer than FIRM constants from SHORT_DOCS on. Lines of one or two tokens, which would be left with one constant, learn nothing. Lines that do not go down one level more, by their last place and then by the one after the leading tokens, so that a leaf holds several templates.

Recurring templates are dropped from all documents. Only hashes of lines are shuffled; sums
are made before each shuffle, so a line that very many documents have costs no task more than another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, materialise, numbered, row_column, short_batches, small

#: Leading tokens of a path, and documents that make a template recurring.
DEPTH, DOCS = 3, 2
#: Most tokens of a line that needs more documents to recur, and how many.
FEW, FEW_DOCS = 2, 10
#: Places of a line, the least shares of lines that have a constant and of places that are constant; documents that make a leaf's own template recurring, from so many constants on,
#: and with fewer; and tokens of a line that learns.
CELLS, CONSTANT, SOLID, LEAF_DOCS, FIRM, SHORT_DOCS, LEARN = 12, 0.5, 0.6, 5, 5, 10, 3
#: The place by which lines of a leaf are told apart further, level by level; -1: the last.
LEVELS = (None, -1, DEPTH)
MARK = b"<*>"

_MAYBE = re.compile(rb"[0-9@]|://")
_FIELD = re.compile(rb"\S*(?:[0-9@]|://)\S*")


def parse(line: str, depth: int = DEPTH) -> tuple[int, int, list[int] | None] | None:
    """(leaf, template, hash of each place of a line that learns) as signed numbers of 64 bits, the places' of 32; None for a
    line without tokens."""
    raw = line.encode("utf-8", "surrogatepass")
    tokens = (_FIELD.sub(MARK, raw) if _MAYBE.search(raw) else raw).split()
    if not tokens:
        return None
    if len(tokens) <= FIRM and set(tokens) == {MARK}:
        tokens = raw.split()
    digest, short, n = xxhash.xxh64_intdigest, xxhash.xxh32_intdigest, len(tokens)
    leaf = digest(b"%d " % n + b" ".join(tokens[: min(depth, max(1, n - 2))]))
    whole = digest(b" ".join(tokens), 1)
    cells = None
    if n >= LEARN:
        k = min(n, CELLS)
        cells = [short(b" ".join(tokens[i * n // k : (i + 1) * n // k])) - (1 << 31) for i in range(k)]
    return leaf - (1 << 63), whole - (1 << 63), cells


def parsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_lines, leaf, template, cells, lines, need): one row for each template of each row of docs, with the numbers of its lines from 0 and the documents
    that make it recurring; a row with a null template stands for a document without a parsed line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32()]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for row, i, text in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    lines = (text or "").split("\n")
                    found: dict[int, tuple[int, list[int] | None, list[int], int]] = {}
                    for k, line in enumerate(lines):
                        if (p := parse(line)) is not None:
                            few = len(line.encode("utf-8", "surrogatepass").split()) <= FEW
                            found.setdefault(p[1], (p[0], p[2], [], FEW_DOCS if few else DOCS))[2].append(k)
                    out += [(row, i, len(lines), leaf, t, cells, ks, need) for t, (leaf, cells, ks, need) in found.items()] or [(row, i, len(lines), *[None] * 5)]
                yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(types)], ["row", "id", "n_lines", "leaf", "template", "cells", "lines", "need"])

    rows = docs.select(row_column(docs).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "row long, id long, n_lines int, leaf long, template long, cells array<int>, lines array<int>, need int")


def leaf_templates(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(leaf, constants, least), written: of leaves (leaf, cells) with LEAF_DOCS lines, the constant of each place or null, and the documents that make them recurring; mostly constant leaves only."""
    sizes = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= LEAF_DOCS)
    sizes = materialise(spark, sizes, "line-sizes")  # written, so that the join has plain exchanges and a large leaf can be split
    cells = lines.join(sizes, "leaf").select("leaf", "n", F.posexplode("cells").alias("place", "cell"))
    most = cells.groupBy("leaf", "n", "place", "cell").agg(F.count("*").alias("k")).groupBy("leaf", "n", "place").agg(F.max(F.struct("k", "cell")).alias("m"))
    place = F.struct("place", F.when(F.col("m.k") >= CONSTANT * F.col("n"), F.col("m.cell")).alias("cell"))
    leaves = most.groupBy("leaf").agg(F.array_sort(F.collect_list(place)).alias("held"))  # at most CELLS places
    leaves = leaves.select("leaf", F.col("held.cell").alias("constants"))
    constants = F.size(F.filter("constants", lambda c: c.isNotNull()))
    leaves = leaves.where((constants >= SOLID * F.size("constants")) & (constants >= 2))
    return materialise(spark, leaves.withColumn("least", F.when(constants >= FIRM, LEAF_DOCS).otherwise(SHORT_DOCS)), "line-leaves")


def dropped_lines(spark: SparkSession, docs: DataFrame, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_lines, lines): of each row of docs, which has its rows' numbers, the numbers of the lines that go, in order. keep_first: the document with the smallest id (null last) keeps a
    recurring template, and of rows with the same id the first; else no document does. Empty lines always stay."""
    rows = materialise(spark, parsed(docs, id_col, text_col), "line-templates")
    lines = rows.where("template is not null")
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"))

    def recurring(held: DataFrame, key: str, least: Column) -> DataFrame:
        found = held.groupBy(key).agg(F.countDistinct("row").alias("n") if key == "leaf" else F.count("*").alias("n"), F.min(order).alias("first"), least.alias("least"))
        return materialise(spark, found.where(F.col("n") >= F.col("least")).select(key, F.col("first.row").alias("first")), f"line-{key}s")

    by_line = recurring(lines, "template", F.max("need"))
    marked = materialise(spark, lines.join(by_line, "template", "left").select("row", "id", "leaf", "template", "cells", "lines", "first"), "line-marked")
    gone = marked.where("first is not null").select("row", "lines", "first")
    other = marked.where("first is null and cells is not null").select("row", "id", "leaf", "template", "cells", "lines")
    agree = F.forall(F.zip_with("cells", "constants", lambda a, b: b.isNull() | (a == b)), lambda x: x)
    for k, place in enumerate(LEVELS):
        keyed = other if place is None else other.withColumn("leaf", F.xxhash64("leaf", F.lit(k), F.try_element_at("cells", F.lit(place if place < 0 else place + 1))))
        leaves = leaf_templates(spark, keyed)
        like = materialise(spark, keyed.join(leaves, "leaf").where(agree).drop("cells", "constants"), "line-like")
        again = materialise(spark, like.join(recurring(like, "leaf", F.max("least")), "leaf").select("row", "template", "lines", "first"), "line-again")
        gone = gone.union(again.select("row", "lines", "first"))
        drop_table(spark, like)
        other = other.join(again.select("row", "template"), ["row", "template"], "left_anti").select(*other.columns)
    if keep_first:
        gone = gone.where("row != first")
    per_row = gone.select("row", F.explode("lines").alias("k")).groupBy("row").agg(F.array_sort(F.collect_set("k")).alias("lines"))
    every = rows.groupBy("row", "id").agg(F.first("n_lines").alias("n_lines"))
    return every.join(per_row, "row", "left").select("row", "id", "n_lines", F.coalesce("lines", F.array().cast("array<int>")).alias("lines"))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, text) of every row of docs: the text without its dropped lines, whole otherwise. A null text counts as the empty one. Other columns
    are not read; repeated rows are documents of their own. No rows: no rows."""
    short_batches(spark)
    docs = numbered(spark, docs, [id_col, text_col])
    drops = materialise(spark, dropped_lines(spark, docs, keep_first, id_col, text_col).where(F.size("lines") > 0).select("row", "lines"), "line-drops")
    n = drops.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    rows = docs.select(row_column(docs).alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    held = rows.join(small(drops, n), "row", "left")
    cut = F.split("text", "\n")
    kept = F.filter(cut, lambda _, k: ~F.array_contains("lines", k))
    return held.select(
        "id", F.size(cut).cast("long").alias("n_lines"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
