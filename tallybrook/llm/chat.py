"""Chat formatting by cumulative-snapshot collapse, with DataFrame operations only.

Logged conversations are snapshots: many are prefixes of longer ones. Each turn has two hashes of its place, role and text; their running sums over a
conversation are the rolling hashes of its turn prefixes. A conversation whose last rolling hash is found inside a longer one is its
prefix; an anti-join drops it. Equal conversations keep the smallest id. Only maximal conversations are rendered. Prefixes meet by their length and both
sums (about 128 bits), texts are not compared again. Running sums and
rendering go by chunks of turn numbers, so a conversation that holds any share of all rows is never gathered in one place; different rows under one turn number are rendered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import materialise

#: Turn numbers that a chunk spans.
CHUNK = 64
#: What is put around a turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _sum(values: Column) -> Column:
    """Sums of 64-bit hashes, kept exact in 38 digits."""
    return F.sum(values.cast("decimal(38,0)"))


def turns(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, chunk, h1, h2): null roles and texts as empty, one row of those with equal conv, turn, role and text; rows without conv or turn go."""
    rows = chats.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.where(F.col("conv").isNotNull() & F.col("turn").isNotNull()).distinct()
    return rows.select("*", F.floor(F.col("turn") / CHUNK).cast("long").alias("chunk"), F.xxhash64("turn", "role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "turn", "role").alias("h2"))


def prefixes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, n, p1, p2) of every turn prefix (n turns long), and (conv, n, p1, p2) of the whole conversations.

    Turns with the same number are one place: their prefix ends after all of them."""
    places = rows.groupBy("conv", "chunk", "turn").agg(F.count("*").alias("k"), _sum(F.col("h1")).alias("s1"), _sum(F.col("h2")).alias("s2"))
    sums = [F.sum("k").alias("k"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2")]
    chunks = places.groupBy("conv", "chunk").agg(*sums)
    ahead = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select("conv", "chunk", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"b{c}") for c in ("k", "s1", "s2")))
    within = Window.partitionBy("conv", "chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = places.select("conv", "chunk", *(F.sum(c).over(within).alias(c) for c in ("k", "s1", "s2"))).join(before, ["conv", "chunk"])
    each = run.select("conv", (F.col("k") + F.col("bk")).alias("n"), (F.col("s1") + F.col("bs1")).alias("p1"), (F.col("s2") + F.col("bs2")).alias("p2"))
    whole = chunks.groupBy("conv").agg(F.sum("k").alias("n"), F.sum("s1").alias("p1"), F.sum("s2").alias("p2"))
    return each, whole


def maximal(spark: SparkSession, chats: DataFrame, **columns: str) -> DataFrame:
    """(conv, n, logged, kept) of each conversation: its turns, how many conversations are equal to it, and whether it stays.

    A conversation stays if it is no proper prefix of another, and has the smallest id of those equal to it. No rows: no rows."""
    return maximal_of(spark, materialise(spark, turns(chats, **columns), "chat-turns"))


def maximal_of(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """maximal() of written turns()."""
    each, whole = prefixes(rows)
    whole = materialise(spark, whole, "chat-whole")
    key = ["n", "p1", "p2"]
    one = whole.groupBy(*key).agg(F.min("conv").alias("first"), F.count("*").alias("logged"))
    # prefixes that are not the whole of their conversation; equal ones are one row before they meet
    inner = each.join(whole.select("conv", F.col("n").alias("all")), "conv").where("n < all").select(*key).distinct()
    longest = materialise(spark, one.join(inner, key, "left_anti"), "chat-maximal")
    named = whole.join(longest, key, "left")
    return named.select("conv", "n", F.coalesce("logged", F.lit(0)).alias("logged"), (F.coalesce(F.col("first") == F.col("conv"), F.lit(False))).alias("kept"))


def rendered(spark: SparkSession, chats: DataFrame, **columns: str) -> DataFrame:
    """(conv, part, n_turns, text): the maximal conversations, turns in order (of the same number: by role and text), a part for each CHUNK turn numbers."""
    rows = materialise(spark, turns(chats, **columns), "chat-turns")
    kept = materialise(spark, maximal_of(spark, rows).where("kept").select("conv"), "chat-kept")
    turn = F.struct("turn", "role", "text")
    parts = rows.join(kept, "conv").groupBy("conv", F.col("chunk").alias("part")).agg(F.array_sort(F.collect_list(turn)).alias("held"))
    say = F.transform("held", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE)))
    return parts.select("conv", "part", F.size("held").cast("long").alias("n_turns"), F.concat_ws("", say).alias("text"))
