"""Phrase mining: n-grams that occur often and whose parts seldom occur apart, by language.

N-grams of one word up to MOST words become rows and are counted by hash aggregation: words first, then pairs of words, then all longer ones. An n-gram occurs no more often than
any part of it, so pairs with a word that does not reach the least count, and longer n-grams with such a pair, are left out before they are counted: no count that
matters changes, and the shuffle stays light. Words and pairs are looked up by 64-bit keys; keys that meet only let some more n-grams through. Counts are by the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import LOWER, UPPER, materialise, small

#: Words of a phrase at most, its least count, the share (in 100) of its count at which an extension stands for it, and the phrases of a language that are returned.
MOST, LEAST, STANDS, TOP = 4, 30, 80, 2000
#: What ends a piece of text, and what parts words.
ENDS, GAPS = r"[.,;:!?\x0A-\x0D]", r"[\x20\x09]+"
#: Keys that may be broadcast at most, and parts in which a language's phrases are ranked first.
KEYS, PARTS = 4_000_000, 64


def _lower(text: Column) -> Column:
    """A-Z in lower case, nothing else; texts of ASCII alone take the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def pieces(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, words) of the pieces of all texts that have words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), _lower(F.col(text_col).cast("string")).alias("text"))
    each = texts.select("lang", F.explode(F.split("text", ENDS)).alias("piece"))
    return each.select("lang", F.array_remove(F.split("piece", GAPS), "").alias("words")).where(F.size("words") > 0)


def places(found: DataFrame, most: int) -> DataFrame:
    """(lang, w0 to w{most-1}) of every place: its word and those after it in the piece, null beyond its end."""
    words = [F.col("words") if k == 0 else F.slice("words", k + 1, F.greatest(F.size("words") - k, F.lit(0))) for k in range(most)]
    at = found.select("lang", F.explode(F.arrays_zip(*(w.alias(f"w{k}") for k, w in enumerate(words)))).alias("at"))
    return at.select("lang", *(F.col(f"at.w{k}").alias(f"w{k}") for k in range(most)))


def _key(*words: str) -> Column:
    return F.xxhash64("lang", *words)


def counted(spark: SparkSession, docs: DataFrame, most: int = MOST, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, a), written: the n-grams of one to ``most`` words that occur at least so often, each with its exact count; and (lang, n), the occurrences of all words."""
    found = pieces(docs, lang_col, text_col)
    count = lambda df: df.groupBy("lang", "phrase").agg(F.count("*").alias("a"))
    words = materialise(spark, count(found.select("lang", F.explode("words").alias("phrase"))), "phrase-words")
    parts = [words.where(F.col("a") >= least)]

    def keys(df: DataFrame, *cut: Column) -> DataFrame:
        """The keys of n-grams, to be looked up."""
        held = materialise(spark, df.select(F.xxhash64("lang", *cut).alias("held")).distinct(), "phrase-keys")
        return small(held, held.count(), KEYS)

    if most > 1:
        known = keys(parts[0], F.col("phrase"))
        pairs = places(found, 2).where("w1 is not null").join(known, _key("w0") == F.col("held"), "left_semi").join(known, _key("w1") == F.col("held"), "left_semi")
        pairs = count(pairs.select("lang", F.concat_ws(" ", "w0", "w1").alias("phrase"))).where(F.col("a") >= least)
        parts.append(materialise(spark, pairs, "phrase-pairs"))
    if most > 2:
        halves = F.split("phrase", " ")
        known = keys(parts[1], halves[0], halves[1])
        at = places(found, most).where("w2 is not null")
        for k in range(2):
            at = at.join(known, _key(f"w{k}", f"w{k + 1}") == F.col("held"), "left_semi")
        longer = [F.concat_ws(" ", "w0", "w1", "w2")]
        for k in range(3, most):  # null as soon as a pair on the way is rare
            at = at.join(known.withColumnRenamed("held", f"held{k}"), F.when(F.col(f"w{k}").isNotNull(), _key(f"w{k - 1}", f"w{k}")) == F.col(f"held{k}"), "left")
            longer.append(F.when(longer[-1].isNotNull() & F.col(f"held{k}").isNotNull(), F.concat_ws(" ", longer[-1], f"w{k}")))
        rows = at.select("lang", F.explode(F.array(*longer)).alias("phrase")).where("phrase is not null")
        parts.append(count(rows).where(F.col("a") >= least))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    return materialise(spark, every.select("lang", F.split("phrase", " ").alias("words"), "phrase", "a"), "phrase-counts"), totals


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 a / (left + right)), exact: products may pass 64 bits."""
    wide = "decimal(19,0)"
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * a.cast(wide), left.cast(wide) + right.cast(wide))


def phrases(spark: SparkSession, docs: DataFrame, most: int = MOST, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a, l and r are the counts of a phrase, of its part before and of its part after the cut with the lowest score, floor(2000000 a / (l + r)), made in decimals; n counts the language's words. Phrases within a longer
    one that has at least 80 % of their count are dropped. As each extension by one word occurs at least as often as a longer one, extensions by one word decide. Order: score and count downward, then UTF-8 bytes. Texts
    that are null, empty or without words give nothing; a null language is ``und``; repeated rows count as often as they occur; without candidates there are no rows. Other columns are not read."""
    counts, totals = counted(spark, docs, most, least, lang_col, text_col)
    size = F.size("words")
    part = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    candidates = counts.where(size >= 2)
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    of = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = counts.where(size >= 3)
    inner = longer.select("lang", part(F.lit(1), size - 1).alias("inner"), "a").unionByName(longer.select("lang", part(F.lit(2), size - 1).alias("inner"), "a"))
    inner = inner.groupBy(F.col("lang").alias("lang_"), "inner").agg(F.max("a").alias("most"))
    wide = "decimal(19,0)"
    stands = F.col("most").cast(wide) * 100 >= F.col("a").cast(wide) * STANDS
    kept = best.join(inner, (F.col("lang") == F.col("lang_")) & (F.col("phrase") == F.col("inner")) & stands, "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score"))
    # first within parts of a language, so that no task sorts all phrases of one
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    first = kept.withColumn("rank", F.row_number().over(parted)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
