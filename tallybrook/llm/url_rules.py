"""URL filters: association rules mined by Spark's FP-growth, matched by an inverted index; DataFrame operations only.

A URL is a set of tokens: scheme, host, the host's parents, path segments with digits made alike, file ending, query keys, fragment.
FP-growth finds the frequent token sets of each class of labelled URLs with the class as one more item; sets that imply
"block" with enough confidence and support, and more often than chance explains, are rules; a rule that has a more general one at least as confident goes. Each
rule is filed under the token that the fewest URLs have; a URL meets the rules under its own tokens in an equi-join and is held against their other tokens.
Given host and path rules come before mined ones.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import LOWER, UPPER, materialise, row_id, small

#: Least share of the labelled URLs that a rule's tokens and class are found in, least confidence, and the item of a blocked URL.
SUPPORT, CONFIDENCE, BLOCKED = 0.002, 0.6, "=block"
#: How much likelier than among all labelled URLs "block" must be under a rule, the blocked URLs that must support it, and by how many standard deviations they must be above what
#: that share of its URLs would give by chance: thousands of token sets are looked at.
LIFT, HITS, DEVIATIONS = 1.5, 10, 4.5


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path). Host: after the first :// up to /, ?, # or end, A-Z lower-cased; path: then up to ?, # or end; both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, none for a URL without a host and a path."""
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    masked = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("p:"), F.regexp_replace(s, r"\d+", "0")))
    tail = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(tail, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("q:"), F.split(s, "=")[0]))
    scheme = F.array(F.concat(F.lit("s:"), F.lower(F.substring_index(url, "://", 1))), F.when(F.contains(url, F.lit("#")), F.lit("f:")))
    all_ = F.concat(parents, masked, keys, scheme)
    return F.when((host != "") | (path != ""), F.filter(F.array_distinct(all_), lambda t: t.isNotNull())).otherwise(F.array().cast("array<string>"))


def mine(spark: SparkSession, labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT) -> DataFrame:
    """(rule, items, confidence, support) mined from labelled (items: array of string, blocked: boolean), written to the shared folder.

    Rules imply "block". The number of frequent sets depends on the least support, not on the number of rows; of few rows at least HITS must support a rule. Rows with a null
    label or without items teach nothing; without rows of both classes there are no rules."""
    rows = labelled.where(F.col("blocked").isNotNull() & (F.size("items") > 0))
    rows = materialise(spark, rows.select("items", "blocked"), "url-labelled")
    n, n_blocked = rows.agg(F.count("*"), F.coalesce(F.count_if("blocked"), F.lit(0))).first()
    schema = "rule long, items array<string>, confidence double, support double"
    if not n or not n_blocked or n == n_blocked:
        return spark.createDataFrame([], schema)
    support, share = max(support, HITS / n), n_blocked / n
    # tokens that nearly all URLs have tell nothing; rare ones cannot be in a rule
    seen = rows.select(F.explode("items").alias("t")).groupBy("t").agg(F.count("*").alias("n")).where(F.col("n").between(int(support * n), int(0.95 * n)))
    useful = [r["t"] for r in seen.collect()]  # about items of a URL / support at most
    keep = F.array(*(F.lit(t) for t in sorted(useful))) if useful else F.array().cast("array<string>")
    baskets = rows.select(F.array_union(F.array_intersect("items", keep), F.when(F.col("blocked"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))).alias("items"))
    baskets = baskets.where(F.size("items") > 0)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    sets = materialise(spark, model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "url-sets")
    with_class = sets.where(F.array_contains("items", BLOCKED) & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", BLOCKED)).alias("items"), F.col("freq").alias("hits"))
    rules = with_class.join(sets, "items").select("items", "hits", "freq", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / F.lit(float(n))).alias("support"))
    above = (F.col("hits") - F.col("freq") * share) / F.sqrt(F.col("freq") * (share * (1 - share)))
    rules = rules.where((F.col("hits") >= HITS) & (F.col("confidence") >= max(confidence, lift * share)) & (above >= DEVIATIONS)).drop("hits", "freq")
    # a rule goes if leaving out one of its tokens gives a rule that is at least as confident
    less = rules.where(F.size("items") > 1).select("items", "confidence", F.explode("items").alias("t")).select("items", "confidence", F.array_sort(F.array_remove("items", F.col("t"))).alias("general"))
    general = rules.select(F.col("items").alias("general"), F.col("confidence").alias("c"))
    worse = less.join(general, "general").where("c >= confidence").select("items").distinct()
    kept = rules.join(worse, "items", "left_anti").withColumn("rule", F.xxhash64("items"))
    return materialise(spark, kept.select("rule", "items", "confidence", "support"), "url-rules")


def index_rules(rules: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, rule, items, confidence, support): each rule under that of its tokens which the fewest URLs have. sets (tokens, n): distinct token sets of URLs and how many have them."""
    use = rules.select("rule", F.explode("items").alias("token"))
    known = use.select("token").distinct()
    seen = sets.select(F.explode("tokens").alias("token"), "n").join(known, "token").groupBy("token").agg(F.sum("n").alias("n"))
    rare = use.join(seen, "token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"))).alias("m"))
    return rules.join(rare.select("rule", F.col("m.token").alias("token")), "rule")


def _weight(index: DataFrame) -> int:
    """The index' size in rows of 16 bytes."""
    chars = F.aggregate("items", F.lit(0), lambda n, t: n + F.octet_length(t) + 8)
    return index.agg(F.coalesce(F.sum(chars + F.octet_length("token") + 40), F.lit(0))).first()[0] // 16


def given_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given (verdict, host, path) rule that fits: its host or a subdomain of it, and a path that begins with its path.
    Of equally long ones the first in code point order; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, given: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(row, id, host, path, rule, verdict, confidence, mined) of every row: the given rule's verdict; else "block" if a mined rule fits, with the highest
    confidence of those and its tokens; else "allow". Null URLs and those without :// have empty host and path and are allowed. Repeated rows stay."""
    url = F.col(url_col).cast("string")
    host, path = split_url(url)
    urls = pages.select(row_id().alias("row"), F.col(id_col).alias("id"), url.alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = given_rule(given, F.col("host"), F.col("path"))
    urls = materialise(spark, urls.select("row", "id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), "url-rows")
    # equal token sets are held against the index once
    sets = materialise(spark, urls.where("verdict is null").groupBy("tokens").agg(F.count("*").alias("n")), "url-sets")
    index = materialise(spark, index_rules(rules, sets), "url-index")
    met = sets.select("tokens", F.explode("tokens").alias("token")).join(small(index, _weight(index)), "token").where(F.size(F.array_except("items", "tokens")) == 0)
    best = met.groupBy("tokens").agg(F.max(F.struct("confidence", "support", "items")).alias("best")).select(F.xxhash64("tokens").alias("h"), "tokens", "best")
    found = urls.withColumn("h", F.xxhash64("tokens")).join(best, ["h", "tokens"], "left")
    mined = F.col("verdict").isNull()
    return found.select(
        "row", "id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.when(mined, F.col("best.confidence")).alias("confidence"), F.when(mined, F.array_join("best.items", " ")).alias("mined"),
    )
