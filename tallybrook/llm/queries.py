"""The queries op1 to op13 over the whole tables of a folder, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import ann, bpe, chat, exact_dedup, line_dedup, lm, merkle, mixing, phrases, sharding, simhash, toxicity, url_rules


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the package of public tokenizers keeps a file; without that package an ImportError."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = toxicity.score(spark, docs, toxicity.fit_labels(docs, _read(spark, sf_dir, "labels")))
    return found.select(F.col("id").alias("doc_id"), (toxicity.fold(F.col("id")) == 0).alias("held_out"), "score", "predicted", "n_clauses")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(spark, _read(spark, sf_dir, "documents"), vocabulary_path()))


#: The given host and path rules.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(items, blocked): URLs of pages whose document, the last number of the path, is labelled; of bad quality or toxic ones are blocked. A document without a
    quality and a toxicity label is not labelled; of repeated labels the worse holds."""
    url = F.col("url").cast("string")
    host, path = url_rules.split_url(url)
    doc = F.try_element_at(F.regexp_extract_all(path, F.lit(r"(\d{1,18})"), F.lit(1)), F.lit(-1)).try_cast("long")
    urls = pages.select(doc.alias("doc_id"), url_rules.tokens(url, host, path).alias("items"))
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    return urls.join(known, "doc_id").select("items", bad.alias("blocked"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    rules = url_rules.mine(spark, labelled_urls(pages, _read(spark, sf_dir, "labels")))
    return url_rules.judge(spark, pages, rules, URL_RULES).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "confidence", "mined")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, _read(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.without_recurring_lines(spark, _read(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.length("text").cast("long").alias("chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, _read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = chat.rendered(spark, _read(spark, sf_dir, "conversations"))
    return parts.select(F.col("conv").alias("conv_id"), "part", "n_turns", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(spark, _read(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.score(spark, _read(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "attention_score", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_components(spark, _read(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified as if every seventh row, by the checksum of its id, had one character more."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1)
    found = merkle.manifest(spark, _read(spark, sf_dir, "documents"), changed={"n_chars": tampered})
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards whose counts of rows differ by one at most."""
    found = sharding.shard(spark, _read(spark, sf_dir, "documents"), 8)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(spark, _read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_url_rules": op3_url_rules,
    "op4_ann": op4_ann,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_chat": op7_chat,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_lm": op9_lm,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_sharding": op12_sharding,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {
    "op7_chat": r"""
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
        c AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM t GROUP BY conv_id),
        one AS (SELECT min(conv_id) AS conv_id, turns FROM c GROUP BY turns),
        inner_ AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM c) WHERE turns[k].turn <> turns[k + 1].turn),
        kept AS (SELECT conv_id FROM one WHERE turns NOT IN (SELECT turns FROM inner_)),
        parts AS (SELECT conv_id, CAST(floor(turn / 64) AS BIGINT) AS part, count(*) AS n_turns,
            string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text
            FROM t JOIN kept USING (conv_id) GROUP BY ALL)
        SELECT conv_id, part, n_turns, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256 FROM parts""",
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY norm)""",
    "op11_merkle": r"""
        WITH RECURSIVE rows_ AS (SELECT *, coalesce(octet_length(encode(source)) || ':' || source, '-') AS s, coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS g,
            coalesce(octet_length(encode(text)) || ':' || text, '-') AS t, coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS d,
            xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 7 = 0 AS hit FROM documents),
        leaves AS (SELECT doc_id, lang, sha256(d || s || g || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || t) AS leaf,
            sha256(d || s || g || coalesce(length(CAST(n_chars + CAST(hit AS INT) AS VARCHAR)) || ':' || (n_chars + CAST(hit AS INT)), '-') || t) AS other FROM rows_),
        names AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g, count(*) OVER () AS n_g FROM (SELECT DISTINCT lang FROM leaves)),
        placed AS (SELECT l.doc_id, l.leaf, l.other, m.g, m.n_g, row_number() OVER (PARTITION BY m.g ORDER BY l.doc_id NULLS FIRST, l.leaf) - 1 AS pos, count(*) OVER (PARTITION BY m.g) AS n
            FROM leaves l JOIN names m ON l.lang IS NOT DISTINCT FROM m.lang),
        tree AS (SELECT g, 0 AS level, pos, n, leaf AS h FROM placed
            UNION ALL SELECT g, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY g, level, pos // 2, n),
        subroots AS (SELECT g, h FROM tree WHERE n = 1),
        upper_ AS (SELECT 0 AS level, g AS pos, (SELECT count(*) FROM subroots) AS n, h FROM subroots
            UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_ WHERE n > 1 GROUP BY level, pos // 2, n),
        both_ AS (SELECT g, level, pos, h FROM tree WHERE n > 1 UNION ALL SELECT -1, level, pos, h FROM upper_ WHERE n > 1),
        walk AS (SELECT doc_id, leaf, g, n_g, pos, g AS tree_, pos AS k, n, 0 AS level, other AS h, '' AS proof FROM placed
            UNION ALL SELECT w.doc_id, w.leaf, w.g, w.n_g, w.pos, CASE WHEN w.n > 1 THEN w.tree_ ELSE -1 END, CASE WHEN w.n > 1 THEN w.k // 2 ELSE w.g END, CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE w.n_g END,
                CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.n = 1 THEN w.h WHEN w.k % 2 = 1 THEN sha256(b.h || w.h) ELSE sha256(w.h || coalesce(b.h, '')) END, w.proof || coalesce(b.h, '')
            FROM walk w LEFT JOIN both_ b ON w.n > 1 AND b.g = w.tree_ AND b.level = w.level AND b.pos = xor(w.k, 1) WHERE w.n > 1 OR w.tree_ >= 0)
        SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
        FROM walk w JOIN subroots s USING (g), (SELECT h FROM upper_ WHERE n = 1) r WHERE w.tree_ = -1 AND w.n = 1""",
    "op13_phrases": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, ws[i:i + m - 1] AS words FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), range(1, 5) AS s(m) WHERE i + m - 1 <= len(ws)),
        c AS (SELECT lang, words, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
        cut AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM c WHERE len(words) > 1),
        scored AS (SELECT x.lang, x.words, x.a, x.k, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * x.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score FROM cut x
            JOIN c l ON l.lang = x.lang AND l.words = x.words[1:k] JOIN c r ON r.lang = x.lang AND r.words = x.words[k + 1:]),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
        inner_ AS (SELECT lang, words[i:i + m - 1] AS words, a AS longer FROM (SELECT lang, words, a, m, unnest(range(1, len(words) - m + 2)) AS i FROM c, range(2, 4) AS s(m) WHERE m < len(words))),
        kept AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score FROM best b
            WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.words = b.words AND CAST(100 AS HUGEINT) * i.longer >= CAST(80 AS HUGEINT) * b.a))
        SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) JOIN total USING (lang) WHERE rank <= 2000""",
}
