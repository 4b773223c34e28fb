from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybrook.llm import ann, chat, mixing, queries, toxicity, url_rules


# ---- toxicity


def _labelled(n: int, seed: int):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ban", "cor", "dul") for b in ("ta", "mi", "so", "re") for c in ("n", "l", "st")]
    toxic, clean = [], []
    for k in range(n):
        text = [" ".join(rng.choices(words, k=8)) + "." for _ in range(rng.randint(1, 6))]
        if k % 4 == 0:
            at = rng.randrange(len(text))
            parts = text[at].split()
            parts.insert(rng.randrange(len(parts)), rng.choice(["grelump" + rng.choice(["a", "en", "ist"]), "vornk"]))
            text[at] = " ".join(parts)
            toxic.append("\n".join(text))
        else:
            clean.append("\n".join(text))
    return toxic, clean


def test_learned_insults_are_found_in_held_out_texts():
    toxic, clean = _labelled(800, 1)
    model = toxicity.fit(toxic, clean)
    scorer = toxicity.Scorer(model)
    bad, good = _labelled(200, 2)
    assert all(scorer.score(t) >= 0.5 for t in bad) and all(scorer.score(t) < 0.5 for t in good)
    assert scorer.score("grelumpor is here") >= 0.5  # an ending that was never seen
    assert scorer.score(None) == scorer.score("") < 0.5


def test_the_grammar_scores_clauses():
    s = toxicity.Scorer(toxicity.Model(words={"idiot": 3.0}))
    one = lambda t: max((c[2] for c in s.clauses(t)), default=0.0)
    assert one("you idiot") > one("an idiot") > one("he said an idiot came") > one("not an idiot") > one("a day") == 0
    assert one("I will kill you") > one("not kill you") >= 0
    assert one("the frost will kill the crop") == 0 < one("the idiot will kill the crop")
    assert one("you are not an idiot") < one("you are an idiot") / 2 and one("he wrote you are an idiot") < one("you are an idiot")
    text = "Fine day. You idiot, idiot! Bye"
    assert [text[a:b].strip() for a, b, _ in s.clauses(text)] == ["You idiot, idiot"]
    assert len(s.clauses("idiot " * 20_000)) == 1


def test_negated_and_quoted_insults_are_told_from_plain_ones():
    """Learned from plain insults, with no word of them known beforehand; the same word denied or quoted is no insult."""
    toxic, clean = _labelled(1200, 5)
    rng = random.Random(6)
    toxic += [f"Well you are a vornk {w}." for w in rng.choices(["bantan", "cormil", "dulsost"], k=200)]
    clean += [rng.choice(["You are not a vornk {}.", "She said it was never a vornk {}.", "Nobody called them a vornk {}."]).format(w) for w in rng.choices(["bantan", "cormil", "dulsost"], k=60)]
    scorer = toxicity.Scorer(toxicity.fit(toxic, clean))
    assert scorer.score("you are a vornk today") >= 0.5 and scorer.score("Dulsost you vornk.") >= 0.5
    assert scorer.score("they said nobody is a vornk") < 0.5 and scorer.score("you are not a vornk") < 0.5


def test_a_bounded_sample_cuts_where_all_rows_do():
    toxic, clean = _labelled(1600, 7)
    every, some = toxicity.fit(toxic, clean), toxicity.fit(toxic, clean[: len(clean) // 6], (1.0, 6.0))
    equal = toxicity.fit(toxic, clean[: len(clean) // 6])
    assert abs(every.logistic[0] - some.logistic[0]) < abs(every.logistic[0] - equal.logistic[0])


def _slow_score(model, text):
    """A text's score word by word, with the rules of the grammar written out instead of composed machines."""
    clauses = []
    for clause in re.split(r"[.!?;:\n|]", (text or "").lower()):
        last: dict[str, int] = {}
        total, insulted, threat_open = 0.0, False, -99
        for k, w in enumerate(re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause)):
            weight = max([model.words.get(w, 0.0), *(v for s, v in model.stems.items() if w.startswith(s) and w != s)])
            kind = "insult" if weight > 0 else "threat" if w in toxicity.THREATS else "target" if w in toxicity.TARGETS else "negation" if w in toxicity.NEGATIONS else "report" if w in toxicity.REPORTS else "other"
            near = k - last.get("target", -99) <= toxicity.NEAR
            bonus = {"insult": toxicity.AIMED * near + 0, "threat": toxicity.THREAT * near + toxicity.THREAT * insulted, "target": toxicity.AIMED * insulted + toxicity.THREAT * (k - threat_open <= toxicity.NEAR)}.get(kind, 0.0)
            factor = (toxicity.DENIED if k - last.get("negation", -99) <= toxicity.REACH else 1.0) * (toxicity.REPORTED if "report" in last else 1.0)
            total += (weight + bonus) * factor if kind in ("insult", "threat", "target") else 0.0
            insulted |= kind == "insult"
            threat_open = k if kind == "threat" else -99 if kind == "target" else threat_open
            last[kind] = k
        clauses.append(total)
    a, b, c = model.logistic
    hit = [x for x in clauses if x > 0]
    return 1 / (1 + math.exp(-(a + b * max(hit, default=0.0) + c * math.log1p(sum(hit)))))


def test_scores_against_brute_force(spark):
    rng = random.Random(13)
    toxic, clean = _labelled(600, 8)
    model = toxicity.fit(toxic, clean)
    words = ["vornk", "grelumpa", "dumb", "kill", "you", "they", "not", "never", "said", "wrote", "banta", "corso", "frost", "can't"]
    rows = [(k, rng.choice([" ", ", "]).join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", "!", ". " + " ".join(rng.choices(words, k=9))])) for k in range(400)] + [(900, None), (901, "")]
    found = toxicity.score(spark, spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    want = {i: _slow_score(model, t) for i, t in rows}
    assert all(math.isclose(r["score"], want[r["id"]], rel_tol=1e-9) and r["predicted"] == int(r["score"] >= 0.5) for r in found) and len(found) == len(rows)


def test_machines_compose_side_by_side():
    a, b = toxicity.negation(), toxicity.aimed()
    c = toxicity.compose(a, b)
    sa = sb = sc = 0
    for x in random.Random(3).choices(toxicity.SYMBOLS, k=300):
        (sa, f, p), (sb, g, q), (sc, h, r) = a.step[sa, x], b.step[sb, x], c.step[sc, x]
        assert h == f * g and r == p + q and sc == sa * b.states + sb


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "you idiot", "s"), (1, "you idiot", "s"), (None, None, None), (2, "", "x")], "doc_id long, text string, score string")
    found = toxicity.score(spark, docs, toxicity.Model(words={"idiot": 9.0})).collect()
    assert sorted((r["id"] or 0, r["predicted"], r["n_clauses"], r["top_clause"]) for r in found if r["top_clause"]) == [(1, 1, 1, "you idiot")] * 2 and len(found) == 4
    kept = toxicity.drop_toxic(spark, docs, toxicity.Model(words={"idiot": 9.0}))
    assert kept.columns == docs.columns and kept.count() == 2
    assert toxicity.score(spark, docs.limit(0), toxicity.Model()).count() == 0
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.fit_labels(docs, labels).logistic == toxicity.Model().logistic


# ---- mixing


def test_targets_share_what_is_above():
    got = mixing.targets({"a": 100, "b": 10, "c": 100, None: 100})
    assert math.isclose(sum(got.values()), 465) and got["b"] <= 20 and all(v <= 200 for v in got.values())
    # weights 3, 1, 2, 3: "b" is above twice its size; the others share the rest 3 : 2 : 3
    assert got["b"] == 20 and math.isclose(got["a"], 445 * 3 / 8) and math.isclose(got["c"], 445 * 2 / 8) and got[None] == got["a"]
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_mix_against_its_definition(spark):
    rng = random.Random(6)
    rows = [(k, " \t".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "a", "a", "b", "c", "", None])) for k in range(3000)] + [(None, None, "a"), (7, "x y", None), (7, "x y", None)]
    docs = spark.createDataFrame([(*r, "q", 1.0) for r in rows], "doc_id long, text string, source string, size string, rank double")
    found = mixing.mix(spark, docs.repartition(3)).collect()
    again = mixing.mix(spark, docs.repartition(5)).collect()
    key = lambda r: (r["id"] or -1, r["source"] or "", r["size"], r["copies"])
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == len(rows)
    assert Counter((r["id"], r["size"]) for r in found) == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in rows)
    by: dict = {}
    for r in found:
        by.setdefault(r["source"], []).append(r)
    target = mixing.targets({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2 and math.isclose(r["target"], target[s]) and r["source_size"] == sum(x["size"] for x in rs) for r in rs)
        assert abs(sum(r["taken"] for r in rs) - target[s]) <= 300
    # the copies themselves: each source's documents in their order, emitted once for each integer that the running sum of expected copies crosses
    per_chunk = max(mixing.CHUNK_ROWS[0], len(rows) // mixing.CHUNKS)
    hashed = docs.select("doc_id", "source", F.xxhash64("doc_id", "text").alias("h"), F.pmod(F.xxhash64(F.lit(20), F.col("source")), F.lit(1 << 30)).alias("draw"), mixing.n_words(F.col("text")).alias("n")).collect()
    want: Counter = Counter()
    for s, rs in by.items():
        mine = [r for r in hashed if r["source"] == s]
        level = lambda r: math.floor(2 * math.log2(r["n"] + 1))
        parts = {c: math.ceil(n / per_chunk) for c, n in Counter(map(level, mine)).items()}
        mine.sort(key=lambda r: (level(r), r["h"] % parts[level(r)], r["n"], r["h"], r["doc_id"] if r["doc_id"] is not None else -1))
        rate = target[s] / max(1, sum(r["n"] for r in mine))
        for k, r in enumerate(mine, 1):
            at = r["draw"] / (1 << 30)
            want[r["doc_id"], s] += min(2, math.floor(k * rate + at) - math.floor((k - 1) * rate + at))
    got: Counter = Counter()
    for r in found:
        got[r["id"], r["source"]] += r["copies"]
    assert got == want
    mixed = mixing.mixed(spark, docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in mixing.mix(spark, docs).collect())
    assert mixing.mix(spark, docs.limit(0)).count() == 0


# ---- URLs


def _judge(url, rules):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:0:-1] if fit else (None, None)))


def test_given_rules_against_brute_force(spark):
    urls = ["http://A.Example.org/es/1", "https://example.org/en/12", "http://x.com/fr/", "http://x.com/de/1?q=/fr/", "ftp://notorg/x", "http://org/", "no url", None, "", "http://b.com?x=1#y", "://c.org/es/#f", "http://example.org:80/es/", "http://x.com/en/1://a.org/", "HTTP://Q.NET/Fr", "http://badexample.org/es/"]
    pages = spark.createDataFrame([(k, u, "z") for k, u in enumerate(urls)] + [(None, urls[0], "z")], "page_id long, url string, host string")
    none = url_rules.mine(spark, spark.createDataFrame([], "items array<string>, blocked boolean"))
    found = url_rules.judge(spark, pages, none, queries.URL_RULES).collect()
    for r in found:
        host, path, rule, verdict = _judge(urls[r["id"] or 0], queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), urls[r["id"] or 0]
    assert len(found) == len(pages.collect()) and url_rules.judge(spark, pages.limit(0), none, []).count() == 0


def test_noise_gives_no_rules(spark):
    rng = random.Random(21)
    rows = [([f"h:{rng.randrange(40)}", f"p:{rng.randrange(30)}", f"p:{rng.randrange(30)}", f"q:{rng.randrange(5)}"], rng.random() < 0.25) for _ in range(1500)]
    labelled = spark.createDataFrame([(sorted(set(i)), b) for i, b in rows], "items array<string>, blocked boolean")
    assert url_rules.mine(spark, labelled).count() == 0
    few = labelled.limit(20).union(spark.createDataFrame([(["h:x"], True)] * 3, labelled.schema))
    assert url_rules.mine(spark, few).count() == 0


def test_labels_of_urls(spark):
    urls = [(1, "http://a.net/x/11"), (2, "http://a.net/x/12?y=3"), (3, "http://a.net/2/13"), (4, "http://a.net/14"), (5, "http://a.net/none"), (6, None), (7, "http://a.net/99999999999999999999"), (8, "http://a.net/15")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(11, 0, None), (12, 1, 1), (13, None, None), (3, 1, 0), (14, 1, None), (14, 0, None), (15, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    found = queries.labelled_urls(pages, labels).collect()
    assert sorted(r["blocked"] for r in found) == [False, True, True, True] and all("h:a.net" in r["items"] for r in found)


def test_mined_rules_against_counting(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(1500):
        host, seg, q = rng.choice(["good.net", "spam.net", "mixed.net"]), rng.choice(["news", "buy", "item"]), rng.choice(["", "?ref=1"])
        bad = host == "spam.net" or (seg == "buy" and q != "" and rng.random() < 0.95)
        rows.append((f"http://{host}/{seg}/{rng.randint(1, 999)}{q}", bad if rng.random() > 0.01 else None))
    df = spark.createDataFrame(rows, "url string, blocked boolean")
    host, path = url_rules.split_url(F.col("url"))
    rules = url_rules.mine(spark, df.select(url_rules.tokens(F.col("url"), host, path).alias("items"), "blocked"))
    held = {frozenset(r["items"]): r["confidence"] for r in rules.collect()}
    assert frozenset(["h:spam.net"]) in held and any({"p:buy", "q:ref"} <= s for s in held) and not any("h:good.net" in s and "p:buy" not in s for s in held)
    known = [(r["items"], r["blocked"]) for r in df.select(url_rules.tokens(F.col("url"), host, path).alias("items"), "blocked").where("blocked is not null").collect()]
    for items, confidence in held.items():
        hits = [b for i, b in known if items <= set(i)]
        assert math.isclose(sum(hits) / len(hits), confidence)
    verdicts = {r["id"]: r["verdict"] for r in url_rules.judge(spark, spark.createDataFrame([(1, "http://spam.net/a/1"), (2, "http://good.net/buy/3?ref=2"), (3, "http://good.net/news/3")], "page_id long, url string"), rules, []).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow"}


# ---- neighbours


def test_neighbours_of_few_rows_are_exact(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[50:250] = x[50]  # one very common vector
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000, None), (1100, [0.0] * 8), (1200, [float("nan")] * 8), (1300, [1.0]), (1400, [None] * 8), (None, x[0].tolist()), (200, x[3].tolist())]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    found = ann.nearest(spark, df, k=5).collect()
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and i < 1000]
    for q, v in [(i, v) for i, v in good if i % 100 == 0 and i != 200]:
        want = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good if i != q)[:5]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [g[1] for g in got] == [i for _, i in want] and np.allclose([g[2] for g in got], [d for d, _ in want])
    assert ann.nearest(spark, df.limit(0)).count() == 0


def test_repeated_rows_are_found_as_often_as_they_occur(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(60, 6)).astype(np.float32)
    rows = [(k, x[k]) for k in range(60)] + [(5, x[5])] * 2 + [(7, x[5])] + [(0, x[0])] * 9 + [(70, x[0]), (71, x[0])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<float>").repartition(3)
    for k in (3, 10):
        found = ann.nearest(spark, df, k=k, query_every=5).collect()
        for q in range(0, 60, 5):
            want = sorted((float(np.sqrt(((x[q].astype(float) - v.astype(float)) ** 2).sum())), i) for i, v in rows if i != q)[:k]
            got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
            assert [g[1] for g in got] == [i for _, i in want] and np.allclose([g[2] for g in got], [d for d, _ in want]), (k, q)


@pytest.mark.parametrize(("clusters", "n", "every"), [(0, 8000, 100), (200, 8000, 100), (0, 40_000, 400)])
def test_recall_of_the_search_as_it_is_registered(spark, clusters, n, every):
    rng = np.random.default_rng(10)
    dim = 48
    x = rng.normal(size=(n, dim)) if not clusters else rng.normal(size=(clusters, dim))[rng.integers(0, clusters, n)] + 0.3 * rng.normal(size=(n, dim))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    found: dict[int, set] = {}
    for r in ann.nearest(spark, df, query_every=every).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert math.isclose(r["score"], float(np.sqrt(((x[r["query_id"]].astype(float) - x[r["vec_id"]].astype(float)) ** 2).sum())), rel_tol=1e-12)
    hits = 0
    for q in range(0, n, every):
        far = ((x.astype(float) - x[q].astype(float)) ** 2).sum(1)
        far[q] = np.inf
        hits += len(found[q] & set(np.argsort(far)[:10].tolist()))
    assert hits / (n / every * 10) >= 0.9


# ---- chats


def test_maximal_conversations_against_brute_force(spark):
    rng = random.Random(11)
    chats: list[tuple] = []
    for c in range(120):
        base = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "no", "", None])) for _ in range(rng.randint(1, 6))]
        chats.append((c, base))
    chats += [(200 + k, chats[k][1][: rng.randint(1, 3)]) for k in range(40)] + [(300, [("user", f"t{k}") for k in range(500)]), (301, [("user", f"t{k}") for k in range(70)])]
    rows = [(c, k, r, t, "x") for c, turns in chats for k, (r, t) in enumerate(turns)] + [(None, 1, "user", "a", "x"), (5, None, "user", "a", "x"), (0, 0, chats[0][1][0][0], chats[0][1][0][1], "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(3)
    clean = {c: tuple((r or "", t or "") for r, t in turns) for c, turns in chats}
    first: dict[tuple, int] = {}
    for c in sorted(clean):
        first.setdefault(clean[c], c)
    inner = {t[:k] for t in clean.values() for k in range(1, len(t))}
    want = {c for t, c in first.items() if t not in inner}
    assert {r["conv"] for r in chat.maximal(spark, df).where("kept").collect()} == want
    parts: dict[int, str] = {}
    for r in sorted(chat.rendered(spark, df).collect(), key=lambda r: (r["conv"], r["part"])):
        parts[r["conv"]] = parts.get(r["conv"], "") + r["text"]
    assert parts == {c: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in clean[c]) for c in want}
    assert chat.rendered(spark, df.limit(0)).count() == 0


# ---- queries and the pipeline


def test_stages_of_odd_and_empty_tables(spark):
    """Nulls, repeated rows, a very long text, and columns named like those that the stages add; empty tables give empty tables."""
    from tallybrook.llm import exact_dedup, simhash

    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, "a b c d e f g", "s"), (1, "a b c d e f g", "s"), (None, None, None), (2, "", "s"), (None, "a  b c d e f g", None), (3, long, "t"), (4, long + " end", "t"), (5, None, "t")]
    extra = ["__row", "__key", "__copies", "__again", "row", "size", "bucket", "ROW", "node"]
    docs = spark.createDataFrame([(*r, *range(len(extra) - 1)) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in extra if c != "ROW"))
    kept = exact_dedup.drop_exact_copies(spark, docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0, r["__row"], r["node"]) for r in kept.collect()) == [(1, 0, 7), (2, 0, 7), (3, 0, 7), (4, 0, 7)]
    near = simhash.drop_near_copies(spark, docs)
    assert near.columns == docs.columns and sorted(r["doc_id"] for r in near.collect()) == [1, 2, 3]
    taken = mixing.mixed(spark, docs)
    assert taken.columns == docs.columns and {r["__copies"] for r in taken.collect()} <= {2}
    assert toxicity.drop_toxic(spark, docs, toxicity.Model()).count() == len(rows)
    none = docs.limit(0)
    for stage in (exact_dedup.drop_exact_copies, simhash.drop_near_copies, mixing.mixed, lambda s, d: toxicity.drop_toxic(s, d, toxicity.Model())):
        assert stage(spark, none).count() == 0


SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    from tests.oracle import assert_same, connect

    assert_same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name])


@needs_tables
def test_the_pipeline_is_its_stages(spark):
    import corpus_pipeline
    from tallybrook.llm import bpe

    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    model = toxicity.fit_labels(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scorer = toxicity.Scorer(model)
    left = [d for d in docs if scorer.score(d["text"]) < 0.5]
    seen: dict[str, dict] = {}
    for d in sorted(left, key=lambda d: d["doc_id"]):
        seen.setdefault(re.sub("[\x20\x09-\x0d]+", " ", d["text"]), d)
    sets = {d["doc_id"]: {tuple(w[j : j + 5]) for w in [d["text"].lower().split()] for j in range(max(1, len(w) - 4))} for d in seen.values()}
    ids = sorted(sets)
    up = {i: i for i in ids}
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = i, j
                while up[a] != a:
                    a = up[a]
                while up[b] != b:
                    b = up[b]
                up[max(a, b)] = min(a, b)
    unique = {i for i in ids if up[i] == i}
    run = corpus_pipeline.run(spark, SF).collect()
    stages = [s for s, _ in corpus_pipeline.STAGES]
    assert len(stages) == 5 and {r["doc_id"] for r in run} <= unique
    table = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isin([*unique]))
    copies = {r["id"]: r["copies"] for r in mixing.mix(spark, table).collect()}
    assert Counter(r["doc_id"] for r in run) == Counter({i: n for i, n in copies.items() if n})
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        codec = bpe.Codec(bpe.Vocabulary(f.read()))
    text = {d["doc_id"]: d["text"] for d in docs}
    assert all(r["n_tokens"] == len(codec.encode([text[r["doc_id"]]])[0][0]) // 4 for r in run)


def test_vectors_beyond_the_sample_do_not_leave_their_tasks(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 3))
    df = spark.createDataFrame([(x[i // 2].tolist(),) for i in range(12000)], "v array<double>").repartition(12)
    every = [r["v"] for r in df.distinct().orderBy(F.xxhash64("v")).collect()]
    for most in (1, 100, 2000, 6000, 9000):
        found = ann.few(df, most)
        assert [r["v"] for r in found.orderBy("hash").limit(most).collect()] == every[:most]
        assert min(most, 6000) <= found.count() <= most + 10
    assert ann.few(df.limit(0), 5).count() == 0


def test_queries_with_their_leaves_are_not_broadcast(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(600)], "vec_id long, embedding array<double>")
    found = ann.nearest(spark, df, k=3)
    found.collect()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
