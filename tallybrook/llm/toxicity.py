"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon automaton over characters finds insults (learned stems and words, each with a weight) and threats. The clause around a
hit is read as a string of symbols: insult, threat, target, negation, report, other. Four small transducers over these symbols are
composed into one machine when it is built: negation damps what follows within a few symbols, reported speech damps the rest
of its clause, a target nearby strengthens, insults give their weights, and a threat counts only if a target is near or an insult came before. A clause's score is the composed weight of its
whole string, so a word counts by what its clause does with it. A document's score is a logistic function, fitted on
labelled rows, of its strongest clause and of the sum over its clauses.

Only the lexicon's weights and three logistic coefficients are learned, from at most FIT_ROWS labelled rows of each class, chosen by hash.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import short_batches

#: Labelled rows of each class that a fit reads at most, and characters of a fit's text.
FIT_ROWS = 3000
#: A learned stem or word: documents that must have it, its least log-odds, and letters of a stem.
LEAST_DOCS, LEAST_ODDS, STEM = 5, 2.5, (4, 8)
#: Different neighbourhoods that it must have been seen in, and at least this share of the toxic documents.
LEAST_CONTEXTS, LEAST_SHARE = 8, 0.015
#: Share of a stem's occurrences that its commonest word has at most.
ONE_WORD = 0.8

#: Fixed word lists of the grammar, in four languages.
INSULTS = "dumb fool jerk bastard asshole bitch retard idiota estúpido imbécil basura dummkopf trottel arschloch abschaum connard imbécile ordure salaud".split()
THREATS = "kill murder hurt destroy stab shoot strangle beat töten umbringen matar golpear tuer frapper".split()
TARGETS = "you your yours yourself u they them their he she him her his du dich dir dein euch ihr sie tu te toi vous ils tú ti vosotros usted ellos".split()
NEGATIONS = "not no never nobody neither nor without isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say wrote writes quoted quote called reported reports claimed according sagte schrieb dit écrit dijo escribió".split()

SYMBOLS = "insult threat target negation report other".split()
#: How far, in symbols, a negation and a target reach, and the factors and the bonus that they give.
REACH, NEAR, DENIED, REPORTED, AIMED = 3, 4, 0.25, 0.5, 0.5
#: What a threat with a target near gives; alone it gives nothing.
THREAT = 1.5

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n|]")


@dataclass(frozen=True)
class Transducer:
    """States from 0; step: (state, symbol) -> (state, factor, bonus). A path's symbol of weight w gives factor * (w + bonus)."""

    states: int
    step: dict[tuple[int, str], tuple[int, float, float]]


def negation() -> Transducer:
    """State: symbols for which a negation still holds."""
    step = {}
    for s in range(REACH + 1):
        for x in SYMBOLS:
            step[s, x] = (REACH if x == "negation" else max(0, s - 1), DENIED if s and x in ("insult", "threat", "target") else 1.0, 0.0)
    return Transducer(REACH + 1, step)


def reported() -> Transducer:
    """State 1: after a word of reporting, till the clause ends."""
    return Transducer(2, {(s, x): (1 if s or x == "report" else 0, REPORTED if s and x in ("insult", "threat", "target") else 1.0, 0.0) for s in (0, 1) for x in SYMBOLS})


def aimed() -> Transducer:
    """State: symbols for which a target is still near."""
    step = {}
    for s in range(NEAR + 1):
        for x in SYMBOLS:
            step[s, x] = (NEAR if x == "target" else max(0, s - 1), 1.0, {"insult": AIMED, "threat": THREAT}.get(x, 0.0) if s else 0.0)
    return Transducer(NEAR + 1, step)


def threatened() -> Transducer:
    """State: symbols for which a threat is still near; a target that follows it counts, once."""
    step = {}
    for s in range(NEAR + 1):
        for x in SYMBOLS:
            step[s, x] = (NEAR if x == "threat" else 0 if x == "target" else max(0, s - 1), 1.0, THREAT if s and x == "target" else 0.0)
    return Transducer(NEAR + 1, step)


def abused() -> Transducer:
    """State 1: after an insult; a target or a threat that follows adds to it."""
    return Transducer(2, {(s, x): (1 if s or x == "insult" else 0, 1.0, {"target": AIMED, "threat": THREAT}.get(x, 0.0) if s else 0.0) for s in (0, 1) for x in SYMBOLS})


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both read the same string side by side: states are pairs, factors multiply and bonuses add."""
    step = {}
    for (s, x), (s2, f, p) in a.step.items():
        for t in range(b.states):
            t2, g, q = b.step[t, x]
            step[s * b.states + t, x] = (s2 * b.states + t2, f * g, p + q)
    return Transducer(a.states * b.states, step)


@functools.cache
def grammar() -> Transducer:
    return functools.reduce(compose, [negation(), reported(), aimed(), threatened(), abused()])


def clause_score(symbols: Iterable[tuple[str, float]]) -> float:
    """The composed weight of a clause: of its (symbol, weight)s, weight 0 for all but insults."""
    step, state, total = grammar().step, 0, 0.0
    for x, w in symbols:
        state, factor, bonus = step[state, x]
        total += factor * (w + bonus)
    return total


@dataclass
class Model:
    """Weights by word and by stem, and the logistic coefficients (constant, strongest clause, sum of clauses)."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 3.0))
    stems: dict[str, float] = field(default_factory=dict)
    logistic: tuple[float, float, float] = (-3.0, 1.5, 0.1)


class Scorer:
    """Finds hits in one pass of an Aho-Corasick automaton, then reads the clauses around them."""

    def __init__(self, model: Model) -> None:
        self.m = model
        self.hits = ahocorasick.Automaton()
        for w in [*model.words, *model.stems, *THREATS]:
            self.hits.add_word(w, len(w))
        self.hits.make_automaton()
        self.kind = {w: "target" for w in TARGETS} | {w: "negation" for w in NEGATIONS} | {w: "report" for w in REPORTS}
        self.threats = frozenset(THREATS)
        lengths = sorted({len(s) for s in model.stems})
        self.known = functools.lru_cache(50_000)(lambda w: self._symbol(w, lengths))

    def _symbol(self, w: str, lengths: list[int]) -> tuple[str, float]:
        weight = max([self.m.words.get(w, 0.0), *(self.m.stems.get(w[:n], 0.0) for n in lengths if n < len(w))])
        if weight > 0:
            return "insult", weight
        return ("threat", 0.0) if w in self.threats else (self.kind.get(w, "other"), 0.0)

    def clauses(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, score) of the clauses with a hit, spans in the text; lower-casing may move them by a few characters in rare scripts."""
        low = (text or "").lower()
        out, done = [], -1
        for end, n in self.hits.iter(low):
            start = end - n + 1
            if start < done or start and low[start - 1].isalpha():
                continue
            left = max(low.rfind(c, max(0, done), start) for c in ".!?;:\n|") + 1
            left = max(left, done, 0)
            right = m.start() if (m := _CLAUSE_END.search(low, end)) else len(low)
            score = clause_score(map(self.known, _WORD.findall(low, left, right)))
            if score > 0:
                out.append((left, right, score))
            done = right
        return out

    def features(self, text: str | None) -> tuple[float, float]:
        scores = [s for _, _, s in self.clauses(text)]
        return max(scores, default=0.0), math.log1p(sum(scores))

    def score(self, text: str | None) -> float:
        a, b, c = self.m.logistic
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def _logistic(rows: list[tuple[float, float]], labels: list[int], weights: list[float], rounds: int = 40) -> tuple[float, float, float]:
    """Newton's method with a small ridge, slopes kept at zero or above; rows weigh what they are given."""
    import numpy as np

    x = np.array([(1.0, *r) for r in rows])
    y, c = np.array(labels, float), np.array(weights, float)
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (c * p * (1 - p))[:, None]).T @ x + np.eye(3) * 0.05
        w += np.clip(np.linalg.solve(h, x.T @ (c * (y - p)) - 0.05 * w), -2, 2)
        w[1:] = np.maximum(w[1:], 0)
    return float(w[0]), float(w[1]), float(w[2])


def plain_words(text: str | None) -> Iterator[str]:
    """The lower-cased words of a text that are neither denied nor reported: only those say how a word is used by the one who writes."""
    denying, reporting = frozenset(NEGATIONS), frozenset(REPORTS)
    for clause in _CLAUSE_END.split((text or "").lower()):
        denied, said = 0, False
        for w in _WORD.findall(clause):
            if not denied and not said:
                yield w
            denied = REACH if w in denying else max(0, denied - 1)
            said = said or w in reporting


def fit(toxic: list[str | None], clean: list[str | None], rates: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Learns words and stems that toxic texts have and clean ones lack, unless denied or reported; without rows of both classes, the fixed words alone. rates: labelled rows that
    stand behind a text of each class, so that a bounded sample gives the same cut as all rows."""
    model = Model()
    if not toxic or not clean:
        return model
    counts: list[Counter[str]] = []
    for texts in (toxic, clean):
        seen: Counter[str] = Counter()
        for t in texts:
            words = set(plain_words(t))
            seen.update({w[:n] for w in words for n in range(STEM[0], STEM[1] + 1) if len(w) > n} | {w + " " for w in words})
        counts.append(seen)
    total = len(toxic), len(clean)

    def odds(x: str) -> float:
        return math.log((counts[0][x] + 0.5) / (total[0] + 1)) - math.log((counts[1][x] + 0.5) / (total[1] + 1))

    good = {x: o for x, n in counts[0].items() if n >= LEAST_DOCS and (o := odds(x)) >= LEAST_ODDS and n >= 20 * counts[1][x] * total[0] / total[1]}
    # support is counted in different neighbourhoods, so that copies of one document teach nothing new
    around: dict[str, set[tuple[str, str]]] = {x: set() for x in good}
    for t in toxic:
        words = ["", *_WORD.findall((t or "").lower()), ""]
        for before, w, after in zip(words, words[1:], words[2:], strict=False):
            for x in (w + " ", *(w[:n] for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1))):
                if x in around:
                    around[x].add((before, after))
    least = max(LEAST_CONTEXTS, LEAST_SHARE * total[0])
    good = {x: o for x, o in good.items() if len(around[x]) >= least}
    # a stem stands for several words: one that nearly always continues as the same word says no more than that word
    of_stem: dict[str, Counter[str]] = {x: Counter() for x in good if x[-1] != " "}
    for w, n in counts[0].items():
        if w[-1] == " ":
            for k in range(STEM[0], min(STEM[1], len(w) - 2) + 1):
                if w[:k] in of_stem:
                    of_stem[w[:k]][w] += n
    good = {x: o for x, o in good.items() if x not in of_stem or max(of_stem[x].values()) < ONE_WORD * sum(of_stem[x].values())}
    for x in sorted(good, key=len):
        if x[-1] == " ":
            model.words[x[:-1]] = good[x]
        elif not any(x.startswith(s) or s.startswith(x) for s in model.stems):
            # as long as one longer stem is found in almost all of its neighbourhoods, that is the stem
            while longer := [y for y in good if len(y) == len(x) + 1 and y.startswith(x) and y[-1] != " " and len(around[y]) >= 0.95 * len(around[x])]:
                x = longer[0]
            model.stems[x] = good[x]
    # fixed words that the labels speak against go; a stem that only one word has is that word
    model.words = {w: o for w, o in model.words.items() if counts[0][w + " "] >= 20 * counts[1][w + " "] * total[0] / total[1] or not counts[1][w + " "]}
    scorer = Scorer(model)
    model.logistic = _logistic([scorer.features(t) for t in [*toxic, *clean]], [1] * total[0] + [0] * total[1], [rates[0]] * total[0] + [rates[1]] * total[1])
    return model


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5


def fit_labels(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fits on labelled rows outside fold 0, at most ``rows`` of a class, chosen by hash of doc_id. Rows with a null label or id are left out;
    of repeated labels the larger holds."""
    held = labels.where((fold(F.col("doc_id")) != 0) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = {r["label"]: r["n"] for r in held.groupBy((F.col("toxic") == 1).alias("label")).agg(F.count("*").alias("n")).collect()}
    chosen = []
    for label in (1, 0):
        chosen += [(r["doc_id"], label) for r in held.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id").collect()]
    if not chosen:
        return Model()
    spark = docs.sparkSession
    ids = spark.createDataFrame(chosen, "doc_id long, toxic int")
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    texts.sort(key=lambda r: r["doc_id"])
    toxic, clean = ([r["text"] for r in texts if bool(r["toxic"]) is label] for label in (True, False))
    return fit(toxic, clean, (there.get(True, 0) / max(1, len(toxic)), there.get(False, 0) / max(1, len(clean))))


def score(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, n_clauses, top_clause) of every row of docs, in any order; predicted: score >= 0.5.

    Null and empty texts have the score of a text without hits. Other columns are not read; repeated rows stay."""
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            rows = []
            for t in batch.column(1):
                text = t.as_py()
                found = scorer.clauses(text)
                top = max(found, key=lambda c: c[2], default=None)
                a, b, c = scorer.m.logistic
                z = a + b * (top[2] if top else 0.0) + c * math.log1p(sum(x[2] for x in found))
                rows.append((1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), len(found), text[top[0] : top[1]].strip() if top else None))
            scores = [r[0] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string())],
                ["id", "score", "predicted", "n_clauses", "top_clause"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double, predicted int, n_clauses int, top_clause string")


def drop_toxic(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that the model does not reject, with all their columns: decided from each row's text in one pass. Null and empty texts have no hits and
    stay, unless the model has no other rule than to reject; repeated rows are decided alike. No rows: no rows."""
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            keep = [scorer.score(t.as_py()) < 0.5 for t in batch.column(names.index("text"))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
