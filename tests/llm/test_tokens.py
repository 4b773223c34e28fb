from __future__ import annotations

import dataclasses
import hashlib
import json
import math
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybrook.llm import bpe, lm
from tallybrook.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
ODD = ["", " ", None, "a" * 3000, "aaaa aaa", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "It's 12½ Ⅷ ΣΑΣ İ ﬁ é́ \x1c\x1f\x85 中文🙂 can't", "\n\t\r\x0b\x0c"]


@pytest.fixture(scope="module")
def codec():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.Codec(bpe.Vocabulary(f.read()))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def _same(codec, library, texts):
    for t, (ids, decoded) in zip(texts, codec.encode(texts), strict=True):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(t)
        assert decoded.decode() == library.decode(want, skip_special_tokens=False) == codec.decode(ids)


def test_odd_texts_are_encoded_as_by_the_library(codec, library):
    _same(codec, library, ODD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdeé ßÉ'stTΣσ  \t\n123²Ⅷ!?.<|>_-ﬁ中🙂"), max_size=30), max_size=5))
def test_random_texts_are_encoded_as_by_the_library(codec, library, texts):
    _same(codec, library, texts)


def test_query_rows_for_nulls_repeats_and_other_columns(spark, codec):
    rows = [(1, "Hello hello", "x", 5), (2, None, "y", 6), (1, "Hello hello", "x", 5), (None, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    found = bpe.digests(bpe.encode_decode(spark, docs, vocabulary_path())).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["decoded_sha256"] == empty) for r in found) == [(0, 0, True), (1, 2, False), (1, 2, False), (2, 0, True)]
    assert bpe.digests(bpe.encode_decode(spark, docs.limit(0), vocabulary_path())).count() == 0


def _texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    syllables = "ka lo mi ter an sto ve".split()
    words = ["".join(rng.choices(syllables, k=3)) for _ in range(60)]
    return [" ".join(rng.choices(["the", "of", *words], k=rng.randint(3, 80))) for _ in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abé'sÉ12½²!?._ \x85\xa0\u2003\u3000\x1c\x1f中🙂\u0301"), min_size=1, max_size=6), min_size=1, max_size=8))
def test_lm_words_cut_together_are_as_cut_alone(texts):
    with open(vocabulary_path("byte_bpe_50k.tiktoken"), encoding="ascii") as f:
        cut = lm._subwords(f.read())
    words = [w for t in texts for w in lm.words_of(t)]
    cut.know({words[0]: 3, lm.END_WORD: 1} if words else {})
    ids, sizes = cut.flat(words)
    assert [cut.count[n] for n in cut.numbers(words)] == [3 if w == words[0] else 0 for w in words] and cut.count[0] == bool(words)
    assert ids.tolist() == [i for w in words for i in cut.encode(" " + w.decode())] and sizes.tolist() == [len(cut.encode(" " + w.decode())) for w in words]


def test_lm_words_are_forgotten_but_the_frequent_ones(monkeypatch):
    monkeypatch.setattr(lm, "KEPT", 50)
    with open(vocabulary_path("byte_bpe_50k.tiktoken"), encoding="ascii") as f:
        cut = lm.Subwords(f.read()).know({b"often": 7, lm.END_WORD: 2})
    for k in range(40):
        words = [b"often", *(b"word%d" % (30 * k + j) for j in range(30)), lm.END_WORD]
        numbers = cut.numbers(words)
        ids, sizes = cut.ids(numbers)
        assert ids.tolist() == [i for w in words for i in (cut.encode(" " + w.decode()) if w else [cut.end])] and cut.count[numbers].tolist() == [7] + [0] * 30 + [2]
        assert len(cut.number) < 90


def test_lm_windows_score_each_id_once():
    for sizes in ([1], [lm.WINDOW], [lm.WINDOW + 1], [3, 100, 1, 57, 24, 25]):
        sizes = np.array(sizes)
        flat = np.arange(sizes.sum()) % 5
        _, _, at, fresh, _ = lm._windows(flat, flat, sizes, 0)
        assert sorted(at[fresh].tolist()) == list(range(sizes.sum()))


def _model(texts):
    with open(vocabulary_path("byte_bpe_50k.tiktoken"), encoding="ascii") as f:
        cut = lm.Subwords(f.read())
    words = [[*lm.words_of(t), lm.END_WORD] for t in texts]
    flat, sizes = cut.flat([w for t in words for w in t])
    sizes = np.add.reduceat(sizes, np.cumsum([0, *map(len, words[:-1])]))
    counts = np.bincount(flat, minlength=cut.end + 1).astype(float)
    rows = lm.rows_of(counts)
    n = int(rows.max()) + 1
    pairs = np.zeros((n, n))
    np.add.at(pairs, (rows[np.append(cut.end, flat[:-1])], rows[flat]), 1)
    return cut, flat, sizes, lambda: lm.start(rows, lm.classes_of(rows, pairs), counts, pairs)


def _blocks(model, flat, sizes, share=1.0):
    hashes = np.arange(len(sizes), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return lm.drawn(np.append(model.rows[-1], model.rows[flat]).astype(np.int64), sizes, hashes, share)


def _trained(model, flat, sizes):
    squares = {p: np.full(getattr(model, p).shape, 1e-4, np.float32) for p in lm.PARTS}
    hashes, blocks = _blocks(model, flat, sizes)
    lm.train(model, squares, blocks[np.argsort(hashes)])
    model.tame = lm._tame(model)
    return model


def test_lm_attention_is_causal_and_a_distribution():
    texts = _texts(60, 1)
    cut, flat, sizes, start = _model(texts)
    model = _trained(start(), flat, sizes)
    # the probabilities of all ids after a prefix sum to one
    prefix = flat[:5]
    every = np.arange(0, cut.end + 1)
    some = np.concatenate([np.append(prefix, i) for i in every]).astype(np.int32)
    each = lm.log_p(model, some, np.full(len(every), 6), cut.end).reshape(-1, 6).sum(1) - lm.log_p(model, prefix, np.array([5]), cut.end).sum()
    assert math.isclose(np.exp(each).sum(), 1, rel_tol=1e-3)
    # what follows changes nothing before
    z1, *_ = lm.forward(model, model.rows[flat[None, : lm.WINDOW]])
    changed = flat[None, : lm.WINDOW].copy()
    changed[0, 20:] = flat[0]
    z2, *_ = lm.forward(model, model.rows[changed])
    assert np.allclose(z1[0, :20], z2[0, :20], atol=1e-5)
    # training beats the counts alone
    assert lm.log_p(model, flat, sizes, cut.end).sum() > lm.log_p(start(), flat, sizes, cut.end).sum()


def test_lm_blocks_cover_whole_texts():
    _, flat, sizes, start = _model([*_texts(30, 3), "", "one", " ".join(_texts(40, 5))])
    model = start()
    rows = np.append(model.rows[-1], model.rows[flat])
    hashes, blocks = _blocks(model, flat, sizes)
    want, at = [], 0
    for n in sizes.tolist():
        want += [rows[at + k : at + min(k + lm.WINDOW, n) + 1].tolist() for k in range(0, n, lm.WINDOW)]
        at += n
    assert [b[b >= 0].tolist() for b in blocks] == want and len(set(hashes.tolist())) == len(hashes)
    assert sum(len(w) - 1 for w in want) == len(flat)  # each id is a target once
    _, some = _blocks(model, np.tile(flat, 30), np.tile(sizes, 30), 0.25)
    assert 0.2 < len(some) / (30 * len(blocks)) < 0.3


def test_lm_gradients_are_those_of_the_loss():
    _, flat, sizes, start = _model(_texts(20, 6))
    _, blocks = _blocks(start(), flat, sizes)
    blocks = blocks[:2]

    def loss(m):
        before, target = np.maximum(blocks[:, :-1], 0).astype(int), blocks[:, 1:].astype(int)
        of_row = np.zeros(len(m.last), int)
        of_row[m.rows] = m.cls
        z = lm.forward(m, before)[0].astype(np.float64)
        p = z - np.log(np.exp(z - z.max(-1, keepdims=True)).sum(-1, keepdims=True)) - z.max(-1, keepdims=True)
        use = target >= 0
        return -np.take_along_axis(p, of_row[np.maximum(target, 0)][..., None], 2)[..., 0][use].mean()

    rng, model = np.random.default_rng(1), start()
    model.out += rng.normal(0, 0.3, model.out.shape).astype(np.float32)
    for name in lm.PARTS:
        stepped = dataclasses.replace(model, **{p: getattr(model, p).copy() for p in lm.PARTS})
        squares = {p: np.full(getattr(model, p).shape, 1e12, np.float32) for p in lm.PARTS}  # so that a step is RATE / 1e6 times the gradient
        before = {p: getattr(stepped, p).astype(np.float64) for p in lm.PARTS}
        for p in lm.PARTS:
            setattr(stepped, p, before[p].astype(np.float64))
        lm.train(stepped, {p: x.astype(np.float64) for p, x in squares.items()}, blocks)
        slope = (before[name] - getattr(stepped, name)) * 1e6 / lm.RATE
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        eps = 1e-2
        moved = []
        for sign in (1, -1):
            other = dataclasses.replace(model, **{p: getattr(model, p).astype(np.float64) for p in lm.PARTS})
            getattr(other, name)[at] += sign * eps
            moved.append(loss(other))
        assert math.isclose((moved[0] - moved[1]) / (2 * eps), slope[at], rel_tol=0.05, abs_tol=1e-5), name


def _slow_log_p(m, ids, end):
    """Natural logarithm of each id's probability, id by id and window by window, without batches or masks."""
    out, d, step = [], lm.WIDTH, lm.WINDOW - lm.OVERLAP
    for at, i in enumerate(ids):
        k = 0 if at < lm.WINDOW else -(-(at - lm.WINDOW + 1) // step)
        first = k * step
        seen = [m.rows[end] if p == 0 else m.rows[ids[p - 1]] for p in range(first, at + 1)]
        x = [m.qkv[r] + m.place[p] for p, r in enumerate(seen)]
        e = np.array([math.exp(float(x[-1][:d] @ y[d : 2 * d])) for y in x])
        h = sum(w * y[2 * d :] for w, y in zip(e / e.sum(), x, strict=True))
        z = (m.last[seen[-1]] + h @ m.out).astype(float)
        z -= z.max()
        out.append(z[m.cls[i]] - math.log(np.exp(z).sum()) + float(m.within[seen[-1], m.rows[i]]) + float(m.shared[i]))
    return out


@pytest.mark.parametrize("head", [1, 150_000])
def test_lm_scores_and_base_against_brute_force(spark, monkeypatch, head):
    import zlib
    from collections import Counter

    monkeypatch.setattr(lm, "HEAD", head)
    fitted, fit = [], lm.fit
    monkeypatch.setattr(lm, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    texts = [*_texts(40, 2), " ".join(_texts(20, 4)), "", None, "Unseen UNSEEN words", "é\x1c x"]
    rows = [(k, t, "z") for k, t in enumerate(texts)] + [(3, texts[3], "z"), (None, "null id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = lm.score(spark, docs, vocabulary_path("byte_bpe_50k.tiktoken")).collect()
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5
    counts = Counter(w for i, t, _ in rows if fold(i) != 1 for w in [*lm.words_of(t), b""])
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((i if i is not None else -1, fold(i) == 1, len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w), 6)) for i, t, _ in rows for w in [[*lm.words_of(t), b""]])
    assert sorted((r["id"] if r["id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    with open(vocabulary_path("byte_bpe_50k.tiktoken"), encoding="ascii") as f:
        cut = lm.Subwords(f.read())
    scores = []
    for i, text, _ in rows:
        words = [*lm.words_of(text), b""]
        ids, sizes = cut.flat(words)
        each, at, score = _slow_log_p(fitted[0][0], ids.tolist(), cut.end), 0, 0.0
        for w, n in zip(words, sizes.tolist(), strict=True):
            score += math.log10(0.9 * math.exp(sum(each[at : at + n])) + 0.1 * counts[w] / (total + 0.5 * (distinct + 1)))
            at += n
        scores.append((-1 if i is None else i, score))
    alone = {-1 if r["id"] is None else r["id"]: r["attention_score"] for r in found}
    for i, text, _ in rows:
        ids, _ = cut.flat([*lm.words_of(text), b""])
        assert math.isclose(alone[-1 if i is None else i], sum(_slow_log_p(fitted[0][0], ids.tolist(), cut.end)) / math.log(10), rel_tol=1e-4)
    got = sorted((-1 if r["id"] is None else r["id"], r["score"]) for r in found)
    assert np.allclose([s for _, s in got], [s for _, s in sorted(scores)], rtol=1e-4)


def test_lm_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(spark, docs, vocabulary_path("byte_bpe_50k.tiktoken")).count() == 0


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_lm_beats_the_base_and_does_not_depend_on_tasks(spark):
    """Bits a word of the held-out fold: the model's are fewer than the unigram base's, and the same from one task or sixteen."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bits = []
    for tasks in (1, 16):
        found = lm.score(spark, docs.repartition(tasks), vocabulary_path("byte_bpe_multi_50k.tiktoken")).where("held_out")
        n, base, score = found.selectExpr("sum(n_tokens)", "sum(base_score)", "sum(score)").first()
        bits.append(-score / n * math.log2(10))
        assert bits[-1] < -base / n * math.log2(10)
    assert abs(bits[0] - bits[1]) < 0.01


def test_lm_shards_are_averaged(spark):
    texts = _texts(400, 7)
    _, flat, sizes, start = _model(texts)
    hashes, blocks = _blocks(start(), flat, sizes)
    df = spark.createDataFrame([(int(h), b.tobytes()) for h, b in zip(hashes, blocks, strict=True)], "hash long, block binary")
    loss = lambda m: -lm.log_p(m, flat, sizes, len(start().rows) - 1).mean()
    one, many = (lm.trained(df.repartition(parts), start(), len(blocks), shard=len(blocks) // shards) for parts, shards in ((2, 1), (5, 8)))
    again = lm.trained(df.repartition(7), start(), len(blocks), shard=len(blocks) // 8)
    assert all(np.allclose(getattr(many, p), getattr(again, p), atol=1e-3) for p in lm.PARTS)
    assert loss(one) < loss(start()) and loss(many) < loss(start())


def test_lm_trains_on_every_id_of_every_training_text(spark, monkeypatch):
    texts = [*_texts(300, 8), "", None, " ".join(_texts(30, 9))]
    seen, trained = [], lm.trained
    monkeypatch.setattr(lm, "trained", lambda blocks, model, n: seen.append((blocks.collect(), n)) or trained(blocks, model, n))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    lm.fit(spark, docs, vocabulary_path("byte_bpe_50k.tiktoken"))
    (rows, n), cut = seen[0], _model(["a"])[0]
    learned = [r.text for r in docs.where(lm.in_training(docs.id)).collect()]
    blocks = [np.frombuffer(r["block"], np.int16) for r in rows]
    assert n == len(rows) and all(len(b) == lm.WINDOW + 1 for b in blocks)
    assert sum((b[1:] >= 0).sum() for b in blocks) == sum(len(cut.flat([*lm.words_of(t), lm.END_WORD])[0]) for t in learned)


def test_lm_sums_of_runs():
    rng = np.random.default_rng(4)
    for sizes in ([1], [5], [1] * 40, [300, 2, 1, 90, *rng.integers(1, 6, 50).tolist()], [7] * 30):
        g, first = rng.normal(size=(sum(sizes), 3)), np.cumsum([0, *sizes[:-1]])
        assert np.allclose(lm._sums(first, len(g))(g), np.add.reduceat(g, first, axis=0))


def test_lm_equal_blocks_of_a_step_are_worked_out_once(monkeypatch):
    _, flat, sizes, start = _model(_texts(20, 12))
    _, blocks = _blocks(start(), flat, sizes)
    seen, attend = [], lm.attend
    monkeypatch.setattr(lm, "attend", lambda m, before, first=0: seen.append(len(before)) or attend(m, before, first))
    copies = lm.STEP // 12
    models = []
    for found in (np.repeat(blocks[:12], copies, 0), np.tile(blocks[:12], (copies, 1))):  # side by side, and apart
        models.append(start())
        lm.train(models[-1], {p: np.full(getattr(models[-1], p).shape, 1e-4, np.float32) for p in lm.PARTS}, found)
    assert seen == [12, 12 * copies]  # before: all copies both times
    assert all(np.allclose(getattr(models[0], p), getattr(models[1], p), atol=1e-3) for p in lm.PARTS)


def test_lm_texts_of_a_batch_are_cut_as_alone():
    import pyarrow as pa

    for texts in ([*ODD, " x Y  z\n", *_texts(40, 13)], [""], [None, "a", ""], []):
        words, place, sizes, joined = lm.cut_texts(pa.array(texts, pa.string()))
        want = [[*lm.words_of(t), lm.END_WORD] for t in texts]
        held = lm._bytes(words)
        assert [held[k] for k in place] == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want] and held[-1] == lm.END_WORD
        assert lm._bytes(joined) == [b" ".join(t[:-1]) for t in want]
        spans = list(lm._together(sizes, 30))
        assert [k for at, after, _, _ in spans for k in range(at, after)] == list(range(len(texts)))
        assert all(sizes[:at].sum() == word and sizes[:after].sum() == end and (end - word <= 30 or after == at + 1) for at, after, word, end in spans)


def test_new_chunks_of_a_batch_are_cut_in_one_go(codec, library):
    own, calls = bpe.Codec(codec.v), []
    cut = own.words

    class Counting:
        def findall(self, text):
            calls.append(text)
            return cut.findall(text)

    own.words = Counting()
    texts = [*_texts(50, 11), None, "", *(f"Wörd{k}, x{k}Σ don't" for k in range(500))]
    _same(own, library, texts)
    assert len(calls) == 1  # before: 1,060, one for each new chunk
    _same(own, library, [*ODD, *texts])


def test_ranks_of_pairs_are_those_of_the_file(codec):
    with open(vocabulary_path(), encoding="utf-8") as f:
        held = json.load(f)["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in held["merges"]]
    ids = np.array([(held["vocab"][a], held["vocab"][b]) for a, b in merges], np.int64)
    keys = (ids[:, 0] << 32) | ids[:, 1]
    assert codec.v.ranks_of(keys).tolist() == list(range(len(keys)))
    other = np.setdiff1d(np.random.default_rng(2).integers(0, 49_000, 100_000) << 32 | np.arange(100_000) % 49_000, keys)
    assert (codec.v.ranks_of(other) == bpe.NONE).all()
