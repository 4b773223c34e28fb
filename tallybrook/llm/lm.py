"""Language-model scoring: a causal self-attention model over subword ids, trained in numpy.

A text is a sequence of words (A-Z lower-cased) and one end. A public byte-level vocabulary cuts each word, with a space before it, into ids, so the
ids determine the words. The attention model gives p(class of the next id | ids before) * p(id | class, last id): the class logits are a learned
row for the last id, started from corpus counts, plus the output of causal self-attention over the window; p(id | class, last id) are
smoothed counts. Long texts are read in overlapping windows; each id is scored once, by the window in which it has at least OVERLAP ids before it. A word's
probability is mixed, with fixed weights, from the attention model's and its share of the training words.

All of it is learned from all training texts: counts of words, of ids and of pairs of ids are summed in Spark, and the ids with rows and the classes are chosen by those
counts. The attention weights are trained on blocks of WINDOW ids, which a text is cut into from end to end, on all blocks of all training texts, each once.
Blocks are dealt out by hash, not by file, to as many shards as their number asks for. Training goes in rounds: each shard starts from the same
weights, steps through its blocks of the round, and the weights of all shards are averaged in Spark before the next round. How texts are split over files and tasks changes nothing.
The words with the largest counts, HEAD of them, are broadcast; all others are joined by a shuffle.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import materialise, row_id, short_batches

#: Blocks of a shard, rounds, blocks of a step, and the first step's rate, which falls to a tenth.
SHARD, ROUNDS, STEP, RATE = 98_304, 4, 96, 0.8
#: Ids with a row of their own (all others share one), classes, width of a head, window, ids of context at least, windows at once.
ROWS, CLASSES, WIDTH, WINDOW, OVERLAP, BATCH = 1500, 96, 16, 32, 4, 48
#: Words whose counts are broadcast at most, other words that a worker keeps, and distinct words that a counting task sums at least before it hands them on.
HEAD, KEPT, HELD = 150_000, 300_000, 300_000
#: Weight of a word's share of the corpus; the attention model has the rest.
OF_CORPUS = 0.1
#: What is added to the counts of ids, of (last id, class) by class share, and of ids after the last id by their share of the class.
ADD_ID, ADD_CLASS, ADD_PAIR = 0.05, 0.2, 10.0
#: The pattern that cuts text before merges; a fixed value of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Key of the end among words.
END_WORD = b""


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; the only white space is space and the controls from tab to carriage return."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Subwords:
    """A table of words: each has a number, its ids, and its count in the corpus. Words of a list of frequent ones stay, others as long as there is room; id ``end`` closes a text."""

    def __init__(self, rank_file: str) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines())}
        self.encode = tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.end = max(ranks.values()) + 1
        self.bytes = np.zeros(self.end + 1, np.int64)
        self.bytes[list(ranks.values())] = list(map(len, ranks))
        self.counts: dict[bytes, int] | None = None
        self.know({})

    def know(self, counts: dict[bytes, int]) -> Subwords:
        """From now on words have these counts, others 0, and the table begins with the counted ones."""
        if counts is not self.counts:
            self.counts, self.base = counts, {}
            self.forget()
            self.learn([w for w in counts if w != END_WORD])
            self.base, self.base_ids = dict(self.number), self.n_ids
        return self

    def forget(self) -> None:
        """Back to the words that stay."""
        if self.base:
            self.number, self.n_ids = dict(self.base), self.base_ids
            return
        self.number, self.n_ids = {END_WORD: 0}, 1
        self.pool, self.first, self.size, self.count = np.full(1 << 16, self.end, np.int32), np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.int64), np.zeros(1 << 16)
        self.count[0] = self.counts.get(END_WORD, 0)

    def learn(self, words: list[bytes]) -> None:
        """Takes in new words, which are cut together, each with a space before it; the bytes that the ids stand for say where a word ends."""
        if not words:
            return
        ids = np.array(self.encode(" " + b" ".join(words).decode("utf-8", "replace")), np.int32)
        ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)) + 1
        old, n = len(self.number), len(words)
        for name, least in (("pool", self.n_ids + len(ids)), ("first", old + n), ("size", old + n), ("count", old + n)):
            held = getattr(self, name)
            if len(held) < least:
                setattr(self, name, np.concatenate([held, np.zeros(max(least, 2 * len(held)) - len(held), held.dtype)]))
        starts = np.append(0, ends[:-1])
        self.pool[self.n_ids : self.n_ids + len(ids)] = ids
        self.first[old : old + n], self.size[old : old + n] = starts + self.n_ids, ends - starts
        self.count[old : old + n] = np.fromiter(map(self.counts.get, words, repeat(0)), np.float64, n)
        self.number.update(zip(words, range(old, old + n), strict=True))
        self.n_ids += len(ids)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers in the table, until the next call."""
        if len(self.number) > KEPT + len(self.base):
            self.forget()
        found = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            self.learn(list(dict.fromkeys(fresh)))
            found[new] = np.fromiter(map(self.number.get, fresh), np.int64, len(new))
        return found

    def flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in one array, and how many each has; the empty word is a text's end."""
        return self.ids(self.numbers(words))

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[numbers]
        shift = self.first[numbers] - (np.cumsum(size) - size)
        return self.pool[np.repeat(shift, size) + np.arange(size.sum())], size


@dataclass
class Model:
    """rows: id -> row; cls: id -> class; within: log p(row | class, last row); shared: log p(id | row), 0 for ids with a row of their own;
    last: logits by (row, class); qkv: by row; place: by position; out: head -> logits; tame: no exponent can overflow."""

    rows: np.ndarray
    cls: np.ndarray
    within: np.ndarray
    shared: np.ndarray
    last: np.ndarray
    qkv: np.ndarray
    place: np.ndarray
    out: np.ndarray
    tame: bool = False


def rows_of(id_counts: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """The row of each id: the most frequent ids have their own, all others share the last."""
    top = np.argsort(-id_counts, kind="stable")[: rows - 1]
    top = top[id_counts[top] > 0]
    row = np.full(len(id_counts), len(top), np.int32)
    row[top] = np.arange(len(top))
    return row


def classes_of(rows: np.ndarray, pair_counts: np.ndarray, classes: int = CLASSES, seed: int = 5) -> np.ndarray:
    """The class of each id, by k-means of rows over what precedes and follows them; ids without a row of their own share the last class."""
    n = len(pair_counts)
    of_row = np.full(n, classes - 1, np.int32)
    if n - 1 <= classes - 1:
        of_row[: n - 1] = np.arange(n - 1)
        return of_row[rows]
    common = np.argsort(-(pair_counts.sum(0) + pair_counts.sum(1)), kind="stable")[:300]
    near = np.concatenate([pair_counts[:, common], pair_counts[common].T], 1)
    near = np.sqrt((near + 1e-3) / (near + 1e-3).sum(1, keepdims=True))[:-1]
    weight = pair_counts.sum(0)[:-1] + 1e-9
    rng = np.random.default_rng(seed)
    centre = near[rng.choice(len(near), classes - 1, replace=False, p=weight / weight.sum())]
    for _ in range(12):
        own = np.argmin((centre**2).sum(1) - 2 * near @ centre.T, 1)
        for c in range(classes - 1):
            if (own == c).any():
                centre[c] = np.average(near[own == c], 0, weights=weight[own == c])
    of_row[: n - 1] = own
    return of_row[rows]


def _windows(rows: np.ndarray, cls: np.ndarray, sizes: np.ndarray, start_row: int) -> tuple[np.ndarray, ...]:
    """(inputs, targets' classes, targets' places in the flat array, which are scored) as rows of WINDOW places, and which windows have others before them. An input is the id before its target;
    before a text's first id stands the end's row. What a window has beyond its text is not scored, and nothing scored looks at it."""
    starts = np.cumsum(sizes) - sizes
    step = WINDOW - OVERLAP
    n = np.maximum(1, -(-(sizes - OVERLAP) // step))
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(starts, n) + k * step
    at = np.minimum(first[:, None] + np.arange(WINDOW), len(rows) - 1)
    last = np.append(rows.dtype.type(start_row), rows[:-1])
    last[starts] = start_row
    later = k > 0
    place = np.arange(WINDOW)
    return last.take(at), cls.take(at), at, (place < (np.repeat(starts + sizes, n) - first)[:, None]) & (place >= np.where(later, OVERLAP, 0)[:, None]), later


_MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def attend(m: Model, before: np.ndarray, first: int = 0) -> tuple[np.ndarray, ...]:
    """(heads at each place from ``first`` on, queries with keys and values, attention weights not yet divided by their sums, those sums)."""
    d = WIDTH
    x = m.qkv.take(before, 0)
    x += m.place
    q, k, v = x[:, first:, :d], x[..., d : 2 * d], x[..., 2 * d :]
    e = np.matmul(q, k.transpose(0, 2, 1))
    if not m.tame:
        np.clip(e, -30, 30, out=e)
    np.exp(e, out=e)
    e *= _MASK[first:]
    total = (e.reshape(-1, WINDOW) @ np.ones(WINDOW, e.dtype)).reshape(*e.shape[:2], 1)
    h = np.matmul(e, v)
    h /= total
    return h, x, e, total


def forward(m: Model, before: np.ndarray, first: int = 0) -> tuple[np.ndarray, ...]:
    """Logits of the classes after each place from ``first`` on, and what attend() gives."""
    h, x, e, total = attend(m, before, first)
    z = (h.reshape(-1, WIDTH) @ m.out).reshape(*h.shape[:2], -1)
    z += m.last.take(before[:, first:], 0)
    return z, x, e, h, total


def log_p(m: Model, flat: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """Natural logarithm of the probability of each id of texts with so many ids each. Of later windows only the places that are scored ask the others."""
    if not len(flat):
        return np.zeros(0)
    cls, rows = m.cls.take(flat), m.rows.take(flat)
    before, target, at, fresh, later = _windows(rows, cls, sizes, int(m.rows[end]))
    last = np.append(m.rows[end], rows[:-1])
    last[np.cumsum(sizes) - sizes] = m.rows[end]
    out = (m.within[last, rows] + m.shared.take(flat)).astype(np.float64)
    classes = m.last.shape[1]
    one, first_of = np.ones(classes, m.last.dtype), np.arange(BATCH * WINDOW) * classes
    for which, first in ((np.flatnonzero(~later), 0), (np.flatnonzero(later), OVERLAP)):
        for i in range(0, len(which), BATCH):
            w = which[i : i + BATCH]
            z, *_ = forward(m, before[w], first)
            z = z.reshape(-1, classes)
            if not m.tame:
                np.clip(z, -80, 80, out=z)
            use = np.flatnonzero(fresh[w, first:])
            picked = z.ravel().take(first_of[: len(z)] + target[w, first:].ravel())
            np.exp(z, out=z)
            picked -= np.log(z @ one)
            out[at[w, first:].ravel().take(use)] += picked.take(use)
    return out


def drawn(rows: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, share: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, rows) of all blocks, or a share of them, of texts of so many ids each (rows: that of the end, then those of all ids): the row before a block and those of its ids, -1 after a text's end."""
    n = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    mix = (k.astype(np.uint64) + hashes[text]) * np.uint64(0x9E3779B97F4A7C15)
    mix = (mix ^ (mix >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    mix ^= mix >> np.uint64(29)
    use = np.flatnonzero((mix >> np.uint64(11)) / float(1 << 53) < share) if share < 1 else np.arange(len(mix))
    starts = np.cumsum(sizes) - sizes
    place = (k[use] * WINDOW)[:, None] + np.arange(WINDOW + 1)
    inside = place <= sizes[text[use]][:, None]
    found = np.where(inside, rows[np.where(inside, starts[text[use]][:, None] + place, 0)], -1)
    return (mix[use] * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), found.astype(np.int16)


PARTS = ("last", "qkv", "place", "out")


def _levels(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(rows, order, levels, left) for places with rows ``of``, below n: the rows that occur, the most frequent ones first, and an order in which their first places lie together, then all second ones, and
    so on, then what the few most frequent ones have left, row by row. levels: (from, to, number of rows, from the first on); left: (from, to, the row's place among rows)."""
    count = np.bincount(of, minlength=n)
    rows = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
    size = count[rows]
    there = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # how many rows have a first place, a second, ...
    deep = max(1, int((there >= 12).sum()))
    ends = np.cumsum(there[:deep]).tolist()
    levels = list(zip([0, *ends[:-1]], ends, there[:deep].tolist(), strict=True))
    more = size[: there[deep] if deep < len(there) else 0] - deep
    after = (ends[-1] + np.cumsum(more)).tolist()
    left = list(zip([ends[-1], *after[:-1]], after, range(len(more)), strict=False))
    rank = np.zeros(n, np.int16)
    rank[rows] = np.arange(len(rows))
    level = np.minimum(np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size), deep).astype(np.int16)
    order = np.argsort(rank.take(of), kind="stable").take(np.argsort(level, kind="stable"))  # 16 bits are sorted by radix
    return rows, order, levels, left


def _summed(g: np.ndarray, levels: list[tuple[int, int, int]], left: list[tuple[int, int, int]]) -> np.ndarray:
    """For each row of _levels(), the sum of its places of an array in that order."""
    total = g[: levels[0][1]].copy()
    for a, b, c in levels[1:]:
        total[:c] += g[a:b]
    for a, b, i in left:
        total[i] += np.add.reduce(g[a:b], 0)
    return total


def _sums(first: np.ndarray, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """Sums of runs of rows that begin at ``first`` and end where the next begins, or at n."""
    runs, order, levels, left = _levels(np.repeat(np.arange(len(first)), np.diff(np.append(first, n))), len(first))

    def run(g: np.ndarray) -> np.ndarray:
        out = np.empty_like(g, shape=(len(first), *g.shape[1:]))
        out[runs] = _summed(g.take(order, 0), levels, left)
        return out

    return run


def train(m: Model, squares: dict[str, np.ndarray], found: np.ndarray, done: float = 0.0, until: float = 1.0) -> None:
    """Steps through blocks (as of drawn()) in their order, in place: gradients of the cross-entropy of the classes, each weight's step divided by the root of its summed
    ``squares``. done and until: what part of the training is over before and after. Equal blocks that follow each other in a step, as those of equal texts do, are worked out once and weigh as many as
    they are. Logits are made in the order of _levels() by the last ids' rows, so that sums over the places of a row are sums of whole slices."""
    of_row = np.zeros(len(m.last) + 1, np.int64)
    of_row[m.rows] = m.cls
    d, m.tame, kind, classes = WIDTH, False, m.last.dtype.type, m.last.shape[1]
    steps = -(-len(found) // STEP)
    one, ones = np.ones(classes, kind), np.ones(d, kind)
    for t in range(steps):
        block = found[t * STEP : (t + 1) * STEP]
        distinct = np.flatnonzero(np.append(True, (block[1:] != block[:-1]).any(1)))
        weight = np.diff(np.append(distinct, len(block)))
        block = block.take(distinct, 0)
        before, target = np.maximum(block[:, :-1], 0).astype(np.intp), block[:, 1:]
        share = (target >= 0) * weight[:, None]
        share = (share / kind(max(1, share.sum()))).astype(kind)
        own, order, levels, left = _levels(before.ravel(), len(m.last))
        wanted, share = of_row.take(target.ravel().take(order), mode="wrap"), share.ravel().take(order)  # -1, after a text's end, has no share
        h, x, e, total = attend(m, before)
        e /= total
        head = h.reshape(-1, d).take(order, 0)
        z = head @ m.out
        last = m.last.take(own, 0)
        for a, b, c in levels:
            z[a:b] += last[:c]
        for a, b, i in left:
            z[a:b] += last[i]
        if not -80 < z.min() <= z.max() < 80:
            np.clip(z, -80, 80, out=z)
        np.exp(z, out=z)
        z *= (share / (z @ one))[:, None]
        z.reshape(-1)[np.arange(0, z.size, classes) + wanted] -= share
        dh = np.empty_like(head)
        dh[order] = z @ m.out.T
        dh = dh.reshape(h.shape)
        q, k, v = x[..., :d], x[..., d : 2 * d], x[..., 2 * d :]
        ds = np.matmul(dh, v.transpose(0, 2, 1))
        ds -= ((dh * h).reshape(-1, d) @ ones).reshape(total.shape)  # the mean of ds by the attention weights
        ds *= e
        dx = np.empty_like(x)
        for part, a, b in ((0, ds, k), (1, ds.transpose(0, 2, 1), q), (2, e.transpose(0, 2, 1), dh)):
            np.matmul(a, b, out=dx[..., part * d : (part + 1) * d])
        pace = kind(RATE * (1 - 0.9 * (done + (until - done) * t / steps)))
        for name, at, g in (("last", own, _summed(z, levels, left)), ("qkv", own, _summed(dx.reshape(-1, 3 * d).take(order, 0), levels, left)), ("place", slice(None), dx.sum(0)), ("out", slice(None), (z.T @ head).T)):
            root = squares[name][at] + g * g
            squares[name][at] = root
            g *= pace
            g /= np.sqrt(root, out=root)
            getattr(m, name)[at] -= g


def _tame(m: Model) -> bool:
    """Whether no input can make an exponent large: by the norms of queries, keys, values and output weights."""
    norm = lambda a: float(np.linalg.norm(a, axis=-1).max(initial=0))
    part = lambda i: norm(m.qkv[:, i * WIDTH : (i + 1) * WIDTH]) + norm(m.place[:, i * WIDTH : (i + 1) * WIDTH])
    return part(0) * part(1) < 80 and float(np.abs(m.last).max(initial=0)) + part(2) * norm(m.out.T) < 80


def start(rows: np.ndarray, cls: np.ndarray, id_counts: np.ndarray, pair_counts: np.ndarray, classes: int = CLASSES, seed: int = 3) -> Model:
    """A model from counts alone (of ids; of rows after rows): last-id rows are logarithms of smoothed class shares, attention starts small."""
    n = len(pair_counts)
    smooth = id_counts + ADD_ID
    of_row = np.bincount(rows, weights=smooth, minlength=n)
    row_class = np.full(n, classes - 1)
    row_class[rows] = cls
    share = of_row / np.bincount(row_class, weights=of_row, minlength=classes)[row_class]
    by_class = np.zeros((n, classes))
    np.add.at(by_class.T, row_class, pair_counts.T)
    within = np.log((pair_counts + ADD_PAIR * share) / (by_class[:, row_class] + ADD_PAIR)).astype(np.float32)
    shared = np.log(smooth / of_row[rows]).astype(np.float32)
    overall = (by_class.sum(0) + 1.0) * (np.bincount(row_class, minlength=classes) > 0)  # a class without ids gets nothing
    shares = by_class + ADD_CLASS * classes * overall / overall.sum()
    last = np.log(np.maximum(shares / shares.sum(1, keepdims=True), 1e-13)).astype(np.float32)
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return Model(rows, cls, within, shared, last, draw(n, 3 * WIDTH), draw(WINDOW, 3 * WIDTH), np.zeros((WIDTH, classes), np.float32))


@functools.lru_cache(1)
def _subwords(rank_file: str) -> Subwords:
    return Subwords(rank_file)


def in_training(id_col: Column, held_out: int = 1) -> Column:
    """crc32 of the id as text, modulo 5, is not held_out; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 != held_out


def cut_texts(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """(distinct words, the place among them of each word of each text in turn, how many words each text has, each text's words with single spaces). A text's last word is its end, the empty word,
    which is the last of the distinct ones. Words are those of words_of()."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.ascii_trim_whitespace(pc.fill_null(column, ""))))
    coded = lists.flatten().dictionary_encode()
    sizes, found = pc.list_value_length(lists).to_numpy(), coded.indices.to_numpy()
    empty = coded.dictionary.index(pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:  # an empty text is one empty word
        there = found != empty
        sizes = np.diff(np.append(0, np.cumsum(there))[np.append(0, np.cumsum(sizes))])
        found = found[there]
    place = np.full(len(found) + len(sizes), len(coded.dictionary), np.int64)
    place[np.arange(len(found)) + np.repeat(np.arange(len(sizes)), sizes)] = found
    return pa.concat_arrays([coded.dictionary, pa.array([""], coded.dictionary.type)]), place, sizes.astype(np.int64) + 1, pc.binary_join(lists, " ")


def _bytes(words: pa.Array) -> list[bytes]:
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _together(n_words: np.ndarray, most: int = 8192) -> Iterator[tuple[int, int, int, int]]:
    """Texts that are taken at once, up to so many words or one text: (first, after, its first word, after its last)."""
    ends, at, word = np.cumsum(n_words), 0, 0
    while at < len(ends):
        after = max(at + 1, int(np.searchsorted(ends, word + most, "right")))
        yield at, after, word, int(ends[after - 1])
        at, word = after, int(ends[after - 1])


def count_words(texts: DataFrame) -> DataFrame:
    """(key, n) over all texts (text): each word, and the end as the empty word. Tasks sum what they meet in bounded tables before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["key", "n"])

        for batch in batches:
            words, place, _, _ = cut_texts(batch.column(0))
            n = np.bincount(place, minlength=len(words))
            held.append(pa.table({"key": words, "n": pa.array(n, pa.int64())}).filter(pa.array(n > 0)))
            if sum(map(len, held)) > 2 * HELD:
                held = [summed()]
                if len(held[0]) > HELD:
                    yield from held.pop().to_batches(10_000)
        if held:
            yield from summed().to_batches(10_000)

    return texts.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def count_ids(words: DataFrame, shared) -> DataFrame:
    """(id, n) from the counts of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _subwords(shared.value)
        ids = np.zeros(cut.end + 1, np.int64)
        for batch in batches:
            flat, sizes = cut.flat(_bytes(batch.column(0)))
            np.add.at(ids, flat, np.repeat(batch.column(1).to_numpy(), sizes))
        some = np.flatnonzero(ids)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(ids[some])], ["id", "n"])

    return words.select("key", "n").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _binary(found: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    ends = np.arange(len(found) + 1, dtype=np.int32) * (found.shape[1] * found.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(found))])


def _blocks(column: pa.Array) -> np.ndarray:
    """The blocks whose bytes a column holds."""
    size = (WINDOW + 1) * 2
    held = np.frombuffer(column.buffers()[2] or b"", np.uint8) if len(column) else np.zeros(0, np.uint8)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    return held[first : first + size * len(column)].view(np.int16).reshape(-1, WINDOW + 1)


def pairs_and_blocks(texts: DataFrame, shared, head, rows: np.ndarray) -> DataFrame:
    """(a, b, n, hash, block) over all texts (text): how often row b follows row a, as far as a task has seen (before a text stands the end's row); and all blocks."""
    table = texts.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, rows = _subwords(shared.value).know(head.value), table.value
        n_rows = int(rows.max()) + 1
        pairs, waiting = np.zeros(n_rows * n_rows, np.int64), []
        for batch in batches:
            words, place, n_words, joined = cut_texts(batch.column(0))
            numbers = cut.numbers(_bytes(words))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, _bytes(joined)), np.uint64, len(n_words))
            for at, after, word, end in _together(n_words):
                flat, each = cut.ids(numbers.take(np.append(len(words) - 1, place[word:end])))
                of = rows[flat].astype(np.int64)
                hashed, found = drawn(of, np.add.reduceat(each[1:], np.cumsum(n_words[at:after]) - n_words[at:after]), hashes[at:after])
                none = pa.nulls(len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array(hashed), _binary(found)], ["a", "b", "n", "hash", "block"])
                waiting.append(of[:-1] * n_rows + of[1:])
                if sum(map(len, waiting)) > len(pairs):
                    pairs += np.bincount(np.concatenate(waiting), minlength=len(pairs))
                    waiting.clear()
        pairs += np.bincount(np.concatenate([*waiting, np.zeros(0, np.int64)]), minlength=len(pairs))
        some = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(some // n_rows), pa.array(some % n_rows), pa.array(pairs[some]), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary())], ["a", "b", "n", "hash", "block"])

    return texts.mapInArrow(run, "a long, b long, n long, hash long, block binary")


def trained(blocks: DataFrame, model: Model, n_blocks: int, shard: int = SHARD, rounds: int = ROUNDS) -> Model:
    """The model with its attention weights trained on blocks (hash, block), in rounds: each shard steps through its blocks of a round from the same weights, and the averages of all
    shards' weights and squares, each weighing what its blocks weigh, begin the next round.

    A shard is about ``shard`` blocks, chosen by hash, in one task. Tasks add up their shards, and averages are made chunk by chunk in Spark: what reaches the driver is one model a round."""
    if not n_blocks:
        return model
    sc = blocks.sparkSession.sparkContext
    shards = -(-n_blocks // shard)
    held = blocks.select(F.pmod("hash", F.lit(shards)).alias("shard"), F.pmod(F.shiftright("hash", 40), F.lit(rounds)).alias("round"), "hash", "block")
    shapes = {p: getattr(model, p).shape for p in PARTS}
    size = 2 * sum(int(np.prod(x)) for x in shapes.values())
    chunk = -(-size // 16)
    state = [*(getattr(model, p) for p in PARTS), *(np.full(shapes[p], 1e-4, np.float32) for p in PARTS)]
    schema = "chunk int, n long, sums binary"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for c, n, x in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                before = sums.get(c, (0, 0.0))
                sums[c] = before[0] + n, before[1] + np.frombuffer(x, np.float32).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([x.astype(np.float32).tobytes() for _, x in sums.values()], pa.binary())], ["chunk", "n", "sums"])

    for r in range(rounds):
        table = sc.broadcast((replace(model, within=np.zeros(0), shared=np.zeros(0)), state))

        def run(batches: Iterator[pa.RecordBatch], r=r, table=table) -> Iterator[pa.RecordBatch]:
            start, state = table.value
            total, n = np.zeros(size), 0

            def step(parts: list[np.ndarray]) -> int:
                found = np.concatenate(parts).reshape(-1, WINDOW + 1)
                own = [x.copy() for x in state]
                m = replace(start, **dict(zip(PARTS, own, strict=False)))
                train(m, dict(zip(PARTS, own[len(PARTS) :], strict=True)), found, r / rounds, (r + 1) / rounds)
                total[:] += np.concatenate([x.ravel() for x in own]) * len(found)
                return len(found)

            now, parts = None, []
            for batch in batches:
                own = batch.column(0).to_numpy()
                whole = _blocks(batch.column(1))
                for first in np.flatnonzero(np.append(True, own[1:] != own[:-1])).tolist() if len(own) else []:
                    after = first + int(np.argmin(np.append(own[first:] == own[first], False)))
                    if own[first] != now and parts:
                        n, parts = n + step(parts), []
                    now = own[first]
                    parts.append(whole[first:after].copy())
            if parts:
                n += step(parts)
            if n:
                sums = [total[i : i + chunk].astype(np.float32).tobytes() for i in range(0, size, chunk)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()), pa.array(sums, pa.binary())], ["chunk", "n", "sums"])

        mine = held.where(F.col("round") == r).repartition("shard").sortWithinPartitions("shard", "hash", "block").select("shard", "block")
        found = mine.mapInArrow(run, schema).repartition(16, "chunk").mapInArrow(add, schema).collect()
        if found:
            flat = np.concatenate([np.frombuffer(x["sums"], np.float32) / x["n"] for x in sorted(found, key=lambda x: x["chunk"])])
            each = [shapes[p] for p in (*PARTS, *PARTS)]
            state = [x.reshape(shape).astype(np.float32) for x, shape in zip(np.split(flat, np.cumsum([int(np.prod(x)) for x in each])[:-1]), each, strict=True)]
        table.unpersist()
    model = replace(model, **dict(zip(PARTS, state, strict=False)))
    model.tame = _tame(model)
    return model


def frequent(counts: DataFrame) -> dict[bytes, int]:
    """The counts of the most frequent words, as far as whole steps of a logarithmic scale have no more than HEAD of them."""
    step = F.floor(64 * F.log2("n"))
    held, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["s"]):  # a few thousand rows
        held += r["k"]
        if held > HEAD:
            break
        least = r["s"]
    return {r["key"].encode("utf-8", "surrogatepass"): r["n"] for r in counts.where(step >= least).collect()} if least is not None else {}


def fit(spark: SparkSession, docs: DataFrame, vocabulary: str) -> tuple[Model, DataFrame, int, int, object, object]:
    """(model, written counts of words, N, V, the broadcast vocabulary file, the broadcast counts of frequent words) from the texts of docs (id, text) that are in training."""
    with open(vocabulary, encoding="ascii") as f:
        shared = spark.sparkContext.broadcast(f.read())
    texts = docs.where(in_training(F.col("id"))).select("text")
    words = materialise(spark, count_words(texts), "lm-words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ids = np.zeros(_subwords(shared.value).end + 1)
    held = count_ids(words, shared).toPandas()  # bounded by the vocabulary
    ids[held.id.to_numpy()] = held.n
    rows = rows_of(ids)
    head = spark.sparkContext.broadcast(frequent(words))
    found = materialise(spark, pairs_and_blocks(texts, shared, head, rows), "lm-pairs", "zstd")
    pairs = np.zeros((int(rows.max()) + 1,) * 2)
    held = found.where("n is not null").groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()  # bounded by ROWS squared
    pairs[held.a.to_numpy(), held.b.to_numpy()] = held.n
    model = start(rows, classes_of(rows, pairs), ids, pairs)
    blocks = found.where("block is not null").select("hash", "block")
    return trained(blocks, model, blocks.count()), words, total, distinct, shared, head


def score(spark: SparkSession, docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, attention_score, score.

    score: the log10 probability of the text's words and end, each word's the mixture of the attention model's and of c / (N + 0.5 (V + 1)); attention_score: by the attention model alone; base_score: the
    sum of log10((c + 0.5) / (N + 0.5 (V + 1))). Null and empty texts consist of the end alone. A null id counts as the empty text for the fold. Repeated rows stay; they
    count as often as they occur. Without training texts all counts are zero and the model is its start. Other columns are not read."""
    short_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    model, counts, total, distinct, shared, head = fit(spark, rows, vocabulary)
    below = float(total + 0.5 * (distinct + 1))
    table = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, model = _subwords(shared.value).know(head.value), table.value
        for batch in batches:
            words, place, all_words, _ = cut_texts(batch.column(1))
            distinct = cut.numbers(_bytes(words))
            for at, after, word, end in _together(all_words):
                own = place[word:end]
                n_words, numbers = all_words[at:after], distinct.take(own)
                first = np.cumsum(n_words) - n_words
                flat, sizes = cut.ids(numbers)
                of_word = np.add.reduceat(log_p(model, flat, np.add.reduceat(sizes, first), cut.end), np.cumsum(sizes) - sizes)
                c = cut.count[numbers]
                there = c > 0
                alone = np.add.reduceat(of_word, first) / np.log(10)
                of_word += np.log(1 - OF_CORPUS)
                base = np.where(there, np.log10((c + 0.5) / below), 0.0)
                mixed = np.where(there, np.log10(np.exp(of_word) + OF_CORPUS * c / below, where=there, out=np.zeros(len(c))), 0.0)
                other = np.flatnonzero(~there)
                tail = pa.StructArray.from_arrays([words.take(pa.array(own[other])), pa.array(of_word[other])], ["key", "p"])
                rest = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.add.reduceat((~there).astype(np.int32), first))).astype(np.int32)), tail)
                sums = [np.add.reduceat(x, first) for x in (there.astype(np.int64), base, mixed)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, after - at), pa.array(n_words), pa.array(alone), *map(pa.array, sums), rest],
                    ["id", "n_tokens", "attention_score", "head_known", "head_base", "head_score", "tail"],
                )

    schema = "id long, n_tokens long, attention_score double, head_known long, head_base double, head_score double, tail array<struct<key: string, p: double>>"
    scored = materialise(spark, rows.mapInArrow(run, schema).withColumn("row", row_id()), "lm-scored")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.key", "t.p")
    each = tail.join(counts, "key", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    below_ = F.lit(below)
    mixed = F.when(F.col("c") > 0, F.log10(F.exp("p") + F.lit(OF_CORPUS) * F.col("c") / below_)).otherwise(F.col("p") / F.lit(float(np.log(10))))
    rest = each.groupBy("row").agg(F.sum(F.log10((F.col("c") + 0.5) / below_)).alias("rest_base"), F.sum(mixed).alias("rest_score"), F.sum((F.col("c") > 0).cast("long")).alias("rest_known"))
    zero = F.lit(0.0)
    return scored.drop("tail").join(rest, "row", "left").select(
        "id", (~in_training(F.col("id"))).alias("held_out"), "n_tokens",
        (F.col("head_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), "attention_score",
        (F.col("head_base") + F.coalesce("rest_base", zero)).alias("base_score"), (F.col("head_score") + F.coalesce("rest_score", zero)).alias("score"),
    )
