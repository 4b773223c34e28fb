"""BPE encoding and decoding in batched numpy merge rounds.

A text is cut at white space into chunks; a chunk's ids never depend on its neighbours. Chunks that a worker hasn't met yet are cut together into
words, and the symbols of all new words lie in one flat array. In each round a table of hashed pair keys gives
each adjacent pair its rank, the lowest rank of each word is taken, and all its occurrences merge at once; words without a
known pair leave the array. Ids of words and chunks are kept in flat arrays, from which the ids and decoded texts of a batch are taken
at once. The vocabulary's file is read by the driver and broadcast (about 2 MB).
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import short_batches

#: Chunks whose ids a worker keeps at most; beyond that it forgets all. And the texts of one output batch.
KEPT, TEXTS = 120_000, 64
#: Fixed values of the tokenizer's file format: white space, words, and the characters that stand for the bytes.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"

_SPACES = re.compile(f"[{SPACE}]+")
_ODD = re.compile("[\x1c-\x1f]")
NONE = np.iinfo(np.int32).max
#: Bits of a slot's number in the table of pairs.
TABLE = 18


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the others from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


def slots(keys: np.ndarray) -> np.ndarray:
    """The first slot of each pair key in the table of pairs."""
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE)).view(np.int64)


class Vocabulary:
    """Tokens, a table of pair keys with their ranks, merged ids by rank, and special tokens of a tokenizer file."""

    def __init__(self, file_text: str) -> None:
        held = json.loads(file_text)
        ids = held["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"]]
        pairs = np.array([(ids[a], ids[b], ids[a + b]) for a, b in merges], np.int64)
        keys = (pairs[:, 0] << 32) | pairs[:, 1]
        self.keys, self.ranks = np.full(1 << TABLE, -1, np.int64), np.full(1 << TABLE, NONE, np.int32)
        at, left = slots(keys), np.arange(len(keys))
        while len(left):  # a taken slot sends on to the next one
            free = np.flatnonzero(self.keys[at[left]] < 0)
            own = left[free[np.unique(at[left[free]], return_index=True)[1]]]
            self.keys[at[own]], self.ranks[at[own]] = keys[own], own
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) % len(self.keys)
        chars = byte_characters()
        self.inner = np.array([ids[c] for c in chars], np.int32)
        self.final = np.array([ids[c + END] for c in chars], np.int32)
        self.rank_to = pairs[:, 2].astype(np.int32)

    def ranks_of(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair key, NONE for unknown ones."""
        at = slots(keys)
        met = self.keys.take(at)
        rank = np.where(met == keys, self.ranks.take(at), NONE)
        left = np.flatnonzero((met != keys) & (met >= 0))
        while len(left):
            at[left] = (at[left] + 1) % len(self.keys)
            met = self.keys[at[left]]
            rank[left] = np.where(met == keys[left], self.ranks[at[left]], NONE)
            left = left[(met != keys[left]) & (met >= 0)]
        return rank


class Runs:
    """Runs of ids by number, one after another in an array that grows."""

    def __init__(self) -> None:
        self.ids, self.first, self.size, self.n, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0, 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Runs of so many ids each get the next numbers."""
        n, used = self.n + len(sizes), self.used + len(ids)
        for name, least in (("ids", used), ("first", n), ("size", n)):
            held = getattr(self, name)
            if len(held) < least:
                setattr(self, name, np.concatenate([held, np.zeros(max(least, 2 * len(held)) - len(held), held.dtype)]))
        self.ids[self.used : used] = ids
        self.first[self.n : n], self.size[self.n : n] = self.used + np.cumsum(sizes) - sizes, sizes
        self.n, self.used = n, used

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs in one array, and how many each has."""
        size = self.size.take(numbers)
        shift = self.first.take(numbers) - (np.cumsum(size) - size)
        return self.ids.take(np.repeat(shift, size) + np.arange(size.sum())), size


def merge_rounds(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words (at least one byte long each) in one array, and how many each has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = v.inner[raw]
    last = np.cumsum(lengths) - 1
    symbols[last] = v.final[raw[last]]
    word = np.repeat(np.arange(len(words)), lengths)
    out: list[tuple[np.ndarray, np.ndarray]] = [(word[:0], symbols[:0])]
    while len(symbols):
        rank = v.ranks_of((symbols[:-1].astype(np.int64) << 32) | symbols[1:])
        rank[word[:-1] != word[1:]] = NONE
        rank = np.append(rank, np.int32(NONE))  # of the pair that begins here
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(word)))
        over = best == NONE
        if over.any():
            stay = np.repeat(~over, sizes)
            out.append((word[~stay], symbols[~stay]))
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            best, sizes = best[~over], sizes[~over]
            if not len(symbols):
                break
        hit = rank == np.repeat(best, sizes)
        # of overlapping occurrences (one symbol repeated) the first, third, ... merge
        if (hit[1:] & hit[:-1]).any():
            runs = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
            place = np.arange(len(hit)) - runs[np.maximum(np.searchsorted(runs, np.arange(len(hit)), "right") - 1, 0)]
            hit &= place % 2 == 0
        symbols[hit] = v.rank_to[rank[hit]]
        kept = np.append(True, ~hit[:-1])
        symbols, word = symbols[kept], word[kept]
    word, symbols = (np.concatenate(x) for x in zip(*out, strict=True))
    return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


class Codec:
    """Encodes and decodes, keeping the ids of the chunks it has met, and of their words."""

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.words = v, regex.compile(WORDS + r"|\n")
        self.special = re.compile("(" + "|".join(map(re.escape, v.special)) + ")") if v.special else None
        # each token after a space, then each as a text's first
        self.token = pa.array([*(" " + t for t in v.tokens), *v.tokens], pa.string())
        self.length = np.diff(np.frombuffer(self.token.buffers()[1], np.int32)[: len(self.token) + 1]).astype(np.int64)
        self.forget()

    def forget(self) -> None:
        self.number, self.ids = {}, Runs()
        self.of_word, self.word_ids = {"\n": 0}, Runs()  # the end of a chunk is a word without ids
        self.word_ids.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def lowered(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sigma never as at a word's end
        return text.lower()

    def pieces(self, chunk: str) -> list[str | int]:
        """The words of a chunk with special tokens; these as ids."""
        return [x for i, p in enumerate(self.special.split(chunk)) for x in ([self.v.special[p]] if i % 2 else self.words.findall(self.lowered(p)))]

    def learn(self, new: list[str]) -> None:
        """Takes in new chunks: all are cut into words together, line by line."""
        odd = [c for c in new if "<" in c and self.special.search(c)] if self.special else []
        if odd:
            held = set(odd)
            new = [c for c in new if c not in held]
        words: list[str | int] = self.words.findall(self.lowered("\n".join([*new, ""])))
        for c in odd:
            words += [*self.pieces(c), "\n"]
        fresh = [w for w in dict.fromkeys(words) if w not in self.of_word]
        cut = [w.encode() for w in fresh if isinstance(w, str)]
        whole = [w for w in fresh if isinstance(w, int)]
        self.of_word.update(zip([*(w for w in fresh if isinstance(w, str)), *whole], range(len(self.of_word), len(self.of_word) + len(fresh)), strict=True))
        if cut:
            self.word_ids.add(*merge_rounds(self.v, cut))
        self.word_ids.add(np.array(whole, np.uint32), np.ones(len(whole), np.int64))
        numbers = np.fromiter(map(self.of_word.__getitem__, words), np.int64, len(words))
        ids, sizes = self.word_ids.take(numbers)
        ends = np.cumsum(sizes)[numbers == 0]
        self.ids.add(ids, np.diff(ends, prepend=0))
        self.number.update(zip(chain(new, odd), range(len(self.number), len(self.number) + len(new) + len(odd)), strict=True))

    def arrays(self, texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
        """Each text's ids as little-endian unsigned 32-bit integers, and its decoded text."""
        if len(self.number) > KEPT:
            self.forget()
        cut = [[] if not t else _SPACES.split(t) if _ODD.search(t) else t.split() for t in texts]
        cut = [chunks if "" not in chunks else [c for c in chunks if c] for chunks in cut]
        chunks = list(chain.from_iterable(cut))
        found = np.fromiter(map(self.number.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = [chunks[k] for k in new.tolist()]
            self.learn(list(dict.fromkeys(fresh)))
            found[new] = np.fromiter(map(self.number.__getitem__, fresh), np.int64, len(fresh))
        ids, sizes = self.ids.take(found)
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([0, *map(len, cut)])]
        which = ids.astype(np.int64)
        which[ends[:-1][ends[:-1] < ends[1:]]] += len(self.token) // 2
        decoded = self.token.take(pa.array(which))
        at = np.append(0, np.cumsum(self.length.take(which)))[ends]
        held = lambda kind, ends, data: pa.Array.from_buffers(kind, len(texts), [None, pa.py_buffer(ends.astype(np.int32)), data])
        return held(pa.binary(), 4 * ends, pa.py_buffer(ids.astype("<u4"))), held(pa.string(), at, decoded.buffers()[2] or pa.py_buffer(b""))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text in UTF-8) of each text."""
        ids, decoded = self.arrays(texts)
        return list(zip(ids.to_pylist(), decoded.cast(pa.binary()).to_pylist(), strict=True))

    def decode(self, ids: bytes) -> str:
        """The tokens of ids with a space between, as a tokenizer without a decoder gives them; special tokens are kept."""
        return " ".join([self.v.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


@functools.lru_cache(1)
def _codec(file_text: str) -> Codec:
    """A worker's codec, kept from task to task."""
    return Codec(Vocabulary(file_text))


def encode_decode(spark: SparkSession, docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row of docs; ids: bytes of little-endian unsigned 32-bit integers, decoded: the text that they decode to.

    vocabulary: the path of a tokenizer file. Null and empty texts have no ids and decode to the empty text. Repeated rows stay, in any
    order; other columns are not read."""
    short_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                yield pa.RecordBatch.from_arrays([part.column(0), *codec.arrays(part.column(1).to_pylist())], ["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
