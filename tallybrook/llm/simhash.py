"""SimHash near-dedup: tiled exact comparison with numpy exclusive-or and bit counts.

Fingerprints are made in Arrow batches. Distinct ones (copies are counted together before they are shuffled) are put in order of the
bit counts of their 16-bit blocks and packed into tiles in a written table. A pair of tiles is skipped when the smallest
possible difference of its block bit counts, summed over blocks, is beyond the radius; that sum never exceeds the
Hamming distance, so no link is lost. Of a compared pair only a spanning forest of its links leaves the task, shortest links
first, so a group of thousands of near copies yields a few rows a member, not all its pairs. Components come from alternating stars.
The work grows with the square of the distinct fingerprints, less what is skipped; README has figures.

Where links must also have a Jaccard similarity, tiles are in order of the number of distinct shingles first, and a pair of tiles whose numbers
are too far apart for that similarity is skipped too. The forest's edges are held against the shingle sets. A component all of whose edges hold
is done. Of the others, tiles with the sets themselves are compared: a task holds every link between two classes of its pair of tiles against
the sets, joins the classes that it finds alike as it goes, and again only a forest leaves it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, is_numbered, materialise, numbered, row_column, row_id, row_name, short_batches, small, tidy
from tallybrook.llm.components import components, labels

SEED = 42
#: Fingerprints in a tile, by how many there are: a 64th of them, within these bounds, so that what is sent to pairs of tiles grows little faster than the input.
TILE = (4096, 32_768)
#: Shingles unpacked, comparisons made, and links held at once.
SLICE, BLOCK, LINKS = 1 << 15, 1 << 17, 1 << 18
#: Shingles of a tile with sets (8 bytes each).
SHINGLES = 1 << 20
#: Odd constants from the fractional parts of the square roots of 2 and 3: they start the further words of long fingerprints.
STARTS = (0, 0x6A09E667F3BCC909, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B)


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 of each run of k words (A-Z lower-cased, one space between), repeats included; fewer words: of the whole sequence; none: empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]), ">u8").astype(np.uint64)


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """The hashes for a further word of a fingerprint: a finaliser of shifts and odd products; word 0 has them as they are."""
    if not word:
        return h
    h = h ^ np.uint64(STARTS[word])
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: str | None, k: int = 3, words: int = 1, distinct: bool = False) -> np.ndarray:
    """64 x words bits; a bit is 1 if set in over half the hashes; distinct: each shingle counts once. No shingles: zero."""
    h = shingle_hashes(text, k)
    return _majority(np.unique(h) if distinct else h, words)


def _majority(h: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words, np.uint64)
    for w in range(words if len(h) else 0):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(h), SLICE):
            bits = np.unpackbits(_mixed(h[at : at + SLICE], w).astype(">u8").view(np.uint8)).reshape(-1, 64)
            for low in range(0, len(bits), 255):  # within 8 bits, then wide
                counts += bits[low : low + 255].sum(0, dtype=np.uint8)
        out[w] = np.packbits(2 * counts > len(h)).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, k: int = 3, words: int = 1, id_col: str = "doc_id", text_col: str = "text", sets: bool = False, distinct: bool = False) -> DataFrame:
    """(row, id, w0, w1, ...) of every row of docs, the words as signed 64-bit integers; sets: also XXH64 of the distinct shingles, ``of_set``, and
    their number ``size``; distinct: as in fingerprint(). docs has its rows' numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, of_sets, sizes = [], [], []
            for t in batch.column(2):
                h = shingle_hashes(t.as_py(), k)
                once = np.unique(h) if sets or distinct else h
                fps.append(_majority(once if distinct else h, words))
                of_sets.append(xxhash.xxh64_intdigest(once.tobytes(), SEED) - (1 << 63) if sets else 0)
                sizes.append(len(once))
            table = np.array(fps, np.uint64).reshape(-1, words).view(np.int64)
            held = [pa.array(of_sets, pa.int64()), pa.array(sizes, pa.int64())] if sets else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(table[:, i].copy()) for i in range(words)), *held], names)
        tidy()

    names = ["row", "id", *(f"w{i}" for i in range(words)), *["of_set", "size"][: 2 * sets]]
    row = row_column(docs) if is_numbered(docs) else row_id()
    rows = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def tile_size(n: int) -> int:
    return max(TILE[0], min(TILE[1], n // 64))


def linked(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance) of the pairs a[i], b[j] within the radius, a block of rows of a at a time; same: b is a, and only i < j.

    The distances of the first three words add up within 8 bits and never exceed the whole; further words are asked where those are within the radius."""
    step, words = max(1, BLOCK // max(1, len(b))), a.shape[1]
    lead = min(3, words)
    columns = [np.ascontiguousarray(b[:, w]) for w in range(lead)]
    xor, count, apart = np.empty((step, len(b)), np.uint64), np.empty((step, len(b)), np.uint8), np.empty((step, len(b)), np.uint8)
    for at in range(0, len(a), step):
        rest = at if same else 0
        m, n = len(a[at : at + step]), len(b) - rest
        x, c, total = (f.reshape(-1)[: m * n].reshape(m, n) for f in (xor, count, apart))
        for w in range(lead):
            np.bitwise_xor(a[at : at + m, w, None], columns[w][None, rest:], out=x)
            np.bitwise_count(x, out=total if not w else c)
            if w:
                total += c
        if not m * n or total.min() > radius:
            continue
        flat = total.reshape(-1)
        hit = _where(flat <= radius)
        i, j = hit // n + at, hit % n + rest
        if same:
            use = i < j
            i, j, hit = i[use], j[use], hit[use]
        far = flat[hit].astype(np.int64)
        for w in range(lead, words):
            far += np.bitwise_count(a[i, w] ^ b[j, w])
            use = far <= radius
            i, j, far = i[use], j[use], far[use]
        if len(i):
            yield i, j, far


def _where(mask: np.ndarray) -> np.ndarray:
    """np.flatnonzero() of a mask with few ones: eight at a time first."""
    whole = len(mask) // 8 * 8
    some = np.flatnonzero(mask[:whole].view(np.uint64))
    near = (some[:, None] * 8 + np.arange(8)).reshape(-1)
    return np.concatenate([near[mask[near]], np.flatnonzero(mask[whole:]) + whole])


def forest(n: int, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Places of the edges (i, j) of a shortest spanning forest of the nodes 0 to n-1: each component takes its shortest edge to another, until none is left."""
    order = np.argsort(far, kind="stable")
    i, j, of, chosen = i[order], j[order], np.arange(n), []
    rank = np.arange(len(order))
    while True:
        a, b = of[i[rank]], of[j[rank]]
        apart = a != b
        rank, a, b = rank[apart], a[apart], b[apart]
        if not len(rank):
            return order[np.unique(np.concatenate([np.zeros(0, np.int64), *chosen])).astype(np.int64)]
        best = np.full(n, len(order))
        np.minimum.at(best, a, rank)
        np.minimum.at(best, b, rank)
        chosen.append(np.unique(best[best < len(order)]))
        picked = np.concatenate(chosen)
        of = labels(n, i[picked], j[picked])


def spanning(a: np.ndarray, b: np.ndarray, radius: int, same: bool, fits: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance): a spanning forest of the links of two tiles, shortest links first; same: b is a, else j counts on from the rows of a.

    Links come in blocks; what the forest held already joins by edges that are no longer, in steps of a quarter of the radius, is passed over at once."""
    n, shift = (len(a), 0) if same else (len(a) + len(b), len(a))
    steps = np.unique([max(1, radius * q // 4) for q in (1, 2, 3, 4)])
    joined = [np.arange(n) for _ in steps]
    held, waiting, count = [np.zeros(0, np.int64)] * 3, [], 0

    def settle() -> None:
        nonlocal held, waiting, count
        i, j, far = (np.concatenate([held[c], *(w[c] for w in waiting)]) for c in range(3))
        keep = forest(n, i, j, far)
        held, waiting, count = [i[keep], j[keep], far[keep]], [], 0
        for k, step in enumerate(steps):
            near = held[2] <= step
            joined[k] = labels(n, held[0][near], held[1][near])

    for i, j, far in linked(a, b, radius, same):
        if fits is not None:
            use = fits(i, j)
            i, j, far = i[use], j[use], far[use]
        j = j + shift
        for k, step in enumerate(steps):
            use = (far < step) | (joined[k][i] != joined[k][j])
            i, j, far = i[use], j[use], far[use]
        if len(i):
            waiting.append((i, j, far))
            count += len(i)
            if count > LINKS:
                settle()
    if waiting:
        settle()
    return held[0], held[1], held[2]


def _blocks(words: int) -> list[Column]:
    """Bit counts of the 16-bit blocks."""
    return [F.bit_count(F.shiftrightunsigned(F.col(f"w{i}"), 16 * j).bitwiseAND(F.lit(0xFFFF))) for i in range(words) for j in range(4)]


def _tiles(spark: SparkSession, nodes: DataFrame, words: int, by: list[str], extra: list[str]) -> DataFrame:
    """Written tiles of neighbours in the order of ``by``, then of block bit counts: n rows, fingerprints, nodes and the ``extra`` columns (long) as bytes, and as
    ``low`` and ``high`` the least and largest block counts and values of ``by``."""
    size = tile_size(nodes.count())

    def made(rows: np.ndarray) -> pa.RecordBatch:
        fps = np.ascontiguousarray(rows[:, 1 : 1 + words])
        bounds = np.concatenate([np.bitwise_count(fps.view(np.uint16)).reshape(len(rows), -1).astype(np.int64), rows[:, 1 + words : 1 + words + len(by)]], 1)
        held = {"n": [len(rows)], "fps": [fps.tobytes()], "node": [rows[:, 0].tobytes()]}
        held |= {c: [rows[:, 1 + words + k].tobytes()] for k, c in enumerate(extra)}
        return pa.RecordBatch.from_pydict(held | {"low": [bounds.min(0).tobytes()], "high": [bounds.max(0).tobytes()]})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1))
            if sum(map(len, held)) >= size:
                rows = np.concatenate(held)
                cut = len(rows) // size * size
                for at in range(0, cut, size):
                    yield made(rows[at : at + size])
                held = [rows[cut:]]
        if held and sum(map(len, held)):
            yield made(np.concatenate(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column("parts"):
                parts = parts.as_py()
                low, high = (f.reduce([np.frombuffer(x[c], np.int64) for x in parts]).tobytes() for f, c in ((np.minimum, "low"), (np.maximum, "high")))
                yield pa.RecordBatch.from_pydict({"n": [sum(x["n"] for x in parts)], **{c: [b"".join(x[c] for x in parts)] for c in ("fps", "node", *extra)}, "low": [low], "high": [high]})

    assert by == extra[: len(by)]
    blocks = [f"b{i}" for i in range(4 * words)]
    ordered = nodes.withColumns(dict(zip(blocks, _blocks(words), strict=True))).repartitionByRange(*by, *blocks).sortWithinPartitions(*by, *blocks)
    schema = ", ".join(["n long", *(f"{c} binary" for c in ("fps", "node", *extra, "low", "high"))])
    columns = ["node", *(f"w{i}" for i in range(words)), *extra]
    tiles = materialise(spark, ordered.select(*(F.col(c).cast("long") for c in columns)).mapInArrow(pack, schema).withColumn("tile", row_id()), "simhash-tiles")
    # neighbouring short tiles are put together: of short tiles there would be many pairs, and a group's forest once for each
    to, held = [], 0
    for r in tiles.select("tile", "n").orderBy("tile").collect():  # a few bytes a tile
        if not to or held + r["n"] > size:
            to, held = [*to, (r["tile"], to[-1][1] + 1 if to else 0)], 0
        else:
            to.append((r["tile"], to[-1][1]))
        held += r["n"]
    if not to or to[-1][1] + 1 == len(to):
        return tiles
    named = tiles.join(small(spark.createDataFrame(to, "tile long, to long"), len(to)), "tile")
    parts = named.groupBy("to").agg(F.collect_list(F.struct("n", "fps", "node", *extra, "low", "high")).alias("parts"))  # at most a tile's rows meet
    joined = materialise(spark, parts.mapInArrow(merge, schema).withColumn("tile", row_id()), "simhash-tiles")
    drop_table(spark, tiles)
    return joined


def _pairs(spark: SparkSession, tiles: DataFrame, words: int, radius: int, ratios: list[float]) -> DataFrame:
    """(pair, a, b): numbered pairs of tiles that must be compared, by their least and largest block counts and, for each further bound, by the
    least ratio that the values of two linked rows have. Only those few bytes a tile reach the driver."""
    meta = tiles.select("tile", "low", "high").orderBy("tile").collect()
    held = (np.array([m["tile"] for m in meta], np.int64), *(np.array([np.frombuffer(m[c], np.int64) for m in meta], np.int64).reshape(len(meta), 4 * words + len(ratios)) for c in ("low", "high")))
    shared = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, low, high = shared.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                c = slice(0, 4 * words)
                near = np.maximum(0, np.maximum(low[i:, c] - high[i, c], low[i, c] - high[i:, c])).sum(1) <= radius
                for k, ratio in enumerate(ratios, 4 * words):
                    near &= np.maximum(low[i:, k], low[i, k]) * ratio <= np.minimum(high[i:, k], high[i, k])
                near = ids[i:][near]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), ids[i])), pa.array(near)], ["a", "b"])

    return materialise(spark, spark.range(len(meta)).mapInArrow(run, "a long, b long").withColumn("pair", row_id()), "simhash-pairs")


def _of_pairs(spark: SparkSession, tiles: DataFrame, pairs: DataFrame, run: Callable[[dict, dict, bool], Iterator[pa.RecordBatch]], columns: list[str], words: int, schema: str) -> DataFrame:
    """What ``run`` makes of each pair of tiles, given as dictionaries of numpy columns; both tiles of a pair meet by one shuffle, a few pairs a task."""
    n = pairs.count()
    parts = max(1, min(n, max(2 * spark.sparkContext.defaultParallelism, n // 8)))
    sides = F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("tile"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("a").alias("tile"), F.lit(0).alias("side")), F.struct(F.col("b").alias("tile"), F.lit(1).alias("side")))))
    asked = pairs.select("pair", sides.alias("s")).select("pair", "s.tile", "s.side")
    met = asked.join(tiles.select("tile", "fps", *columns), "tile")
    met = met.repartition(parts, "pair").sortWithinPartitions("pair", "side")

    def read(batch: pa.RecordBatch, r: int) -> dict:
        held = {c: np.frombuffer(batch.column(c)[r].as_buffer(), np.int64) for c in columns}
        return held | {"fps": np.frombuffer(batch.column("fps")[r].as_buffer(), np.uint64).reshape(-1, words)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: tuple[int, dict] | None = None
        for batch in batches:
            for r, (pair, side) in enumerate(zip(batch.column("pair").to_pylist(), batch.column("side").to_pylist(), strict=True)):
                tile = read(batch, r)
                if not side:
                    if left is not None:
                        yield from run(left[1], left[1], True)
                    left = pair, tile
                else:
                    yield from run(left[1], tile, False)
                    left = None
        if left is not None:
            yield from run(left[1], left[1], True)
        tidy()

    return met.mapInArrow(task, schema)


def _batch(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x, np.int64)) for x in (a, b, far)], ["a", "b", "distance"])


EDGES = "a long, b long, distance long"


def links(spark: SparkSession, nodes: DataFrame, words: int, radius: int, similarity: float | None = None) -> DataFrame:
    """(a, b, distance): for distinct fingerprints (node, w0, ..., and size with a similarity) links within the radius that join all nodes that such links join.
    With a similarity only links between sets of sizes that allow it count."""
    by = [] if similarity is None else ["size"]

    def run(x: dict, y: dict, same: bool) -> Iterator[pa.RecordBatch]:
        def fits(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            p, q = x["size"][i], y["size"][j]
            return np.minimum(p, q) >= similarity * np.maximum(p, q)

        i, j, far = spanning(x["fps"], y["fps"], radius, same, fits if by else None)
        names = x["node"] if same else np.concatenate([x["node"], y["node"]])
        yield _batch(names[i], names[j], far)

    tiles = _tiles(spark, nodes, words, by, by)
    pairs = _pairs(spark, tiles, words, radius, [similarity] if by else [])
    found = reduced(spark, _of_pairs(spark, tiles, pairs, run, ["node", *by], words, EDGES))
    drop_table(spark, tiles)
    drop_table(spark, pairs)
    return found


def reduced(spark: SparkSession, edges: DataFrame, per_task: int = 200_000) -> DataFrame:
    """The edges (a, b, distance) without those that close a circle of edges that are no longer, as far as they meet in a task; written.

    Edges of all pairs of tiles are dealt out at random, so that of a large group each task keeps no more than a forest. What it takes out is
    never needed to join nodes at any distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1) for b in batches]
        rows = np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 3), np.int64)
        names, ends = np.unique(rows[:, :2], return_inverse=True)
        ends = ends.reshape(-1, 2)
        keep = rows[np.sort(forest(len(names), ends[:, 0], ends[:, 1], rows[:, 2]))]
        yield _batch(keep[:, 0], keep[:, 1], keep[:, 2])

    table = materialise(spark, edges, "simhash-links")
    parts = max(2, -(-table.count() // per_task))
    out = materialise(spark, table.repartition(parts, F.pmod(F.xxhash64("a", "b"), F.lit(parts))).mapInArrow(run, EDGES), "simhash-forest")
    drop_table(spark, table)
    return out


def alike(x: dict, y: dict, radius: int, same: bool, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of links between rows of one group whose shingle sets are that similar, j counting on from the rows of x; enough to join all classes that such links join.

    Every link within the radius between two classes is held against the sets unless the classes have been joined by then."""
    tiles = [x] if same else [x, y]
    shift = 0 if same else len(x["node"])
    size, grp, of = (np.concatenate([t[c] for t in tiles]) for c in ("size", "grp", "class"))
    of = np.unique(of, return_inverse=True)[1]
    ids = np.unique(np.concatenate([t["sets"] for t in tiles]).view(np.uint64), return_inverse=True)[1].astype(np.int32)
    start = np.cumsum(size) - size
    present = np.zeros(int(ids.max(initial=-1)) + 1, np.uint8)
    out: list[tuple[int, int, int]] = []
    for rows, j, far in linked(x["fps"], y["fps"], radius, same):
        j = j + shift
        use = (grp[rows] == grp[j]) & (of[rows] != of[j]) & (np.minimum(size[rows], size[j]) >= similarity * np.maximum(size[rows], size[j]))
        rows, j, far = rows[use], j[use], far[use]
        for i in np.unique(rows).tolist():
            at = slice(*np.searchsorted(rows, (i, i + 1)))
            to, how = j[at], far[at]
            apart = of[to] != of[i]
            to, how = to[apart], how[apart]
            if not len(to):
                continue
            own = ids[start[i] : start[i] + size[i]]
            present[own] = 1
            n = size[to]
            first = np.cumsum(n) - n
            held = present[ids[np.repeat(start[to] - first, n) + np.arange(n.sum())]]
            present[own] = 0
            shared = np.add.reduceat(held, first, dtype=np.int64)
            good = shared >= similarity * (size[i] + n - shared)
            for other, d in zip(to[good].tolist(), how[good].tolist(), strict=True):
                if of[other] != of[i]:
                    out.append((i, other, d))
                    of[of == of[other]] = of[i]
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _set_tiles(spark: SparkSession, members: DataFrame, words: int, shingles: int) -> tuple[DataFrame, DataFrame]:
    """(tiles, pairs) of members (node, grp, class, size, w0, ..., set): small groups share tiles, a group of more shingles than a tile has is dealt out to several,
    all of whose pairs are compared."""
    sizes = materialise(spark, members.groupBy("grp").agg(F.sum("size").alias("shingles")), "simhash-groups")
    total = sizes.agg(F.coalesce(F.sum("shingles"), F.lit(0))).first()[0]
    shared = 1 + 2 * total // shingles
    large = F.col("shingles") > shingles
    part = F.when(large, F.pmod(F.xxhash64("node"), F.ceil(2 * F.col("shingles") / shingles))).otherwise(F.pmod(F.xxhash64("grp"), F.lit(shared)))
    held = members.join(sizes, "grp").withColumns({"of": F.when(large, F.col("grp")).otherwise(F.lit(-1)), "part": part})
    columns = ["node", "grp", "class", "size"]
    each = held.groupBy("of", "part").agg(F.collect_list(F.struct(*columns, *(f"w{i}" for i in range(words)), "set")).alias("held"))  # about a tile's shingles

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                rows = batch.column("held")[r].values
                fps = np.stack([rows.field(f"w{i}").to_numpy(zero_copy_only=False) for i in range(words)], 1)
                made = {"of": batch.column("of").slice(r, 1), "part": batch.column("part").slice(r, 1), "fps": [fps.tobytes()], "sets": [b"".join(rows.field("set").to_pylist())]}
                yield pa.RecordBatch.from_pydict(made | {c: [rows.field(c).to_numpy(zero_copy_only=False).tobytes()] for c in columns})
        tidy()

    schema = "of long, part long, fps binary, sets binary, " + ", ".join(f"{c} binary" for c in columns)
    tiles = materialise(spark, each.select(F.col("of").cast("long"), F.col("part").cast("long"), "held").mapInArrow(pack, schema).withColumn("tile", row_id()), "simhash-tiles")
    one = tiles.select("of", F.col("part").alias("p"), F.col("tile").alias("a"))
    two = tiles.where("of >= 0").select("of", F.col("part").alias("q"), F.col("tile").alias("b"))
    pairs = one.where("of < 0").select("a", F.col("a").alias("b")).union(one.join(two, "of").where("p <= q").select("a", "b"))
    return tiles, materialise(spark, pairs.withColumn("pair", row_id()), "simhash-pairs")


def verified_links(spark: SparkSession, docs: DataFrame, distinct: DataFrame, words: int, radius: int, k: int, similarity: float, text_col: str) -> DataFrame:
    """(a, b): links between nodes (node, size, w0, ...), equal fingerprints among them, whose texts are that similar, enough to join all nodes that such links join.

    First the forest of all links is held against the shingle sets, with no more comparisons than nodes. Where all its edges in a component hold, they
    join all that any link there could. The nodes of the other components, in the classes joined so far, are compared with their sets by pairs of tiles. Sets with fewer shingles than
    any two different sets of that similarity can have are no nodes."""
    least = int(np.ceil(similarity / (1 - similarity) - 1e-9)) if similarity < 1 else 1 << 62
    nodes = distinct.where(F.col("size") >= least)
    tree = links(spark, nodes, words, radius, similarity)
    ends = tree.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = materialise(spark, shingle_sets(docs, ends, tree.count() * 2, k, text_col), "simhash-sets")
    checked = materialise(spark, verified(tree, sets, similarity), "simhash-checked")
    held = checked.where("good").select("a", "b")
    if checked.where("not good").limit(1).count():
        grp = components(spark, tree).withColumnRenamed("root", "grp")
        mixed = checked.where("not good").select(F.col("a").alias("node")).distinct().join(grp, "node").select("grp").distinct()
        root = components(spark, held).withColumnRenamed("root", "class")
        members = nodes.join(grp.join(mixed, "grp"), "node").join(root, "node", "left").withColumn("class", F.coalesce("class", "node"))
        members = materialise(spark, members.join(sets.withColumnRenamed("row", "node"), "node"), "simhash-members")
        tiles, pairs = _set_tiles(spark, members, words, SHINGLES)

        def run(x: dict, y: dict, same: bool) -> Iterator[pa.RecordBatch]:
            i, j, far = alike(x, y, radius, same, similarity)
            names = x["node"] if same else np.concatenate([x["node"], y["node"]])
            yield _batch(names[i], names[j], far)

        more = materialise(spark, _of_pairs(spark, tiles, pairs, run, ["node", "grp", "class", "size", "sets"], words, EDGES).select("a", "b"), "simhash-links")
        for t in (members, tiles, pairs):
            drop_table(spark, t)
        held = held.union(more)
    for t in (tree, sets):
        drop_table(spark, t)
    return held


def simhash_components(spark: SparkSession, docs: DataFrame, shingle_words: int = 3, words: int = 1, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None, distinct_shingles: bool = False) -> DataFrame:
    """One row per row of docs: row, id, fingerprint (hex), component_id (the smallest id that links reach), keep_row (the row that has it).

    Fingerprints of 64 x words bits link when at most ``radius`` bits differ; equal ones always do. With ``similarity``, a link
    holds only if the Jaccard similarity of both texts' shingle sets is at least that, for equal fingerprints too: rows are then
    nodes of their own unless fingerprint and shingle set are both equal. Null and empty texts have fingerprint zero, linked like any other. A null id counts as larger than
    all others; repeated rows and equal texts share their component. No rows: no rows. Other columns are not read."""
    short_batches(spark)
    if similarity is not None:  # texts are read again
        docs = numbered(spark, docs, [id_col, text_col])
    cols = [f"w{i}" for i in range(words)]
    keys = cols if similarity is None else [*cols, "of_set", "size"]
    rows = materialise(spark, fingerprints(docs, shingle_words, words, id_col, text_col, similarity is not None, distinct_shingles), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"))
    distinct = materialise(spark, rows.groupBy(*keys).agg(F.min("row").alias("node"), F.min(order).alias("least")), "simhash-distinct")
    if similarity is None:
        edges = links(spark, distinct.select("node", *cols), words, radius)
    else:
        edges = verified_links(spark, docs, distinct.select("node", "size", *cols), words, radius, shingle_words, similarity, text_col)
    roots = components(spark, edges.select("a", "b"))
    named = distinct.join(roots.withColumnRenamed("root", "r"), "node", "left").withColumn("r", F.coalesce("r", "node"))
    least = materialise(spark, named.groupBy("r").agg(F.min("least").alias("of")), "simhash-least")
    found = named.join(least, "r").select(*keys, F.col("of.id").alias("component_id"), F.col("of.row").alias("keep_row"))
    hexed = F.concat(*(F.lower(F.lpad(F.hex(c), 16, "0")) for c in cols))
    return rows.join(found, keys).select("row", "id", hexed.alias("fingerprint"), "component_id", "keep_row")


def shingle_sets(docs: DataFrame, rows: DataFrame, n: int, k: int, text_col: str = "text") -> DataFrame:
    """(row, set): the sorted hashes of the distinct shingles of the docs whose numbers are in rows (row), at most n of them, as bytes."""
    texts = docs.select(row_column(docs).alias("row"), F.col(text_col).cast("string").alias("text")).join(small(rows, n), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([np.unique(shingle_hashes(t.as_py(), k)).tobytes() for t in part.column(1)], pa.binary())], ["row", "set"])
        tidy()

    return texts.mapInArrow(run, "row long, set binary")


def verified(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """edges (a, b, distance) with ``good``: whether the shingle sets of both ends have at least that Jaccard similarity."""
    both = edges.join(sets.select(F.col("row").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("row").alias("b"), F.col("set").alias("sb")), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                shared = len(x) + len(y) - len(np.union1d(x, y))
                good.append(shared >= similarity * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "distance")), pa.array(good, pa.bool_())], ["a", "b", "distance", "good"])
        tidy()

    return both.select("a", "b", "distance", "sa", "sb").mapInArrow(compare, EDGES + ", good boolean")


def drop_near_copies(spark: SparkSession, docs: DataFrame, shingle_words: int = 5, words: int = 4, radius: int = 72, similarity: float = 0.8) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each group of near copies the row with the smallest doc_id (of equal ids the first row; null ids come
    last). Null and empty texts are copies of each other. No rows: no rows.

    256-bit fingerprints of the distinct shingles: two long texts of Jaccard similarity 0.8 differ in about 39 bits with a deviation of 6, at worst (4 shingles
    of 5) in 48, unrelated ones in 128 with a deviation of 8, so radius 72 misses at most 1 such pair in 10,000; proposed links are then held against the
    shingle sets."""
    docs = numbered(spark, docs)
    row = row_column(docs)
    groups = simhash_components(spark, docs, shingle_words, words, radius, similarity=similarity, distinct_shingles=True)
    out = materialise(spark, groups.where("row != keep_row").select(F.col("row").alias(row_name(docs))), "simhash-groups")
    return docs.join(small(out, out.count()), row_name(docs), "left_anti").drop(row)
