from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from tallybrook.llm import exact_dedup, line_dedup, simhash
from tallybrook.llm.components import components

DOCS = "doc_id long, text string, key string, row int, w0 int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], DOCS).repartition(3)


def _random_rows(n: int, seed: int):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    base = [rng.choices(words, k=rng.randint(0, 60)) for _ in range(n)]
    rows = [(k, " ".join(b)) for k, b in enumerate(base)]
    for k in range(n):
        b = list(base[k % 7])
        if b:
            b[rng.randrange(len(b))] = rng.choice(words)
        rows.append((n + k, rng.choice([" ", "\n", "\t "]).join(b)))
    rows += [(3 * n + k, rows[5][1]) for k in range(200)]
    return [*rows, (None, None), (9000, ""), (9001, None), (5, rows[5][1]), (5, rows[5][1]), (9002, "x" * 50_000), (9003, "X" * 50_000)]


def _components(links, nodes):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


@pytest.mark.parametrize("capacity", [3, 200_000])
def test_exact_groups_against_brute_force(spark, capacity):
    rows = _random_rows(60, 1)
    docs = _docs(spark, rows).cache()
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    found = exact_dedup.exact_groups(spark, docs, capacity=capacity).collect()
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["id"], r["keep_id"], r["group_size"]) for r in found), key=key) == sorted(((i, least(groups[norm(t)]), len(groups[norm(t)])) for i, t in rows), key=key)
    assert sum(r["kept"] for r in found) == len(groups) and all(r["id"] == r["keep_id"] for r in found if r["kept"])
    if capacity == 3:
        assert len({r["bucket"] for r in found}) > len(groups) / 3 - 1
    kept = exact_dedup.drop_exact_copies(spark, docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_other_file_splits_in_a_later_scan_do_not_mix_up_rows(spark, monkeypatch, tmp_path):
    rows = [(k, f"text {k % 20} " + "filler " * 50) for k in range(4000)]
    _docs(spark, rows).coalesce(1).sortWithinPartitions("doc_id").write.option("parquet.block.size", "4096").option("parquet.page.row.count.limit", "100").option("parquet.block.row.count.limit", "100").parquet(f"{tmp_path}/docs")
    key, written = "spark.sql.files.maxPartitionBytes", exact_dedup.materialise

    def then_split_smaller(*args, **kwargs):
        out = written(*args, **kwargs)
        spark.conf.set(key, "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        return out

    monkeypatch.setattr(exact_dedup, "materialise", then_split_smaller)
    try:
        kept = exact_dedup.drop_exact_copies(spark, spark.read.parquet(f"{tmp_path}/docs")).collect()
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r["doc_id"] for r in kept) == list(range(20))


def test_rows_whose_bucket_the_directory_does_not_name_are_lost(spark, monkeypatch):
    docs = _docs(spark, [(k, f"text {k % 300}") for k in range(600)])
    assert exact_dedup.exact_groups(spark, docs, capacity=50).count() == 600
    whole = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda keys, capacity: whole(keys, capacity)[1:])
    assert 300 < exact_dedup.exact_groups(spark, docs, capacity=50).count() < 600


def test_a_hot_key_is_dealt_out_and_chained_again(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PART_ROWS", 50)
    docs = _docs(spark, [(k, "hot  text" if k % 2 else f"text {k % 7}") for k in range(2000, 0, -1)])
    found = exact_dedup.exact_groups(spark, docs, capacity=3).collect()
    assert {(r["keep_id"], r["group_size"]) for r in found if r["id"] % 2} == {(1, 1000)} and sum(r["kept"] for r in found) == 8 and len(found) == 2000


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as key")
    buckets = exact_dedup.directory(keys, 100)
    held = exact_dedup.bucketed(spark, keys, buckets).groupBy("bucket").count().collect()
    assert sum(r["count"] for r in held) == 5000 and max(r["count"] for r in held) <= 100
    assert sum(2.0**-d for _, d in buckets) == 1.0


def test_empty_tables(spark):
    none = _docs(spark, [(1, "a")]).limit(0)
    assert exact_dedup.exact_groups(spark, none).count() == 0
    assert simhash.simhash_components(spark, none).count() == 0
    assert line_dedup.without_recurring_lines(spark, none).count() == 0


def _fingerprint(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[j : j + k]) for j in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(("tile", "radius"), [(8192, 2), (7, 2), (16, 9)])
def test_simhash_components_against_brute_force(spark, monkeypatch, tile, radius):
    monkeypatch.setattr(simhash, "TILE", (tile, tile))
    rows = _random_rows(50, 2)
    fps = [_fingerprint(t, 3) for _, t in rows]
    distinct = sorted(set(fps))
    root = _components([(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if (a ^ b).bit_count() <= radius], distinct)
    least: dict[int, int] = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    found = simhash.simhash_components(spark, _docs(spark, rows), radius=radius).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["id"], r["fingerprint"], r["component_id"]) for r in found), key=key) == sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fps, strict=True)), key=key)


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(2000)]
    rows, jaccard = [], lambda a, b: len(a & b) / len(a | b)
    for k in range(40):
        base = rng.choices(words, k=200)
        rows.append((10 * k, " ".join(base)))
        for c in range(1, 4):
            copy = list(base)
            for _ in range(c):
                copy[rng.randrange(200)] = rng.choice(words)
            rows.append((10 * k + c, " ".join(copy)))
    rows += [(1000 + k, "hot " + " ".join(["same"] * 3) + f" copy number {k % 3} " + " ".join(words[:150])) for k in range(300)]
    kept = {r["doc_id"] for r in simhash.drop_near_copies(spark, _docs(spark, rows)).collect()}
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    assert all(any(jaccard(sets[i], sets[j]) >= 0.8 for j in sets if j // 10 == i // 10 and j != i) for i in range(400) if i in sets)
    assert kept == {10 * k for k in range(40)} | {1000}


@pytest.mark.parametrize(("tile", "shingles", "one_task"), [(4096, 1 << 20, 10**6), (40, 5000, 10)])
def test_near_copy_classes_against_brute_force(spark, monkeypatch, tile, shingles, one_task):
    """Pairs on both sides of similarity 0.8, chains, and a large group whose members are like one text but not each other."""
    monkeypatch.setattr(simhash, "TILE", (tile, tile))
    monkeypatch.setattr(simhash, "SHINGLES", shingles)
    monkeypatch.setattr(simhash, "components", lambda s, e: components(s, e, one_task))
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for _ in range(150):
        base = [word() for _ in range(rng.randint(9, 120))]
        copy = list(base)
        for _ in range(rng.randint(1, 2 + len(base) // 30)):
            copy[rng.randrange(len(copy))] = word()
        texts += [base, copy, copy[1:], [*copy, word(), word()]]
    hub = [word() for _ in range(140)]
    for _ in range(250):
        copy = list(hub)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(140)] = word()
        texts.append(copy)
    rows = [(k, " ".join(t)) for k, t in enumerate(rng.sample(texts, len(texts)))]
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(max(1, len(t.split()) - 4))} for i, t in rows}
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    pairs = [(i, j) for i in sets for j in sets if i < j and not sets[i].isdisjoint(sets[j]) and alike(sets[i], sets[j])]
    found = simhash.simhash_components(spark, _docs(spark, rows), 5, 4, 72, similarity=0.8, distinct_shingles=True).collect()
    assert {r["id"]: r["component_id"] for r in found} == _components(pairs, sets)
    assert len(pairs) > 4000


def test_a_large_group_leaves_a_few_edges_a_member(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", (500, 500))
    rng, made = random.Random(9), []
    hub = [f"w{rng.randrange(10**6)}" for _ in range(140)]
    rows = []
    for k in range(2000):
        copy = list(hub)
        for _ in range(k and rng.randint(1, 3)):
            copy[rng.randrange(140)] = f"w{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))

    monkeypatch.setattr(simhash, "components", lambda s, e: made.append(e.count()) or components(s, e))
    assert [r["doc_id"] for r in simhash.drop_near_copies(spark, _docs(spark, rows)).collect()] == [0]
    assert made and max(made) <= 4 * 2000


def test_equal_fingerprints_of_unlike_texts_are_held_against_the_similarity(spark):
    rng = random.Random(6)
    line = " ".join(f"often{c}" for c in "abcdefghi")
    rows = [(k, "\n".join([line] * 60) + "\n" + " ".join(f"w{rng.randrange(10**6)}" for _ in range(50))) for k in range(12)]
    rows += [(100 + k, t + "\n" + line) for k, t in rows[:4]]
    assert len({tuple(simhash.fingerprint(t, 5, 2)) for _, t in rows[:12]}) < 12
    found = simhash.simhash_components(spark, _docs(spark, rows), 5, 2, 28, similarity=0.8).collect()
    assert {r["id"]: r["component_id"] for r in found} == {i: i % 100 for i, _ in rows}


def test_distances_of_long_fingerprints_do_not_overflow():
    zero = np.zeros((1, 4), np.uint64)
    assert list(simhash.linked(zero, ~zero, 72, False)) == []


def test_a_line_repeated_many_times_does_not_hide_a_near_copy(spark):
    rng = random.Random(7)
    rows = []
    for k, times in enumerate((5, 10, 30)):
        base = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
        line = " ".join(f"often{k}{c}" for c in "abcdefghi")
        rows += [(10 * k, base), (10 * k + 1, "\n".join([base, *[line] * times]))]
    assert {r["doc_id"] for r in simhash.drop_near_copies(spark, _docs(spark, rows)).collect()} == {0, 10, 20}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(200, 200), (300, 301), (301, 300), (302, 300)]
    held = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in components(spark, held, 0).collect()}
    assert found == {r["node"]: r["root"] for r in components(spark, held).collect()}
    assert all(found[k] == 0 for k in range(61)) and all(found[k] == 100 for k in range(100, 180)) and found[302] == 300 and 200 not in found


def test_spanning_forest_joins_what_the_links_join():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**10, (300, 1)).astype(np.uint64)
    links = {(i, j) for i in range(300) for j in range(i + 1, 300) if int(a[i, 0] ^ a[j, 0]).bit_count() <= 1}
    forest = list(zip(*(x.tolist() for x in simhash.spanning(a, a, 1, True)), strict=True))
    assert len(forest) < 300 and {(i, j) for i, j, _ in forest} <= links
    assert _components(links, range(300)) == _components([(i, j) for i, j, _ in forest], range(300))


def _dropped(spark, rows, **options):
    docs = line_dedup.numbered(spark, _docs(spark, rows), ["doc_id", "text"])
    return {r["id"]: r["lines"] for r in line_dedup.dropped_lines(spark, docs, **options).collect()}


def _brute_lines(rows):
    """The same by plain loops: whole templates first, then the leaves level by level."""
    lines = []
    for r, (_, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            words = line.split()
            if not words:
                continue
            cut = ["<*>" if re.search("[0-9@]|://", w) else w for w in words]
            lines.append((r, k, words if len(cut) <= 5 and set(cut) == {"<*>"} else cut))
    docs: dict[tuple, set] = {}
    for r, _, t in lines:
        docs.setdefault(tuple(t), set()).add(r)
    gone = {(r, k) for r, k, t in lines if len(docs[tuple(t)]) >= (10 if len(t) <= 2 else 2)}
    left = {(r, tuple(t)) for r, k, t in lines if (r, k) not in gone and len(t) >= 3}
    places = lambda t: [t[i * len(t) // min(len(t), 12) : (i + 1) * len(t) // min(len(t), 12)] for i in range(min(len(t), 12))]
    for place in (None, -1, 3):
        leaves: dict[tuple, list] = {}
        for r, t in left:
            told = None if place is None or place >= len(places(t)) else tuple(places(t)[place])
            leaves.setdefault((len(t), t[: min(3, max(1, len(t) - 2))], told), []).append((r, t))
        found = set()
        for members in leaves.values():
            if len(members) < 5:
                continue
            constant = []
            for column in zip(*(places(t) for _, t in members), strict=True):
                top = max(set(column), key=column.count)
                constant.append(top if 2 * column.count(top) >= len(members) else None)
            solid = sum(c is not None for c in constant)
            if solid < max(2, 0.6 * len(constant)):
                continue
            like = [(r, t) for r, t in members if all(c is None or c == p for c, p in zip(constant, places(t), strict=True))]
            if len({r for r, _ in like}) >= (5 if solid >= 5 else 10):
                found |= set(like)
        gone |= {(r, k) for r, k, t in lines if (r, tuple(t)) in found}
        left -= found
    return {i: sorted(k for r, k in gone if r == at) for at, (i, _) in enumerate(rows)}


def test_dropped_lines_against_brute_force(spark):
    rng = random.Random(12)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    shapes = [rng.choices(words, k=n) for n in (1, 2, 3, 4, 7, 9, 14, 25, 30, 60, 60)]
    shapes += [shapes[9][:3] + rng.choices(words, k=57)]  # another template of the same leaf
    rows = []
    for k in range(60):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 70))) for _ in range(3)] + ["", f"{k} {k + 1}", " ".join(words[:40]) * (k % 2)]
        for shape in rng.sample(shapes, 6):
            line = list(shape)
            if rng.random() < 0.7 and len(line) > 2:
                line[rng.randrange(min(4, len(line) - 1), len(line))] = rng.choice([rng.choice(words), f"{k}.5", f"a{k}@b.c"])
            lines.append(" ".join(line))
        rows.append((k, "\n".join(rng.sample(lines, len(lines)))))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "very " * 50_000)]
    expected = _brute_lines(rows)
    assert _dropped(spark, rows) == expected and sum(map(len, expected.values())) > 150


def test_recurring_templates_are_dropped(spark):
    lines = "job {} of user finished with code {} today"
    rows = [(k, " ".join(f"only{'abcdefgh'[k]}{c}" for c in "mnopqrs") + "\n" + lines.format(k, k * 7) + "\nshort one") for k in range(8)]
    rows += [(50, None), (51, ""), (52, lines.format(9, 9)), (None, lines.format(8, 1))]
    found = {r["id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.without_recurring_lines(spark, _docs(spark, rows)).collect()}
    assert all(found[k][:2] == (3, 1) and "finished" not in found[k][2] and found[k][2].endswith("short one") for k in range(8))
    assert found[50] == (1, 0, "") and found[51] == (1, 0, "") and found[52] == (1, 1, "") and found[None] == (1, 1, "")
    kept = _dropped(spark, rows, keep_first=True)
    assert kept[0] == [] and kept[1] == [1] and kept[51] == []


def test_short_and_long_recurring_lines_are_dropped_too(spark):
    long = " ".join(f"part{chr(97 + c % 26)}{chr(97 + c // 26)}" for c in range(28))
    rows = [(k, f"All rights reserved.\nLicensed under CC BY-NC {k}.0.\nThe end\n\n{k} {k} {k}\nword{chr(97 + k)} alone here\nSubscribe now for more\n{long} last{chr(97 + k)}") for k in range(12)]
    assert all(found == [0, 1, 2, 6, 7] for found in _dropped(spark, rows).values())


def test_short_lines_learn_their_fields(spark):
    names = "ann bob cid dan eve fay gus hal ida jon kim lea".split()
    rows = [(k, f"Posted by {n} today\nPage of {n}\nin {n}") for k, n in enumerate(names)]  # twelve documents
    rows += [(100 + k, f"Sent to {n} yesterday\nThe {n} is {n[::-1]}") for k, n in enumerate(names[:9])]  # nine: too few for a short line
    found = _dropped(spark, rows)
    assert all(found[k] == [0, 1] for k in range(12)) and all(found[100 + k] == [] for k in range(9))


def test_a_very_long_text_and_line(spark):
    line = "word " * 400_000
    found = _dropped(spark, [(1, line), (2, "x\n" + line + "\ny"), (3, "a b c\n" * 100_000)])
    assert found[1] == [0] and found[2] == [1] and found[3] == []


def test_places_that_vary_make_a_leaf_template(spark):
    names = "ann bob cid dan eve fay gus hal ida jon".split()
    rows = [(k, f"login of person {n} was accepted by the gate {n[::-1]}") for k, n in enumerate(names)]
    rows += [(100 + k, f"login of person unlike {' '.join(random.Random(k).choices(names, k=6))}") for k in range(3)]
    found = _dropped(spark, rows)
    assert all(found[k] == [0] for k in range(10)) and all(found[100 + k] == [] for k in range(3))


def test_crc_folds_are_those_of_zlib(spark):
    from pyspark.sql import functions as F

    from tallybrook.llm.toxicity import fold

    assert [r[0] for r in spark.range(50).select(fold(F.col("id"))).collect()] == [zlib.crc32(str(i).encode()) % 5 for i in range(50)]
