import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from terrasync.llm import simhash
from terrasync.llm.components import connected_components


def plain(text, k=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_fingerprint(odd_rows):
    for r in odd_rows[:20]:
        assert simhash.fingerprint(r[1]) == plain(r[1])


def near(fps, bits=4):
    fps = np.array(fps, np.uint64)
    return [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= bits) if i < j]


@pytest.mark.parametrize("small", [2, 16])
def test_links_connect_what_is_near(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(2)
    fps = set()
    for _ in range(60):  # chains and balls of near fingerprints, among far ones
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            fps.add(f)
            for _ in range(rng.randint(1, 5)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    links = simhash.near_links(spark.createDataFrame(signed, "node long, fp long"))
    got = components([(r.a, r.b) for r in links.collect()], range(len(fps)))
    assert got == components(near(fps), range(len(fps)))
    labels = {r.node: r.component for r in connected_components(links).collect()}
    assert all(labels.get(n, n) == got[n] for n in got)


def test_masks():
    for n in (10, 1 << 20, 1 << 34):
        masks = simhash.block_masks(n)
        full = (1 << 64) - 1
        rng = random.Random(n)
        for _ in range(200):
            x = 0
            for b in rng.sample(range(64), 4):
                x |= 1 << b
            assert any(x & m == 0 for m in masks) and all(0 < m < full for m in masks)
    assert len(simhash.block_masks(1 << 34)) > len(simhash.block_masks(10))


def test_odd_rows(odd, odd_rows, none):
    got = simhash.near_duplicates(odd).collect()
    ids = [r[0] if r[0] is not None else -1 for r in odd_rows]
    fps = [plain(r[1]) for r in odd_rows]
    comp = components(near(fps), range(len(ids)))
    least = {}
    for k, i in enumerate(ids):
        if i >= 0:
            least[comp[k]] = min(least.get(comp[k], i), i)
    want = sorted((str(odd_rows[k][0]), least[comp[k]]) for k in range(len(ids)))
    assert sorted((str(r.doc_id), r.component_id) for r in got) == want
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, set(least.values())), "None"])
    assert simhash.near_duplicates(none).collect() == [] and simhash.keep_one(none).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 5000) for i in range(100)] + [(7, 7), (3000, 2000)]
    rng = random.Random(0)
    names = list(range(10_000))
    rng.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components(edges, {n for e in edges for n in e})
    assert got == {n: c for n, c in want.items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("hot", [0.0005, 0.01])
def test_keys_of_many_unlike_fingerprints(spark, monkeypatch, hot):
    """All fingerprints agree in 40 bits, so most keys hold them all; links are those of all pairs."""
    monkeypatch.setattr(simhash, "LARGE", 64)
    monkeypatch.setattr(simhash, "SAMPLE", 1000)
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(3)
    fps = sorted({rng.getrandbits(24) << 20 | 0x5A for _ in range(1500)})
    links = simhash.near_links(spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "node long, fp long"))
    assert components([(r.a, r.b) for r in links.collect()], range(len(fps))) == components(near(fps), range(len(fps)))


def test_many_unlike_fingerprints_in_one_task():
    import time

    fp = np.random.default_rng(0).integers(0, 1 << 43, 200_000, dtype=np.uint64)
    began = time.perf_counter()
    simhash._links(fp, 4)
    assert time.perf_counter() - began < 30


def test_rows_without_an_id_link_others(spark, monkeypatch):
    """Fingerprints 0, 3 bits, 6 bits: the middle one has no id."""
    monkeypatch.setattr(simhash, "fingerprint", lambda t, _: {"a": 0, "b": 7, "c": 63}[t])
    df = spark.createDataFrame([(5, "a"), (None, "b"), (9, "c")], "doc_id long, text string")
    fps = [{"a": 0, "b": 7, "c": 63}[r.text] for r in df.collect()]
    rows = spark.createDataFrame([(r.doc_id, f, f, f) for r, f in zip(df.collect(), fps, strict=True)], f"id long, fp long, {simhash.ROW[0]} long, {simhash.ROW[1]} long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: rows)
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()} == {(5, 5), (None, 5), (9, 5)}


def test_keep_one_judges_texts_of_one_id_apart(spark):
    x, y = "one two three four five six " * 3, "seven eight nine ten eleven twelve " * 3
    df = spark.createDataFrame([(1, x), (1, y), (2, y), (2, y)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(df).collect()) == [(1, x), (1, y)]
