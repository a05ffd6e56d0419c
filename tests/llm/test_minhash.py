import random
import time

import numpy as np
import pytest

import corpus_pipeline
from terrasync.llm import minhash, simhash

from .conftest import SCHEMA, prose
from .test_simhash import components


def grams(text, k=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def near(texts):
    sets = [grams(t) for t in texts]
    return [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


def edited(rng, text, n):
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = prose(rng, 1) + "z"
    return " ".join(words)


def run(spark, rows):
    width = len(SCHEMA.split(","))
    df = spark.createDataFrame([(i, t, "en", "s", *[None] * (width - 4)) for i, t in rows], SCHEMA).repartition(4)
    return corpus_pipeline.near_dedup(spark, df, "").collect()


@pytest.mark.parametrize("small", [2, 16])
def test_scattered_edits(spark, monkeypatch, small):
    """Near copies with edited words go, down to a similarity of 0.8, and what is less alike stays."""
    monkeypatch.setattr(minhash, "SMALL", small)
    rng = random.Random(4)
    texts = []
    for _ in range(25):
        base = prose(rng, rng.randint(60, 400))
        texts += [base] + [edited(rng, base, max(1, round(len(base.split()) * x))) for x in (0.005, 0.012, 0.02, 0.03, 0.06)]
    base = prose(rng, 300)
    texts += [edited(rng, base, rng.randint(1, 12)) for _ in range(60)]  # a large group, not all within 0.8 of each other
    want = components(near(texts), range(len(texts)))
    assert 40 < len(set(want.values())) < len(texts) - 60
    assert sorted(r.doc_id for r in run(spark, list(enumerate(texts)))) == sorted(set(want.values()))


def test_rows_of_one_id_are_judged_apart(spark):
    rng = random.Random(6)
    a, b, c = (prose(rng, 80) for _ in range(3))
    got = run(spark, [(1, a), (2, edited(rng, a, 1)), (2, b), (2, b), (3, c), (3, edited(rng, b, 1)), (None, a), (None, c)])
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted([("1", a), ("2", b), ("3", c), ("None", a), ("None", c)])


def test_odd_rows(spark, odd, odd_rows, none):
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = [r for r in odd_rows if r[0] is not None]
    want = components([(i, j) for i, j in near([r[1] for r in rows])], range(len(rows)))
    least = {}
    for k, c in want.items():
        least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, least.values()), "None"])
    assert minhash.keep_one(none).collect() == []


def test_recall_of_bands():
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(300):
        both, one, two = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (160, 20, 20))
        met += (minhash.band_keys(np.append(both, one)) == minhash.band_keys(np.append(both, two))).any()
    assert met >= 299


def test_keys_dealt_in_parts(spark, monkeypatch):
    """Keys that many nodes have are dealt in parts, whose centers meet again."""
    monkeypatch.setattr(minhash, "HOT", 0.001)
    monkeypatch.setattr(minhash, "SALTS", 5)
    rng = random.Random(8)
    base = prose(rng, 200)
    texts = [base] + [edited(rng, base, rng.randint(1, 9)) for _ in range(150)] + [prose(rng, 50) for _ in range(20)]
    want = components(near(texts), range(len(texts)))
    assert len(set(want.values())) > 25
    assert sorted(r.doc_id for r in run(spark, list(enumerate(texts)))) == sorted(set(want.values()))


def prefixes(spark, rows):
    return spark.createDataFrame(rows, "node long, n long, token long, at long, component long")


@pytest.mark.parametrize("part", [3, 512])
def test_prefixes_that_can_be_near(spark, monkeypatch, part):
    """Pairs that meet are those of sizes and places that allow the common part, of unlike components, and no others."""
    monkeypatch.setattr(minhash, "PART", part)
    rng = random.Random(9)
    sizes = {v: rng.choice([1, 5, 30, 31, 33, 36, 40, 100, 101, 118, 124]) for v in range(300)}
    homes = {v: v if rng.random() < 0.6 else 1000 for v in sizes}
    rows = [(v, n, t, at, homes[v]) for v, n in sizes.items() for t, at in zip(rng.sample(range(12), 3), sorted(rng.sample(range(max(3, n // 8)), 3)), strict=False) if at <= n - -(-n * 4 // 5)]
    want = set()
    for i, (a, n, t, at, home) in enumerate(rows):
        for b, m, u, bt, other in rows[:i]:
            if t == u and home != other and min(n, m) * 5 >= max(n, m) * 4 and min(n - at, m - bt) * 9 >= (n + m) * 4:
                want.add((min(a, b), max(a, b)))
    assert len(want) > 300
    got = [tuple(r) for r in minhash._across(prefixes(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert minhash._across(prefixes(spark, rows[:0])).collect() == []


def test_a_template_is_not_compared_pair_by_pair(spark):
    """100,000 texts share a shingle that stands too late in all of them: five billion pairs, of which none is formed. A smaller text meets them all."""
    many = spark.range(100_000).selectExpr("id AS node", "100L AS n", "7L AS token", "19L AS at", "id AS component")
    few = prefixes(spark, [(-1, 80, 7, 0, -1)])
    began = time.monotonic()
    met = minhash._across(many.union(few))
    assert met.count() == 100_000 and met.where("a <> -1").isEmpty()
    assert time.monotonic() - began < 90


def test_fingerprints_meet_by_blocks(spark, monkeypatch):
    """Pairs within four bits are found by SimHash alone, and only those that the exact check lets pass."""
    met = minhash._keyed
    monkeypatch.setattr(minhash, "_keyed", lambda nodes: met(nodes).where("false"))
    rng = random.Random(11)
    texts = []
    for _ in range(40):
        base = prose(rng, rng.randint(100, 500))
        texts += [base, edited(rng, base, rng.randint(1, 3))]
    cycle = "red green blue white black " * 60  # equal fingerprints, unlike sets
    texts += [cycle, cycle + "one two", "", None]
    fps = [simhash.fingerprint(t, 5) for t in texts]
    assert fps[80] == fps[81] and (80, 81) not in near(texts)
    links = [(i, j) for i, j in near(texts) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert 15 < len(links) < len(near(texts))
    want = components(links, range(len(texts)))
    assert sorted(r.doc_id for r in run(spark, list(enumerate(texts)))) == sorted(set(want.values()))
