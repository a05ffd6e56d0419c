import hashlib
import random

import pytest

from terrasync.llm import repeats


def brute(rows, length=100):
    seen, out = {}, {}
    key = lambda r: (r[0] is None, r[0] or 0)
    for i, text in sorted({r[:2] for r in rows}, key=key):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen.setdefault(b[k : k + length], (i, k)) != (i, k):
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def run(df, **how):
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in repeats.remove_repeats(df, **how).collect()]


@pytest.mark.parametrize("big", [2, 256])
@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, big):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcd e") for _ in range(rng.randint(50, 400))) for _ in range(10)]
    piece = lambda: rng.choice([rng.choice(pool), "x" * rng.randint(0, 300), "".join(rng.choice("abé") for _ in range(rng.randint(0, 120)))])
    rows = [(i, "".join(piece() for _ in range(rng.randint(0, 6)))) for i in range(250)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert dict(run(df, big=big)) == brute(rows)


@pytest.mark.parametrize("hot", [1, 1 << 30])
def test_dealing_does_not_matter(spark, monkeypatch, hot):
    """Hot grams or none, and batches of a few rows, across which grams and stretches go on."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(7)
    phrase = "".join(rng.choice("abcdefgh") for _ in range(60))
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    tails = [some(90) for _ in range(6)]
    rows = [(i, some(rng.randint(0, 80)) + phrase + rng.choice(tails) + some(rng.randint(0, 80))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert (len(repeats.hot_grams(df, "text")) > 0) == (hot == 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert dict(run(df, big=3)) == brute(rows) == dict(run(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(odd, odd_rows, none):
    got, want = run(odd), brute([r[:2] for r in odd_rows])
    assert len(got) == len(odd_rows) and all(v == want[k] for k, v in got)
    assert run(none) == []
    kept = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(odd, with_text=True).collect()}
    assert kept[3] == b"one" and all(hashlib.sha256(v).hexdigest() == want[k][3] for k, v in kept.items())


@pytest.mark.parametrize("big", [2, 256])
def test_unlike_texts_of_one_id_or_none(spark, big):
    """Documents are told apart by id and text; several have no id, or one id, and passages at equal places."""
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    pool = [some(150) for _ in range(4)]
    rows = [(rng.choice([None, None, 5, (1 << 63) - 1, 10 + i]), rng.choice([pool[0], some(150)]) + some(rng.randint(0, 90)) + rng.choice(pool) + some(40)) for i in range(80)]
    rows += rows[:5]
    order = lambda r: (r[0] is None, r[0] or 0, repeats._sub(r[1].encode(), r[0] is None))
    seen, want = {}, {}
    for r in sorted(set(rows), key=order):
        b = r[1].encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if seen.setdefault(b[k : k + 100], (r, k)) != (r, k):
                gone[k : k + 100] = b"\1" * 100
        want[r] = bytes(x for x, g in zip(b, gone, strict=True) if not g)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = repeats.remove_repeats(df, big=big, with_text=True).collect()
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in got) == sorted((str(r[0]), want[r]) for r in rows)


def test_chunks_do_not_matter(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("ab") for _ in range(3000)).encode()
    whole = repeats.stretches(text)
    assert whole[2][0] == 0 and whole[3][-1] == len(text) - 100 and (whole[2][1:] == whole[3][:-1] + 1).all()
