import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terrasync.llm import packing


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, rows, encode, window=1024):
    """Pieces tile the documents and, gapless, the sequences; the ids are those of tokenizers."""
    want = Counter((str(r[0]), zlib.crc32(np.array(encode(r[1]), "<u4").tobytes())) for r in rows)
    parts = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
        parts[p.doc_id].append(p)
    for i, ps in parts.items():
        n = sum(1 for r in rows if r[0] == i)
        assert sum(p.length for p in ps) == n * ps[0].doc_tokens
        for start, same in Counter((p.start, p.length) for p in ps).items():
            assert start[0] >= 0 and same <= n
        if n == 1:
            ps.sort(key=lambda p: p.start)
            assert [p.start for p in ps] == [0, *np.cumsum([p.length for p in ps])[:-1]]
            assert (str(i), zlib.crc32(np.concatenate([np.array(p.ids, "<u4") for p in ps]).tobytes())) in want
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    fill = []
    for ps in by.values():
        at = 0
        for offset, length in sorted(ps):
            assert offset == at
            at += length
        assert at <= window
        fill.append(at)
    assert sum(window - f for f in fill) < window
    return fill


@pytest.mark.parametrize("packet", [7, 256, 5000])
def test_pieces(odd, odd_rows, encode, packet):
    check(packing.pack(odd, with_ids=True, packet=packet).collect(), odd_rows, encode)


def test_empty(none):
    assert packing.pack(none).collect() == []


def test_long_runs_of_spaces(encode):
    text = " " * 1_200_000
    assert packing.encoder(*packing.default_files())(text) == encode(text)[:-1]


def test_added_tokens_have_their_own_id(spark):
    """Ids are those of tokenizers with add_special_tokens=False and nothing else set."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endoftext| >", "<|endoftext|>" + " " * 1_200_000]
    own = packing.encoder(*packing.default_files())
    assert own(texts[0]) == [64, 220, 50256, 275]
    assert [own(x) for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    rows = list(enumerate(texts[:4]))
    pieces = packing.pack(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string"), with_ids=True).collect()
    check(pieces, rows, lambda x: [*t.encode(x, add_special_tokens=False).ids, 0])


def test_windows_follow_targets(spark, encode):
    rows = [(i, "word " * (40 + i % 50), f"s{i % 3}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    source = {r[0]: r[2] for r in rows}
    total = sum(len(encode(r[1])) for r in rows)
    for targets in (None, {"s0": 0.5, "s1": 0.3, "s2": 0.2}):
        pieces = packing.pack(df, targets=targets, packet=64, with_ids=True).collect()
        check(pieces, rows, encode)
        share = defaultdict(Counter)
        for p in pieces:
            share[p.sequence_id][source[p.doc_id]] += p.length
        want = targets or {s: sum(len(encode(r[1])) for r in rows if r[2] == s) / total for s in ("s0", "s1", "s2")}
        for w in range(10):  # while all queues last, each window misses a target by less than two packets
            assert all(abs(share[w][s] - 1024 * want[s]) <= 128 for s in want)
        run = Counter()
        for w in range(10):
            run += share[w]
            assert all(abs(run[s] - 1024 * (w + 1) * want[s]) <= 128 for s in want)  # and deficits don't pile up


@pytest.mark.parametrize("seed", range(20))
def test_rounds_by_brute_force(seed):
    """Pieces of all queues tile the stream, and the stream is what rounds sent one by one would give."""
    rng = np.random.default_rng(seed)
    tokens = rng.integers(1, 3000, int(rng.integers(1, 8)))
    quanta = tokens / tokens.sum() * 64 if seed % 2 else (x := rng.random(len(tokens)) * 30 + 0.01) / x.sum() * 64
    order = np.argsort(-quanta)
    quanta, tokens = quanta[order], tokens[order]
    packets = [1 if q >= 1 else 16 for q in quanta]
    want, sent, r = [], [0] * len(tokens), 0
    while len(want) < tokens.sum():
        r += 1
        for s, (q, p, t) in enumerate(zip(quanta.tolist(), packets, tokens.tolist(), strict=True)):
            due = min(int(r * q // p) * p, t)
            want += [(s, k) for k in range(sent[s], due)]
            sent[s] = due
    got = [None] * len(want)
    rounds = packing.Rounds(quanta.tolist(), tokens.tolist(), packets)
    for s, t in enumerate(tokens):
        cuts = np.unique(np.append(rng.integers(0, t, 5), [0, t]))
        for owner, start, length, at in zip(*rounds.pieces(np.full(len(cuts) - 1, s), cuts[:-1], np.diff(cuts)), strict=True):
            for k in range(length):
                assert got[at + k] is None
                got[at + k] = (s, int(cuts[owner] + start + k))
    assert got == want


def test_windows_of_documents_hold_their_proportions(spark):
    """Shipped settings: each window holds a source's share but for one token; the largest gives way by a token a source."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    total, per, share = sum(p.length for p in pieces), Counter(), defaultdict(Counter)
    for p in pieces:
        per[p.source] += p.length
        share[p.sequence_id][p.source] += p.length
    assert len(per) > 5
    largest = max(per, key=per.get)
    for w in range(total // 1024):
        for s, n in per.items():
            assert abs(share[w][s] - 1024 * n / total) <= 1 + len(per) * (s == largest) + 1e-6


def test_small_sources_and_targets_of_zero(spark, encode):
    rows = [(i, "word " * 300, "big") for i in range(120)] + [(1000 + i, f"some {i}", f"tiny{i}") for i in range(30)] + [(2000 + i, "late " * 50, ["x", None][i % 2]) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    check(packing.pack(df, with_ids=True).collect(), rows, encode)
    got = packing.pack(df, targets={"x": 0, None: 0.0}, with_ids=True).collect()
    check(got, rows, encode)
    place = {p.doc_id: p.sequence_id * 1024 + p.offset for p in got}
    assert max(v for k, v in place.items() if k < 2000) < min(v for k, v in place.items() if k >= 2000)
    check(packing.pack(df, targets={r[2]: 0 for r in rows}, with_ids=True).collect(), rows, encode)
    with pytest.raises(ValueError):
        packing.pack(df, targets={"big": -1})
