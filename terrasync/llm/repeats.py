"""Removal of byte strings that repeat across a corpus: minimizer election and hashed windows, in place of prefix doubling.

Ranks are doubled inside a task only, up to GRAM bytes; Spark doesn't sort in rounds at growing offsets (README says why). The rank of the string of n bytes at a position is a pair of ranks of half that length, those at the
position and n / 2 further on, turned into one number. A string of LENGTH bytes repeats only if the
shorter strings in it do, so positions whose rank is unique drop out at each length that Spark sorts:

1. Ranks of 1, 2, 4 ... GRAM bytes at every position, doubled inside a task. Every window of LENGTH bytes
   elects the position in it whose GRAM-byte rank is smallest (the last of equals). The choice depends on
   the window's bytes alone, so equal windows elect the same place, and only elected positions go on.
2. The stretch of all windows that elect one position, LENGTH to about 2 * LENGTH - GRAM bytes. Spark
   deals and sorts (gram rank, stretch rank, position). The first of equal stretches stands for the others,
   all of whose windows are repeats. A gram with one stretch is done. Grams that a sample shows to stand in
   very many unlike stretches are dealt by part of the stretch rank too, and go to step 3 in any case.
3. LENGTH bytes, the threshold, at every position of the stretches left, that is of grams with unlike
   stretches (the edges of repeated passages). The first of equal windows stays.

Ranks are 64-bit hashes, two independent ones wherever equality decides, and the bytes themselves in
step 3 (hashes again for grams with more than BIG stretches, whose windows are dealt out one by one).
Tasks settle repeats inside their own rows before anything is shuffled, so a string that a third of the
documents share goes to the shuffle once for each task. Texts travel compressed.

Doubling over every byte's position was measured to shuffle 86 times the text (README); the election keeps one position
in thirty and loses no repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from .common import written

LENGTH, GRAM = 100, 32
#: Unlike stretches of a gram from which its windows are dealt out one by one.
BIG = 256
#: Documents sampled for hot grams; unlike stretches there that make a gram hot; hot grams at most; parts of one.
#: They decide how rows are dealt out, never a result.
SAMPLE, HOT, MOST_HOT, PARTS = 512, 4, 10_000, 64
#: Windows that are looked at together, and stretches that a task gathers before it settles them.
CHUNK, GATHER = 1 << 18, 1 << 22
_LOW = np.uint64(0xFFFFFF)
_LAST = (1 << 63) - 1


@lru_cache(maxsize=1)
def _byte_ranks() -> np.ndarray:
    """A random odd number for each byte."""
    return np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def doubled(ranks: np.ndarray, offset: int) -> np.ndarray:
    """Ranks of the pairs (rank at i, rank at i + offset)."""
    pair = ranks[:-offset] * np.uint64(0x9E3779B97F4A7C15)
    pair ^= pair >> np.uint64(32)
    pair += ranks[offset:]
    pair *= np.uint64(0xBF58476D1CE4E5B9)
    pair ^= pair >> np.uint64(29)
    return pair


def stretches(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram rank, stretch rank, first and last window (starts) of every stretch of data. gram is a power of two."""
    out: list[tuple[np.ndarray, ...]] = []
    span = length - gram + 1
    for o in range(0, len(data) - length + 1, CHUNK):
        part = data[o : o + CHUNK + length - 1]
        h, n = _byte_ranks()[np.frombuffer(part, np.uint8)], 1
        while n < gram:
            h, n = doubled(h, n), 2 * n
        least = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: -(span - width)], least[span - width :])
        elected = (_LOW - (least & _LOW)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(elected[1:] != elected[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [len(elected) - 1]])
        at = elected[first]
        rank = np.fromiter((xxh3_64_intdigest(part[a:e], d) for a, e, d in zip(first.tolist(), (last + length).tolist(), (at - first).tolist(), strict=True)), np.uint64, len(first))
        out.append((h[at], rank, first + o, last + o))
    if not out:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def merge(start: np.ndarray, end: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of intervals, sorted by (group, start), as maximal runs; those that touch are one."""
    group = np.zeros(len(start), np.int64) if group is None else group
    if not len(start):
        return start, end, group
    # Each group is shifted beyond the one before, so one running maximum serves them all.
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    shift = (np.cumsum(new_group) - 1) * (end.max() + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return start[first], (reach - shift)[np.append(first[1:], len(start)) - 1], group[first]


def merge_docs(start: np.ndarray, end: np.ndarray, doc: np.ndarray, sub: np.ndarray) -> tuple[np.ndarray, ...]:
    """merge() within documents, sorted by (doc, sub, start)."""
    if not len(start):
        return start, end, doc, sub
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])])
    start, end, group = merge(start, end, np.cumsum(new) - 1)
    first = np.flatnonzero(new)[group]
    return start, end, doc[first], sub[first]


def _sub(text: bytes, no_id: bool) -> int:
    """Tells documents of one doc apart, by text; those without an id come last."""
    return xxh64_intdigest(text) >> 2 | no_id << 62


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, sub, id, z): z the compressed bytes of a text; doc a null-free id, with null last; sub from _sub()."""
    one = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)).alias("doc"), docs[id_col].alias("id"), docs[text_col].alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            sub = [_sub(t, not has) for t, has in zip(texts, b.column("id").is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(sub, pa.int64()), b.column("id"), pa.array(map(squeeze, texts), pa.binary())], ["doc", "sub", "id", "z"])

    return one.mapInArrow(each, f"doc bigint, sub bigint, id {one.schema['id'].dataType.simpleString()}, z binary")


def _rows(*columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names)


_RANKED = ["kind", "gram", "rank", "doc", "sub", "at"]


def hot_grams(docs: DataFrame, text_col: str, length: int = LENGTH) -> np.ndarray:
    """Gram ranks, MOST_HOT at most, with more than HOT unlike stretches in about SAMPLE documents, sorted."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    one = docs.select(docs[text_col].alias("text")).sample(False, share, 42)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column("text").to_pylist():
                gram, rank, _, _ = stretches((text or "").encode(), length)
                yield _rows(gram, rank, names=["gram", "rank"])

    found = one.mapInArrow(each, "gram bigint, rank bigint").distinct().groupBy("gram").agg(F.count("*").alias("n"))
    rows = found.where(F.col("n") > HOT).orderBy(F.desc("n"), "gram").limit(MOST_HOT).collect()
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def _ranked(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """Steps 1 and 2, inside a task: the first of equal stretches (kind 0, or 2 if its gram is hot, at = first
    window << 8 | windows - 1), and what the others show to be repeated (kind 1, from rank to at)."""
    hot = hot_grams(docs, text_col, length)
    one = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)).alias("doc"), docs[id_col].isNull().alias("no_id"), docs[text_col].alias("text"))

    def settle(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        gram, rank, first, last, doc, sub = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((first, sub, doc))
        order = order[np.argsort((gram ^ (rank * np.uint64(0x9E3779B97F4A7C15)))[order], kind="stable")]
        gram, rank, first, last, doc, sub = (x[order] for x in (gram, rank, first, last, doc, sub))
        again = np.zeros(len(gram), bool)
        again[1:] = (gram[1:] == gram[:-1]) & (rank[1:] == rank[:-1])
        same = np.zeros(len(gram), bool)  # a document that is listed twice doesn't repeat itself
        same[1:] = again[1:] & (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (first[1:] == first[:-1])
        keep = ~again
        yield _rows(np.where(np.isin(gram[keep], hot), 2, 0).astype(np.int8), gram[keep], rank[keep], doc[keep], sub[keep], first[keep] << 8 | (last - first)[keep], names=_RANKED)
        again &= ~same
        start, end, doc, sub = first[again], last[again] + length, doc[again], sub[again]
        order = np.lexsort((start, sub, doc))
        start, end, doc, sub = merge_docs(start[order], end[order], doc[order], sub[order])
        yield _rows(np.ones(len(start), np.int8), doc ^ sub, start, doc, sub, end, names=_RANKED)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for doc, no_id, text in zip(*(b.column(x).to_pylist() for x in ("doc", "no_id", "text")), strict=True):
                data = (text or "").encode()
                got = stretches(data, length)
                if len(got[0]):
                    held.append((*got, np.full(len(got[0]), doc, np.int64), np.full(len(got[0]), _sub(data, no_id), np.int64)))
                    n += len(got[0])
                if n >= GATHER:
                    yield from settle(held)
                    held, n = [], 0
        if held:
            yield from settle(held)

    return one.mapInArrow(each, "kind tinyint, gram bigint, rank bigint, doc bigint, sub bigint, at bigint")


def _settled(ranked: DataFrame, length: int, big: int) -> DataFrame:
    """Step 2 over all tasks: repeats (gram null, from start to end) and the stretches of grams that have
    several (gram, first and last window in start and end; large: more than big of them, or the gram is hot).

    Rows come sorted and stream through: a task holds one batch and at most big stretches of one gram.
    """

    def out(doc: np.ndarray, sub: np.ndarray, start: np.ndarray, end: np.ndarray, gram: np.ndarray | None = None, large: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(doc)
        grams = pa.nulls(n, pa.int64()) if gram is None else pa.array(gram)
        flags = pa.array(np.zeros(n, bool) if large is None else large)
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(sub), pa.array(start), pa.array(end), grams, flags], ["doc", "sub", "start", "end", "gram", "large"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: dict[int, tuple[int, ...]] = {}  # the last row of a kind
        held = [np.zeros(0, np.int64)] * 5  # gram, doc, sub, start, stop of the last gram's first stretches
        gone_on = None  # the last gram and its number of stretches, if they were passed on as too many
        for b in batches:
            kinds, *columns = (b.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            if (done := kinds == 1).any():
                yield out(columns[2][done], columns[3][done], columns[1][done], columns[4][done])
            for kind in (0, 2):
                if not (here := kinds == kind).any():
                    continue
                gram, rank, doc, sub, at = (x[here] for x in columns)
                last = before.get(kind)
                lead, same = np.ones(len(gram), bool), np.zeros(len(gram), bool)
                lead[1:] = (gram[1:] != gram[:-1]) | (rank[1:] != rank[:-1])
                same[1:] = (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (at[1:] == at[:-1])
                if last:
                    lead[0] = (gram[0], rank[0]) != last[:2]
                    same[0] = (doc[0], sub[0], at[0]) == last[2:]
                before[kind] = gram[-1], rank[-1], doc[-1], sub[-1], at[-1]
                start = at >> 8
                stop = start + (at & 255)
                again = ~lead & ~same
                yield out(doc[again], sub[again], start[again], stop[again] + length)
                rows = [x[lead] for x in (gram, doc, sub, start, stop)]
                if kind == 2:
                    yield out(*rows[1:], rows[0], np.ones(len(rows[0]), bool))
                    continue
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
                if not len(rows[0]):
                    continue
                group = np.cumsum(np.concatenate([[0], rows[0][1:] != rows[0][:-1]]))
                unlike = np.bincount(group)
                if gone_on and gone_on[0] == rows[0][0]:
                    unlike[0] += gone_on[1]
                full = unlike[-1] > big
                of, is_last = unlike[group], group == group[-1]  # the last gram may go on in the next batch
                left = (of > 1) & (~is_last | full)
                yield out(*(x[left] for x in rows[1:]), rows[0][left], of[left] > big)
                gone_on = (rows[0][-1], unlike[-1]) if full else None
                held = [x[is_last & ~full] for x in rows]
        if len(held[0]) > 1:
            yield out(*held[1:], held[0], np.zeros(len(held[0]), bool))

    part = F.when(F.col("kind") == 2, F.pmod("rank", F.lit(PARTS))).otherwise(F.lit(0))
    dealt = ranked.repartition(F.col("gram"), part).sortWithinPartitions("kind", "gram", "rank", "doc", "sub", "at")
    return dealt.mapInArrow(each, "doc bigint, sub bigint, start bigint, end bigint, gram bigint, large boolean")


def _windows(docs: DataFrame, left: DataFrame, length: int) -> DataFrame:
    """Step 3: repeats (doc, sub, start, end) among the windows of the stretches that are left."""
    spans = left.groupBy("doc", "sub").agg(F.collect_list(F.struct("gram", "start", "end", "large")).alias("spans")).toDF("d", "s", "spans")
    met = docs.select("doc", "sub", "z").join(spans, (F.col("doc") == F.col("d")) & (F.col("sub") == F.col("s"))).select("doc", "sub", "z", "spans")
    schema = pa.schema([("gram", pa.int64()), ("rank", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("bytes", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        firsts: dict[tuple[int, int], tuple[int, int, int]] = {}  # of the windows dealt out one by one
        repeats: list[tuple[int, int, int]] = []
        for b in batches:
            out: list[tuple] = []
            for doc, sub, z, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = expand(z)
                for x in spans:
                    gram, first, last = x["gram"], x["start"], x["end"]
                    if not x["large"]:
                        out.append((gram, 0, doc, sub, first, last, text[first : last + length]))
                        continue
                    for i in range(first, last + 1):
                        key, here = (gram, xxh3_64_intdigest(text[i : i + length]) - (1 << 63)), (doc, sub, i)
                        there = firsts.setdefault(key, here)
                        if here != there:
                            firsts[key] = min(here, there)
                            repeats.append(max(here, there))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
            if len(firsts) > GATHER:
                yield from dealt_out(firsts, repeats)
                firsts, repeats = {}, []
        yield from dealt_out(firsts, repeats)

    def dealt_out(firsts, repeats) -> Iterator[pa.RecordBatch]:
        rows = [(g, r, doc, sub, i, i, None) for (g, r), (doc, sub, i) in firsts.items()]
        if repeats:
            at = np.array(sorted(repeats), np.int64)
            merged = merge_docs(at[:, 2], at[:, 2] + length, at[:, 0], at[:, 1])
            rows += [(d ^ s, 0, d, s, a, -e, None) for a, e, d, s in zip(*(x.tolist() for x in merged), strict=True)]  # end < 0: settled
        for k in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 50_000], strict=True), schema.types, strict=True)], schema=schema)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, before = None, set(), None
        for b in batches:
            got: list[tuple[int, int, int, int]] = []
            columns = (b.column(i).to_pylist() for i in range(7))
            for gram, rank, doc, sub, first, last, data in zip(*columns, strict=True):
                if last < 0:
                    got.append((doc, sub, first, -last))
                    continue
                if (gram, rank) != now:
                    now, seen, before = (gram, rank), set(), None
                if (doc, sub, first) == before:  # a document that is listed twice
                    continue
                if data is None:
                    if before is not None:
                        got.append((doc, sub, first, first + length))
                    before = doc, sub, first
                    continue
                before = doc, sub, first
                for j in range(last - first + 1):
                    if (w := data[j : j + length]) in seen:
                        got.append((doc, sub, first + j, first + j + length))
                    else:
                        seen.add(w)
            if got:
                at = np.array(sorted(set(got)), np.int64)
                start, end, doc, sub = merge_docs(at[:, 2], at[:, 3], at[:, 0], at[:, 1])
                yield _rows(doc, sub, start, end, names=["doc", "sub", "start", "end"])

    fetched = met.mapInArrow(fetch, "gram bigint, rank bigint, doc bigint, sub bigint, start bigint, end bigint, bytes binary")
    return fetched.repartition("gram", "rank").sortWithinPartitions("gram", "rank", "doc", "sub", "start").mapInArrow(settle, "doc bigint, sub bigint, start bigint, end bigint")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, big: int = BIG) -> tuple[DataFrame, DataFrame]:
    """(doc, sub, start, end): bytes covered by strings of length bytes that start earlier too; and the packed texts.

    Spans may overlap or touch. Documents are ordered by id, null last, and those of one id by a hash of the text.
    """
    packed = _packed(docs, id_col, text_col)
    settled = written(_settled(_ranked(docs, id_col, text_col, length), length, big), "repeats-settled")
    windows = written(_windows(packed, settled.where("gram is not null"), length), "repeats-windows")
    return settled.where("gram is null").select("doc", "sub", "start", "end").unionByName(windows), packed


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, big: int = BIG, with_text: bool = False) -> DataFrame:
    """A row for each row of docs: id_col, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left).

    Every byte is removed that lies in a string of length bytes which also starts earlier, in a document
    of smaller id or earlier in its own; overlaps count, and strings are judged on the input. A null or
    short text keeps all; a null id counts as the largest. Rows that agree in id (null or not) and text are one
    document listed twice and don't repeat each other; unlike texts of one id are documents of their own, in
    the order of a hash. Other columns are ignored; an empty table gives an empty result.
    """
    spans, packed = repeated_spans(docs, id_col, text_col, length, big)
    listed = spans.groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "end")).alias("spans")).toDF("d", "s", "spans")
    met = packed.join(listed, (F.col("doc") == F.col("d")) & (F.col("sub") == F.col("s")), "left").select("id", "z", "spans")
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            rows = []
            lists = b.column("spans")
            for i, z in enumerate(b.column("z").to_pylist()):
                text = expand(z)
                kept, gone, n = text, 0, 0
                if lists[i].is_valid:
                    x = lists[i].values
                    start, end = x.field(0).to_numpy(), x.field(1).to_numpy()
                    order = np.argsort(start, kind="stable")
                    start, end, _ = merge(start[order], end[order])
                    n, gone = len(start), int((end - start).sum())
                    kept = b"".join(text[a:e] for a, e in zip([0, *end.tolist()], [*start.tolist(), len(text)], strict=True))
                rows.append((len(text), gone, n, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            out = [b.column("id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            yield pa.RecordBatch.from_arrays(out + [pa.array(columns[4], pa.binary())] * with_text, names)

    schema = f"id {met.schema['id'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return met.mapInArrow(each, schema).withColumnRenamed("id", id_col)
