"""SimHash near-duplicates with pigeonhole blocks.

A text's 64-bit fingerprint is split into blocks. Two fingerprints that differ in at most `bits` bits agree
on all but `bits` of the blocks, so they meet under a key made of one choice of the agreeing blocks. Equal
fingerprints are one node from the start; fingerprints meet by key, and those that meet are verified by
their Hamming distance. Of a key's fingerprints only links that join them are kept: members of a large
close group are absorbed one by one, so a group of n near copies gives n - 1 links and not all pairs.
A key that very many unlike fingerprints share is split by blocks of the bits that are left: over tasks where a
sample shows it to hold a great share of all, and inside its task from LARGE fingerprints on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import ROW, keep_firsts, row_hashes, written
from .components import connected_components

SHINGLE, BITS, SEED = 4, 4, 42
#: Fingerprints that a key should hold on average, if they spread evenly.
PER_KEY = 16
#: Up to so many fingerprints of a key are compared pair by pair.
SMALL = 16
#: From so many on they are met by blocks of the bits in which they differ.
LARGE = 2048
#: Up to so many of one block are then compared pair by pair.
FEW = 128
#: Fingerprints sampled for keys of a great share of all, and the share from which a key is split over tasks.
SAMPLE, HOT = 4096, 0.01


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the text's word shingles in order, repeats included; a shorter text is one shingle, no words: none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    pairs = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(words) - k + 1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles, repeats included; no words: 0."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(h: np.ndarray) -> int:
    """That of shingle hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, the row's hashes) for every row, fp being the fingerprint's bits as a signed long."""
    one = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *(c.alias(n) for n, c in row_hashes(docs, id_col, text_col).items()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp), *map(b.column, ROW)], ["id", "fp", *ROW])

    return one.mapInArrow(each, f"id {one.schema['id'].dataType.simpleString()}, fp bigint, {ROW[0]} bigint, {ROW[1]} bigint")


def block_masks(n: int, bits: int = BITS, per_key: int = PER_KEY) -> list[int]:
    """Masks of the block choices, for n fingerprints: the fewest blocks whose keys are long enough for n.

    At least two blocks must agree, so that keys are long and rows per fingerprint alike up to about
    per_key * 2**21 fingerprints. With r blocks a choice has r - bits of them. More blocks mean longer keys and more choices, so the
    work of a fingerprint grows slowly while keys stay short of members.
    """
    r = bits + 2
    while r < 2 * bits and n > per_key << (64 * (r - bits) // r):
        r += 1
    return _choices(range(64), r, r - bits)


def _choices(places, r: int, agree: int) -> list[int]:
    """Masks of agree of r blocks over the bits at these places."""
    places = list(places)
    edges = [len(places) * i // r for i in range(r + 1)]
    blocks = [sum(1 << p for p in places[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, agree)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _links(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (places) within one key that connect what all links within distance would connect."""
    if len(fp) > LARGE:
        unlike = int(np.bitwise_or.reduce(fp ^ fp[0]))
        places = [p for p in range(64) if unlike >> p & 1]
        if len(places) > 3 * (bits + 2):
            out = []
            for mask in _choices(places, bits + 2, 2):
                key = fp & np.uint64(mask)
                order = np.argsort(key, kind="stable")
                key, here = key[order], fp[order]
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                sizes = np.diff(np.append(starts, len(key)))
                small = np.repeat(sizes <= FEW, sizes)
                for lag in range(1, int(sizes[sizes <= FEW].max(initial=1))):
                    i = np.flatnonzero((key[lag:] == key[:-lag]) & small[lag:] & (np.bitwise_count(here[lag:] ^ here[:-lag]) <= bits))
                    out += zip(order[i].tolist(), order[i + lag].tolist(), strict=True)
                for s, n in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
                    group = order[s : s + n]  # fewer than all, as these bits aren't alike in all
                    out += [(group[i], group[j]) for i, j in _links(fp[group], bits)]
            return out
    left, out = np.arange(len(fp)), []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.bitwise_count(fp[left] ^ fp[i]) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                out += [(i, j) for j in found]
                front += found.tolist()
    return out


def near_links(fps: DataFrame, bits: int = BITS, per_key: int = PER_KEY) -> DataFrame:
    """Links (a, b) between nodes of fps (node, fp), fp unique, that connect all pairs within bits."""
    masks = block_masks(fps.count(), bits, per_key)
    keyed = fps.select("node", "fp", F.explode(F.array(*(F.struct(F.lit(c).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for c, m in enumerate(masks)))).alias("k"))
    keyed = keyed.select("k.choice", "k.key", "node", "fp")
    # A key of a great share of all goes on in keys that have two more blocks of the other bits in common.
    total = fps.count()
    if total > SAMPLE:
        some = keyed.join(fps.sample(False, SAMPLE / total, SEED).select("fp"), "fp", "left_semi")
        hot = some.groupBy("choice", "key").count().where(F.col("count") > HOT * SAMPLE).select(F.col("choice").alias("c"), F.col("key").alias("k"))
        hot = F.broadcast(written(hot.limit(int(len(masks) / HOT)), "simhash-hot"))  # at most so many can be

        def deeper(c: int, mask: int) -> Column:
            more = _choices([p for p in range(64) if not mask >> p & 1], bits + 2, 2)
            return F.array(*(F.struct(F.lit(100 * (i + 1) + c).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(mask | m))).alias("key")) for i, m in enumerate(more)))

        parts = F.array(F.struct("choice", "key"))
        for c, mask in enumerate(masks):
            parts = F.when(F.col("c") == c, deeper(c, mask)).otherwise(parts)
        keyed = keyed.join(hot, (F.col("choice") == F.col("c")) & (F.col("key") == F.col("k")), "left").select("node", "fp", F.explode(parts).alias("x")).select("x.choice", "x.key", "node", "fp")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def met(choice, key, node, fp):
            new = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], new])
            sizes = np.diff(np.append(starts, len(key)))
            a, b = [], []
            group = np.repeat(np.arange(len(starts)), sizes)
            small = sizes[group] <= SMALL
            for lag in range(1, SMALL):
                i = np.flatnonzero((group[lag:] == group[:-lag]) & small[lag:])
                i = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= bits]
                a.append(node[i])
                b.append(node[i + lag])
            for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
                if links := _links(fp[s : s + n], bits):
                    i, j = np.array(links).T
                    a.append(node[s + i])
                    b.append(node[s + j])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        for batch in batches:
            got = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            got[3] = got[3].view(np.uint64) if len(got[3]) else got[3].astype(np.uint64)
            if not len(got[0]):
                continue
            # The last key of a batch may go on in the next one.
            last = np.flatnonzero((got[0] != got[0][-1]) | (got[1] != got[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                held.append(tuple(x[:cut] for x in got))
                yield met(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append(tuple(x[cut:] for x in got))
        if held:
            yield met(*(np.concatenate(x) for x in zip(*held, strict=True)))

    kind = fps.schema["node"].dataType.simpleString()
    return keyed.repartition("choice", "key").sortWithinPartitions("choice", "key", "fp").mapInArrow(each, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp, component_id) for every row: the smallest id reachable over links of near fingerprints.

    A null or blank text has fingerprint 0 and is linked like any other. Repeated rows share a component.
    A row whose id is null links others like any row; where all ids reachable are null, component_id is null.
    Other columns are ignored; an empty table gives an empty result.
    """
    found, of = _components(docs, id_col, text_col, bits, shingle)
    return found.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, bits: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp, ROW) of all rows, and (fp, component, component_id)."""
    found = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    nodes = written(found.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    labels = connected_components(near_links(nodes.select(F.col("fp").alias("node"), "fp"), bits))
    of = written(nodes.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-labels")
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    return found, written(of.join(least, "component").select("fp", "component", "component_id"), "simhash-components")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row of docs for each component, one of the smallest id, a hash deciding between its texts; rows with a null id stay.

    Null and blank texts are one component; columns of any names come along; an empty table gives an empty result.
    """
    found, of = _components(docs, id_col, text_col, bits, shingle)
    found = found.where("id is not null")
    firsts = found.join(of, "fp").groupBy("component").agg(F.min(F.struct("id", *ROW)).alias("x")).select(*(f"x.{c}" for c in ROW))
    return keep_firsts(docs, found, firsts, id_col, text_col)
