"""Near-duplicates by exact Jaccard similarity of word shingles, met through SimHash blocks and MinHash bands.

Two texts are near if they share at least SIMILAR of the word shingles that either has. A text's set of
shingle hashes is its node, so texts of equal sets are one from the start. Fingerprints of the same shingles meet by
pigeonhole blocks as in simhash.py; its links within 4 bits are pairs, and so are nodes of one fingerprint. Most pairs
of a similarity of 0.8 differ in more bits than blocks can serve, so others meet beside them. BANDS keys, each of ROWS minimal
hashes, bring nodes together: a pair of similarity s shares a key with probability 1 - (1 - s^ROWS)^BANDS,
at 0.8 all but 7 in 100,000. Pairs that meet are then verified on the texts themselves:

1. In a key with up to SMALL nodes all pairs; in a larger one each node with a center and its neighbours, so
   a large group of near copies gives a few pairs for each node. Keys of a great share of all nodes are dealt
   in parts, whose centers meet once more. Rows stream through: a task holds a few nodes of a key.
2. Nodes of larger keys whose members are still in unlike components meet by the shingles in their prefixes,
   an exact filter: with shingles in one order, rare ones first, near sets share one that stands so early in
   both that what follows it can still be the common part asked for. Own words of a copy are rare and fill its
   prefix, so copies that have drifted apart don't meet. No near pair that shares a key is passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from .common import ROW, keep_firsts, row_hashes, written
from .components import connected_components
from .simhash import fingerprint_of, near_links, shingle_hashes

SHINGLE, SEED = 5, 42
#: The least similarity of near copies, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 24, 5
#: Up to so many nodes of a key are compared pair by pair at once.
SMALL = 16
#: Nodes sampled for keys of a great share of all nodes, and the share from which a key is dealt in parts.
SAMPLE, HOT = 4096, 0.01
#: Parts in which such a key is dealt; pairs of one node that are verified together on average.
SALTS, TOGETHER = 64, 64
#: Rows of a token's cell that meet others at once, and the ratio of sizes that a cell spans.
PART, FINE = 512, 1.01
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the text's distinct word shingles; a shorter text is one shingle."""
    return distinct(shingle_hashes(text, k))


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The set of shingle hashes; that of a text without words has one."""
    return np.unique(hashes) if len(hashes) else np.array([xxh64_intdigest(b"", SEED)], np.uint64)


def node_of(found: np.ndarray) -> int:
    return xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One signed key for each band."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(found), 1 << 12):
        mixed = (found[i : i + (1 << 12)] ^ _FACTORS[0]) * (_FACTORS[1] * np.uint64(2) + np.uint64(1))
        least = np.minimum(least, (mixed ^ mixed >> np.uint64(29)).min(axis=1))
    return np.array([xxh3_64_intdigest(x.tobytes()) for x in least.reshape(BANDS, ROWS)], np.uint64).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * SIMILAR[1] >= (len(a) + len(b) - both) * SIMILAR[0]


def _sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, the row's hashes, node, fp, n, keys) for every row, fp being its fingerprint and n the number of its shingles."""
    one = docs.select(docs[id_col].alias("id"), *(c.alias(n) for n, c in row_hashes(docs, id_col, text_col).items()), docs[text_col].alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets, fps = [], np.zeros(len(b), np.uint64)
            for i, t in enumerate(b.column("text").to_pylist()):
                hashes = shingle_hashes(t, shingle)
                fps[i] = fingerprint_of(hashes)
                sets.append(distinct(hashes))
            keys = np.concatenate([band_keys(s) for s in sets]) if sets else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, BANDS), pa.int32()), pa.array(keys))
            columns = [*(b.column(i) for i in range(3)), pa.array(map(node_of, sets), pa.int64()), pa.array(fps.view(np.int64)), pa.array(map(len, sets), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", *ROW, "node", "fp", "n", "keys"])

    return one.mapInArrow(each, f"id {one.schema['id'].dataType.simpleString()}, {ROW[0]} bigint, {ROW[1]} bigint, node bigint, fp bigint, n bigint, keys array<bigint>")


def _by_fingerprint(found: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes by SimHash: each of a fingerprint with its least, and the least of linked fingerprints.

    Links connect what is within the bits, so a pair that the exact check refuses may have stood for others: those that are near share a band.
    """
    of = written(found.select("fp", "node").distinct(), "simhash-fps")
    least = written(of.groupBy("fp").agg(F.min("node").alias("least")), "simhash-nodes")
    same = of.join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    links = written(near_links(least.select(F.col("fp").alias("node"), "fp")).distinct(), "simhash-links")
    ends = [least.select(F.col("fp").alias(x), F.col("least").alias(f"node_{x}")) for x in "ab"]
    near = links.join(ends[0], "a").join(ends[1], "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return same.union(near).where("a <> b")


class _Key:
    """One (band, key, part) as its nodes come by, in order of size."""

    def __init__(self, name: tuple[int, int, int], large: bool):
        self.name, self.large = name, large
        self.node, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # all nodes so far, or the last two
        self.center: tuple[int, int] | None = None

    def add(self, node: np.ndarray, n: np.ndarray, out: list[tuple]) -> None:
        if not self.large:
            node, n = np.concatenate([self.node, node]), np.concatenate([self.n, n])
            if len(node) <= SMALL:
                self.node, self.n = node, n
                return
            self.large, self.node, self.n = True, node[:0], n[:0]
        out.append((*self.name[:2], node, None, n, False))
        at = 0
        while at < len(node):
            if self.center is None:
                self.center = int(node[at]), int(n[at])
                out.append((*self.name[:2], node[at : at + 1], None, n[at : at + 1], True))
                at += 1
            to = int(np.searchsorted(n, _reach(self.center[1]), "right"))
            out.append((*self.name[:2], np.full(max(0, to - at), self.center[0]), node[at:to], None, False))
            at = max(at, to)
            if at < len(node):
                self.center = None
        both, sizes = np.concatenate([self.node, node]), np.concatenate([self.n, n])
        for lag in (1, 2):
            i = np.arange(max(lag, len(self.node)), len(both))
            i = i[sizes[i] <= _reach(sizes[i - lag])]
            out.append((*self.name[:2], both[i - lag], both[i], None, False))
        self.node, self.n = both[-2:], sizes[-2:]

    def end(self, out: list[tuple]) -> None:
        if not self.large and len(self.node) > 1:
            i, j = np.triu_indices(len(self.node), 1)
            near = self.n[j] <= _reach(self.n[i])
            out.append((*self.name[:2], self.node[i[near]], self.node[j[near]], None, False))


def _reach(n):
    """The largest size that can still be near."""
    return n * SIMILAR[1] // SIMILAR[0]


_MET = ["band", "key", "a", "b", "n", "center"]


def _meet(keyed: DataFrame) -> DataFrame:
    """Pairs (a, b) of (band, key, part, node, n); of larger keys, and of those dealt in parts, also the nodes
    (a, n; b null), and the centers once more (center true). part is -1 where a key isn't dealt in parts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Key | None = None
        for batch in batches:
            band, key, part, node, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(band):
                continue
            out: list[tuple] = []
            edges = np.flatnonzero((band[1:] != band[:-1]) | (key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            for a, e in zip([0, *edges.tolist()], [*edges.tolist(), len(band)], strict=True):
                name = int(band[a]), int(key[a]), int(part[a])
                if now is None or now.name != name:
                    if now:
                        now.end(out)
                    now = _Key(name, name[2] >= 0)
                now.add(node[a:e], n[a:e], out)
            yield from rows(out)
        if now:
            now.end(out := [])
            yield from rows(out)

    def rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out := [x for x in out if len(x[2])]:
            sizes = [len(x[2]) for x in out]
            band, key, member, center = (np.repeat([v(x) for x in out], sizes) for v in (lambda x: x[0], lambda x: x[1], lambda x: x[3] is None, lambda x: x[5]))
            a, last = np.concatenate([x[2] for x in out]), np.concatenate([x[4] if x[3] is None else x[3] for x in out])
            columns = [pa.array(band, pa.int16()), pa.array(key, pa.int64()), pa.array(a), pa.array(last, mask=member), pa.array(last, mask=~member), pa.array(center)]
            yield pa.RecordBatch.from_arrays(columns, _MET)

    dealt = keyed.repartition("band", "key", "part").sortWithinPartitions("band", "key", "part", "n", "node")
    return dealt.select("band", "key", "part", "node", "n").mapInArrow(each, "band smallint, key bigint, a bigint, b bigint, n bigint, center boolean")


def _keyed(nodes: DataFrame) -> DataFrame:
    """(band, key, part, node, n): keys that more than HOT of about SAMPLE nodes have are dealt in parts.

    There are at most BANDS / HOT such keys. They decide how rows are dealt out, never a result.
    """
    keyed = nodes.select(F.posexplode("keys").alias("band", "key"), "node", "n").select(F.col("band").cast("short"), "key", "node", "n")
    share = min(1.0, SAMPLE / max(1, nodes.count()))
    some = nodes.sample(False, share, SEED).select(F.posexplode("keys").alias("band", "key"))
    hot = some.groupBy("band", "key").count().where(F.col("count") > HOT * SAMPLE).select(F.col("band").cast("short").alias("hot_band"), F.col("key").alias("hot_key"))
    hot = F.broadcast(written(hot.limit(int(BANDS / HOT)), "minhash-hot"))
    part = F.when(F.col("hot_key").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return keyed.join(hot, (F.col("band") == F.col("hot_band")) & (F.col("key") == F.col("hot_key")), "left").select("band", "key", part.alias("part"), "node", "n")


def _prefixes(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, token, at) of texts (node, z): the shingles in each node's prefix, at being their places.

    Shingles are ordered by the number of nodes that have them, then by hash. Those of one node only come
    first of all and aren't listed.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            sets = [shingles(expand(z.as_py()).decode(), shingle) for z in b.column("z")]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("node"), lists], ["node", "tokens"])

    tokens = written(texts.select("node", "z").mapInArrow(each, "node bigint, tokens array<bigint>"), "minhash-tokens")
    tokens = tokens.select("node", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("nodes")).where("nodes > 1")
    listed = tokens.join(counts, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("nodes", "token"))).alias("tokens"))
    # A near set of the smallest size possible shares SIMILAR of the n at least, so the last places don't count.
    last = F.col("n") - F.ceil(F.col("n") * SIMILAR[0] / SIMILAR[1])
    return listed.select("node", "n", (F.col("n") - F.size("tokens")).alias("own"), last.alias("last"), F.posexplode("tokens").alias("k", "t")).select(
        "node", "n", F.col("t.token").alias("token"), (F.col("own") + F.col("k")).alias("at")
    ).where(F.col("own") + F.col("k") <= F.col("last"))


def _across(found: DataFrame) -> DataFrame:
    """Pairs (a, b) of unlike components that can be near, from prefixes (node, n, token, at, component).

    A set of size n with a token at place `at` can only be near sets of at most `cap`: what follows the token in
    both must still hold the common part asked for. So a and b of a token can be near only if n_b <= cap_a and
    n_a <= cap_b. Rows are first counted by cells of about equal n and cap; rows meet only if their cells can hold
    such a pair, each cell in parts of about PART rows. Pages of one template whose common shingles stand late in
    all prefixes are never joined. No pair is lost: cells are compared by their least n and greatest cap.
    """
    per = found.groupBy("token", "component").agg(F.count("*").alias("members")).groupBy("token").agg(F.max_by("component", F.struct("members", "component")).alias("main"), F.count("*").alias("unlike"))
    cap = F.least(F.floor((F.col("n") - F.col("at")) * (SIMILAR[0] + SIMILAR[1]) / SIMILAR[0]) - F.col("n"), F.floor(F.col("n") * SIMILAR[1] / SIMILAR[0]))
    live = found.join(per.where("unlike > 1"), "token").withColumn("cap", cap).where(F.col("cap") * SIMILAR[1] >= F.col("n") * SIMILAR[0])
    fine = [F.floor(F.log(c) / math.log(FINE)).cast("int").alias(x) for c, x in ((F.col("n"), "by_n"), (F.col("cap"), "by_cap"))]
    live = written(live.select("token", "node", "n", "cap", "component", (F.col("component") == F.col("main")).alias("is_main"), *fine), "minhash-live")

    cell = ["is_main", "by_n", "by_cap"]
    cells = live.groupBy("token", *cell).agg(F.count("*").alias("rows"), F.min("n").alias("n"), F.max("cap").alias("cap"))

    def side(df: DataFrame, x: str) -> DataFrame:
        return df.toDF(*(c if c in ("token", "wide") else f"{c}_{x}" for c in df.columns))

    # Sizes of near sets differ by at most `reach` steps, so classes of that many steps are met with their neighbours only.
    reach = math.ceil(math.log(SIMILAR[1] / SIMILAR[0]) / math.log(FINE))
    wide = F.floor(F.col("by_n") / reach)
    ones = side(cells.where(~F.col("is_main")).withColumn("wide", wide), "a")
    others = side(cells.withColumn("wide", F.explode(F.array(wide - 1, wide, wide + 1))), "b")
    in_order = F.col("is_main_b") | (F.struct("by_n_a", "by_cap_a") <= F.struct("by_n_b", "by_cap_b"))
    open_ = ones.join(others, ["token", "wide"]).where(in_order & (F.col("n_b") <= F.col("cap_a")) & (F.col("n_a") <= F.col("cap_b")))
    parts = [F.ceil(F.col(f"rows_{x}") / PART).cast("int").alias(f"parts_{x}") for x in "ab"]
    ends = [f"{c}_{x}" for x in "ab" for c in cell]
    open_ = written(open_.select("token", *ends, *parts), "minhash-cells")

    def members(x: str, y: str) -> DataFrame:
        """Rows of one side, in their own part, for every part of the other."""
        mine = F.pmod(F.xxhash64(f"node_{x}"), F.col(f"parts_{x}")).cast("int").alias(f"part_{x}")
        every = F.explode(F.sequence(F.lit(0), F.col(f"parts_{y}") - 1)).alias(f"part_{y}")
        met = side(live, x).join(open_, ["token", *(f"{c}_{x}" for c in cell)])
        return met.select("token", *ends, mine, every, *(f"{c}_{x}" for c in ("node", "n", "cap", "component")))

    met = members("a", "b").join(members("b", "a"), ["token", *ends, "part_a", "part_b"])
    same_cell = ~F.col("is_main_b") & (F.col("by_n_a") == F.col("by_n_b")) & (F.col("by_cap_a") == F.col("by_cap_b"))
    near = (F.col("component_a") != F.col("component_b")) & (F.col("n_b") <= F.col("cap_a")) & (F.col("n_a") <= F.col("cap_b")) & (~same_cell | (F.col("node_a") < F.col("node_b")))
    return met.where(near).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, z): compressed texts of the nodes in wanted (node, least)."""
    one = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(wanted, F.col("id") == F.col("least")).select("node", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            # Rows of one id can have unlike texts.
            found = [(n, squeeze((t or "").encode())) for n, t in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True) if node_of(shingles(t, shingle)) == n]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([z for _, z in found], pa.binary())], ["node", "z"])

    return one.mapInArrow(each, "node bigint, z binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) whose texts are near. A node's pairs are dealt over tasks, TOGETHER to one on average."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / TOGETHER).alias("tasks")).where("tasks > 1").withColumnRenamed("a", "x")
    salt = F.pmod(F.xxhash64("b"), F.coalesce("tasks", F.lit(1))).alias("salt")
    salted = pairs.join(many, F.col("a") == F.col("x"), "left").select("a", "b", salt)
    firsts = salted.select("a", "salt").distinct().join(texts, F.col("a") == F.col("node")).select("a", "salt", F.lit(None).cast("long").alias("b"), "z")
    others = salted.join(texts, F.col("b") == F.col("node")).select("a", "salt", "b", "z")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        first = None
        for batch in batches:
            found = []
            for a, b, z in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("z"), strict=True):
                here = shingles(expand(z.as_py()).decode(), shingle)
                if b is None:
                    first = here
                elif similar(first, here):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], ["a", "b"])

    dealt = firsts.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "z").mapInArrow(each, "a bigint, b bigint")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of docs for each component of near texts, one of the smallest id; rows with a null id stay.

    Rows of one id and unlike texts are judged apart; of rows of one id in a component a hash decides. Texts
    without words, null or blank, are equal. Columns and their names don't matter; an empty table gives an
    empty result. Only rows that go and rows listed more than once are looked up by hash of id and text.
    """
    found = written(_sketches(docs, id_col, text_col, shingle), "minhash-sketches").where("id is not null")
    nodes = found.groupBy("node").agg(F.min(F.struct("id", *ROW)).alias("f"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    nodes = written(nodes.select("node", "f.*", F.col("f.id").alias("least"), "n", "keys").drop("id"), "minhash-nodes")
    met = written(_meet(_keyed(nodes)), "minhash-met")
    centers = met.where("center").select("band", "key", F.lit(-1).alias("part"), F.col("a").alias("node"), "n").distinct()
    more = written(_meet(centers), "minhash-centers")
    links = met.where("b is not null").select("a", "b").union(more.where("b is not null").select("a", "b")).union(_by_fingerprint(found))
    pairs = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-pairs")
    large = met.where("b is null and not center").select("band", "key", F.col("a").alias("node"), "n")
    some = pairs.select(F.col("a").alias("x")).union(pairs.select("b")).union(large.select("node")).distinct()
    texts = written(_texts(docs, nodes.select("node", "least").join(some, F.col("node") == F.col("x"), "left_semi"), id_col, text_col, shingle), "minhash-texts")
    links = written(_verified(pairs, texts, shingle), "minhash-links")
    labels = connected_components(links)
    if not large.isEmpty():
        members = large.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = members.groupBy("band", "key").agg((F.min("component") != F.max("component")).alias("mixed")).where("mixed").select("band", "key")
        open_ = written(members.join(mixed, ["band", "key"], "left_semi").select("node", "component").distinct(), "minhash-open")
        prefixes = written(_prefixes(texts.join(open_, "node", "left_semi"), shingle).join(open_, "node"), "minhash-prefixes")
        across = written(_across(prefixes).join(pairs, ["a", "b"], "left_anti"), "minhash-across")
        if not across.isEmpty():
            labels = connected_components(links.union(_verified(across, texts, shingle)))
    of = nodes.select("node", "least", *ROW).join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = of.groupBy("component").agg(F.min(F.struct("least", *ROW)).alias("x")).select("x.*").drop("least")
    return keep_firsts(docs, found, firsts, id_col, text_col)
