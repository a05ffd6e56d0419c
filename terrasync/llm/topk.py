"""Exact top-k search by integer inner product, over buckets of vectors of like length.

Vectors are dealt into buckets by length (quantiles), long ones first. The longest bucket gives every
query a first threshold, its k-th best score there, and with it the least length a candidate needs. Queries
are dealt into blocks by that length, so a candidate is copied only to the blocks in which some query can still
take it, and a query goes only to buckets that can reach its threshold. Within a bucket, slices of falling length are worked off under
the running threshold: threshold / (query length * slice length) is the local cosine that a candidate
needs. Above 1 the slice is skipped; where the local cosine is high, the query's largest coordinate bounds
the candidates' one (coordinate pruning); otherwise only the slice's long enough head is taken (length
pruning). What is left is verified with exact products. Queries and buckets meet in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

K, SCALE, EVERY = 10, 1024, 100
#: Length buckets at most, and vectors in one on average at least; rows of a bucket's block and of a query block (some 30 MB of 64 dimensions, which
#: bounds a task's memory; larger ones copy each row to fewer blocks); candidates and queries multiplied at once.
BUCKETS, PER_BUCKET, BLOCK, QUERY_BLOCK, SLICE, AT_ONCE = 64, 64, 65536, 65536, 2048, 1024
#: Local cosine from which coordinate pruning is tried, and the share of a slice it must leave at most.
COSINE, LEAVES = 0.6, 0.25
_LONG = (1 << 63) - 1


def quantize(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v, norm): v the components floor(scale * x), as little-endian longs. Unusable vectors are left out.

    A component beyond the range of a long is held at its end. An empty vector has length 0.
    """
    one = vectors.select(vectors[id_col].alias("id"), vectors[vec_col].alias("v")).where("id is not null and v is not null")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out, norms = [], [], []
            for i, v in enumerate(b.column("v")):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
                if np.isfinite(x).all():
                    y = np.floor(scale * x)
                    wide = np.abs(y) >= 2.0**63
                    z = np.where(wide, 0, y).astype("<i8")
                    z[wide] = np.where(y[wide] > 0, _LONG, -_LONG)
                    keep.append(i)
                    out.append(z.tobytes())
                    norms.append(float(np.sqrt((z.astype(np.float64) ** 2).sum())))
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(keep, pa.int64())), pa.array(out, pa.binary()), pa.array(norms, pa.float64())], ["id", "v", "norm"])

    return one.mapInArrow(each, f"id {one.schema['id'].dataType.simpleString()}, v binary, norm double")


def _matrix(column, width: int) -> np.ndarray:
    """Rows of longs; short vectors are filled up with zeros."""
    rows = [np.frombuffer(x.as_py(), "<i8") for x in column]
    if all(len(r) == width for r in rows):
        return np.array(rows, np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _products(q: np.ndarray, c: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of rows; floats hold them exactly below 2**53, else whole numbers do, held to a long."""
    if exact:
        return q.astype(np.float64) @ c.astype(np.float64).T
    return np.clip(q.astype(object) @ c.astype(object).T, -_LONG, _LONG)


def search_block(qid, q, qnorm, floor, cid, c, cnorm, k: int) -> list[list[tuple[int, int]]]:
    """For each query its best (score, id) among the candidates that reach its floor, best first."""
    best: list[list[tuple[int, int]]] = [[] for _ in qid]
    theta = floor.astype(np.float64).copy()
    order = np.argsort(-cnorm, kind="stable")
    cid, c, cnorm = cid[order], c[order], cnorm[order]
    exact = float(qnorm.max(initial=0)) * float(cnorm.max(initial=0)) < 2.0**52
    slack = 1e-9

    def offer(i: int, scores: np.ndarray, ids: np.ndarray):
        ok = (scores >= theta[i]) & (ids != qid[i])
        if not ok.any():
            return
        scores, ids = scores[ok], ids[ok]
        if len(scores) > 4 * k:  # only what reaches the k-th score of this slice can count
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, ids = scores[scores >= cut], ids[scores >= cut]
        merged = best[i] + list(zip(map(int, scores), ids.tolist(), strict=True))
        merged.sort(key=lambda x: (-x[0], x[1]))
        best[i] = merged[:k]
        if len(best[i]) == k:
            theta[i] = max(theta[i], float(best[i][-1][0]) * (1 if exact else 1 - 1e-12) if best[i][-1][0] >= 0 else float(best[i][-1][0]) * (1 if exact else 1 + 1e-12))

    for s in range(0, len(cid), SLICE):
        ids, part, norms = cid[s : s + SLICE], c[s : s + SLICE], cnorm[s : s + SLICE]
        top = norms[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(theta > 0, theta / (qnorm * top), -np.inf)
        alive = ~(local > 1 + slack)
        rest = []
        by_coordinate: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in np.flatnonzero(alive):
            if exact and local[i] >= COSINE:
                unit = q[i] / qnorm[i]
                f = int(np.abs(unit).argmax())
                if f not in by_coordinate:
                    values = part[:, f] / np.where(norms > 0, norms, 1)
                    rank = np.argsort(values, kind="stable")
                    by_coordinate[f] = values[rank], rank
                values, rank = by_coordinate[f]
                # The candidate lies within an angle of the query, which itself lies at an angle to axis f.
                within, axis = np.arccos(min(1.0, local[i])), np.arccos(np.clip(unit[f], -1, 1))
                low = -1.0 if axis + within >= np.pi else np.cos(axis + within)
                high = 1.0 if within >= axis else np.cos(axis - within)
                a, b = np.searchsorted(values, [low - slack, high + slack])
                if b - a <= LEAVES * len(ids):
                    at = rank[a:b]
                    offer(i, _products(q[i : i + 1], part[at], True)[0], ids[at])
                    continue
            rest.append(i)
        if rest:
            rest = np.array(rest)
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(theta[rest] > 0, theta[rest] / qnorm[rest] * (1 - slack), 0)
            head = int((norms >= need.min()).sum())
            scores = _products(q[rest], part[:head], exact)
            for i, row in zip(rest, scores, strict=True):
                offer(i, row, ids[:head])
    return best


def _meet(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Each query block's k best of each candidate block: (query_id, vec_id, score)."""

    def each(cand: pa.Table, quer: pa.Table) -> pa.Table:
        width = max([0, *(len(x.as_py()) // 8 for t in (cand, quer) for x in t.column("v"))])
        got: list[tuple[int, int, int]] = []
        if cand.num_rows and quer.num_rows and width:
            cid, qid = (t.column("id").to_numpy() for t in (cand, quer))
            c, q = (_matrix(t.column("v"), width) for t in (cand, quer))
            cn, qn = (t.column("norm").to_numpy() for t in (cand, quer))
            floor = quer.column("floor").to_numpy()
            for a in range(0, len(qid), AT_ONCE):
                part = slice(a, a + AT_ONCE)
                for i, best in zip(qid[part], search_block(qid[part], q[part], qn[part], floor[part], cid, c, cn, k), strict=True):
                    got += [(int(i), vec, score) for score, vec in best]
        elif cand.num_rows and quer.num_rows:
            cid = sorted(cand.column("id").to_pylist())
            got = [(i, j, 0) for i in quer.column("id").to_pylist() for j in [x for x in cid[: k + 1] if x != i][:k]]
        columns = zip(*got, strict=True) if got else ([], [], [])
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in columns], ["query_id", "vec_id", "score"])

    keys = ("bucket", "block", "query_block")
    cand, quer = (t.toDF(*t.columns).groupBy(*keys) for t in (candidates, queries))
    return cand.cogroup(quer).applyInArrow(each, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(rows: DataFrame, number: str, most: int, into: str) -> tuple[DataFrame, dict[int, int]]:
    """rows with column into, their block within number, dealt by hash so that a block has most rows on average
    at most; and the blocks of each number. Numbers are few."""
    counts = {r[0]: r[1] for r in rows.groupBy(number).agg(F.count("*")).collect()}
    blocks = {x: max(1, -(-n // most)) for x, n in counts.items()}
    dealt = F.element_at(F.array(*(F.lit(blocks.get(x, 1)) for x in range(max(blocks, default=0) + 1))), F.col(number) + 1)
    return rows.withColumn(into, F.pmod(F.xxhash64("id", "v"), dealt).cast("int")), blocks


def _place(x: Column, bounds: list[float]) -> Column:
    """How many of the bounds x reaches."""
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= x)) if bounds else F.lit(0)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by every.

    Candidates are all rows with another id, repeated rows each by itself. Ties go to the smaller id; fewer
    rows than k are all given. Vectors that are null or hold a null or a non-finite component, and rows without
    an id, take no part. Of query rows with one id the one with the smallest components (as stored bytes) is
    the query. Vectors of unlike length are filled up with zeros. Scores are held to the range of a long.
    Other columns are ignored.
    """
    v = written(quantize(vectors, id_col, vec_col, scale), "topk-vectors")
    total = v.count()
    if not total:
        return v.select(F.col("id").cast("long").alias("query_id"), F.lit(1).alias("rank"), F.col("id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("score"))
    n_buckets = max(2, min(BUCKETS, total // PER_BUCKET))
    bounds = sorted(set(v.approxQuantile("norm", [i / n_buckets for i in range(1, n_buckets)], 0.002)))  # at most BUCKETS numbers
    # Buckets count from the longest vectors on.
    v = v.withColumn("bucket", (F.lit(len(bounds)) - _place(F.col("norm"), bounds)).cast("int"))
    tops = {r[0]: r[1] for r in v.groupBy("bucket").agg(F.max("norm")).collect()}  # at most BUCKETS rows
    v, blocks = _blocks(v, "bucket", BLOCK, "block")
    queries = v.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("v", "norm")).alias("x")).select("id", "x.v", "x.norm")
    queries = written(queries, "topk-queries")

    def to_blocks(q: DataFrame, which: list[int]) -> DataFrame:
        """Queries copied to the blocks of those buckets that can still reach their floor."""
        known = [F.struct(F.lit(b).alias("bucket"), F.lit(blocks[b]).alias("blocks"), F.lit(tops[b]).alias("top")) for b in which]
        reached = F.filter(F.array(*known), lambda x: F.col("norm") * x["top"] * (1 + 1e-9) >= F.col("floor"))
        met = q.withColumn("x", F.explode(reached)).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("x.blocks") - 1)))
        return met.select("x.bucket", "block", "query_block", "id", "v", "norm", "floor")

    def to_query_blocks(rows: DataFrame, known: list[tuple[int, float]]) -> DataFrame:
        """Candidates copied to the query blocks (number, least length needed there) that can take them."""
        of = F.filter(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(need).alias("need")) for i, need in known)), lambda x: F.col("norm") * (1 + 1e-9) >= x["need"])
        return rows.withColumn("x", F.explode(of)).select("bucket", "block", F.col("x.i").alias("query_block"), "id", "v", "norm")

    first = min(tops)
    opened, several = _blocks(queries.withColumns({"one": F.lit(0), "floor": F.lit(float("-inf"))}), "one", QUERY_BLOCK, "query_block")
    begun = _meet(to_query_blocks(v.where(F.col("bucket") == first), [(i, 0.0) for i in range(several.get(0, 0))]), to_blocks(opened, [first]), k) if several else None
    if begun is None:
        return v.select(F.col("id").cast("long").alias("query_id"), F.lit(1).alias("rank"), F.col("id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    begun = written(_best(begun, k), "topk-first")
    found = begun.drop("rank")
    if rest := [b for b in sorted(tops) if b != first]:
        floors = begun.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
        again = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        need = F.when((F.col("floor") > 0) & (F.col("norm") > 0), F.col("floor") / F.col("norm")).otherwise(0.0)
        again = written(again.withColumn("need", need), "topk-again")
        n_ranges = several[0]
        cuts = sorted(set(again.approxQuantile("need", [i / n_ranges for i in range(1, n_ranges)], 0.002))) if n_ranges > 1 else []
        again, parts = _blocks(again.withColumn("range", _place(F.col("need"), cuts)), "range", QUERY_BLOCK, "part")
        starts, known = {}, []
        least = {r[0]: r[1] for r in again.groupBy("range").agg(F.min("need")).collect()}
        for x in sorted(parts):
            starts[x] = len(known)
            known += [(len(known) + i, least[x]) for i in range(parts[x])]
        start = F.element_at(F.array(*(F.lit(starts.get(x, 0)) for x in range(max(starts) + 1))), F.col("range") + 1)
        again = again.withColumn("query_block", (start + F.col("part")).cast("int"))
        found = found.unionByName(_meet(to_query_blocks(v.where(F.col("bucket") != first), known), to_blocks(again, rest), k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
