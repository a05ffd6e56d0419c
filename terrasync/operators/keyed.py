"""Keyed writes as joins: upserts, deletes and checks of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str, *newest_first: Column) -> DataFrame:
    """One row for each key, the newest; ties are settled by a hash of the whole row, so reruns agree. Rows without a key are of one key.

    An aggregate, so that a task sends on one row for each key: versions of one key don't meet in one task.
    """
    order = F.struct(*newest_first, F.bitwise_not(F.xxhash64(*rows.columns)))
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("__row")).select("__row.*")


def upsert(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """target with delta's rows in place of those with their keys, and the new ones added.

    Keys of delta are unique (see latest). Columns that delta doesn't have keep their values in changed
    rows and are null in new ones. Only the delta's keys are shuffled against the target where they are
    few enough for Spark to send them round.
    """
    kept = [c for c in target.columns if c not in delta.columns]
    types = {f.name: f.dataType for f in target.schema}
    new = delta.select(*(F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in delta.columns))
    if kept:
        new = new.join(target.select(key, *kept), key, "left")
    return target.join(delta.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def without(target: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """target without the rows whose key, as normal text, is in gone (nid)."""
    from ..functions.ids import normal

    rows = target.withColumn("__nid", normal(target, key))
    return rows.join(gone.select(F.col("nid").alias("__nid")), "__nid", "left_anti").drop("__nid")


def orphans(target: DataFrame, source_ids: DataFrame, key: str) -> DataFrame:
    """Rows of target whose key the source no longer has; source_ids has the column nid."""
    from ..functions.ids import normal

    return target.withColumn("nid", normal(target, key)).join(source_ids.select("nid"), "nid", "left_anti")


#: Buckets by which sets of ids are compared; as many numbers at most go to the driver.
DIGESTS = 4096


def _digest_bucket(nid: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(nid, F.lit("")), F.lit("digest")), F.lit(buckets)).cast("int")


def differing(there: DataFrame, *more_or_less: tuple[DataFrame, int], buckets: int = DIGESTS) -> set[int]:
    """Buckets in which ids (nid) don't add up: there, and further ids with their signs, leave something.

    A digest of a set of ids is their number and the sums of two 64-bit hashes, taken in halves, so that they add up exactly. Digests are
    partial sums before the shuffle: no id is shuffled.
    """
    n, a, b = F.col("nid"), F.xxhash64("nid"), F.xxhash64(F.lit("digest"), "nid")
    halves = [F.lit(1).cast("long"), *(part for h in (a, b) for part in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))))]
    names = [f"s{i}" for i in range(len(halves))]
    every = None
    for ids, sign in ((there, 1), *more_or_less):
        rows = ids.select(_digest_bucket(n, buckets).alias("bucket"), *((h * sign).alias(c) for h, c in zip(halves, names, strict=True)))
        every = rows if every is None else every.unionByName(rows)
    summed = every.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names))
    return {r.bucket for r in summed.where(" or ".join(f"{c} <> 0" for c in names)).select("bucket").collect()}


def in_buckets(ids: DataFrame, found: set[int], buckets: int = DIGESTS) -> DataFrame:
    """The ids (nid) of those buckets."""
    return ids.where(_digest_bucket(F.col("nid"), buckets).isin(sorted(found)))


def orphan_ids(target: DataFrame, source: DataFrame, expected: DataFrame, fresh: DataFrame | None = None, buckets: int = DIGESTS) -> DataFrame:
    """Ids (nid) of target that source doesn't have, all given as ids.

    expected are those of source that target should have, but for fresh ones, which come in this run. Ids are compared one by one only in
    buckets where target's aren't the expected ones, so without orphans nothing is shuffled but sums.
    """
    found = differing(target, (expected, -1), *([(fresh, 1)] if fresh is not None else []), buckets=buckets)
    if not found:
        return target.limit(0)
    return in_buckets(target, found, buckets).join(in_buckets(source, found, buckets), "nid", "left_anti")


def held(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of target whose key, as normal text (nid), is among ids (nid)."""
    from ..functions.ids import normal

    return target.withColumn("nid", normal(target, key)).join(ids.select("nid"), "nid", "left_semi")


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def dangling(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child that name a parent which isn't there."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
