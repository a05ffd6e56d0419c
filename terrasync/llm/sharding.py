"""Sharding by extendible hashing: a directory over hash-prefix bits.

A bucket is a prefix of a document's hash. It splits on the next bit only while its bytes exceed the limit
and it holds more than one document. The bytes are first summed up by a prefix long enough for the table's
size (a partial aggregation), and the splits are read off those sums; only what is still too large is
summed up again by longer prefixes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

LIMIT_BYTES = 1 << 20
#: Bits of the hash, and bits beyond the least number that are summed up at once.
HASH_BITS, SPARE_BITS = 60, 4


def hash_of(key: Column) -> Column:
    """The first 60 bits of the key's MD5; a null key hashes as the word null."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, HASH_BITS // 4), 16, 10).cast("long")


def directory(sizes: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Leaves (depth, prefix, bytes, docs) of sizes (hash, bytes)."""
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    top, leaves = 0, None
    open_rows = sizes
    while True:
        depth = min(HASH_BITS, top + max(1, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
        cells = open_rows.groupBy(F.shiftright("hash", HASH_BITS - depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        cells = written(cells, "shard-cells")
        # A bucket of each depth from top to depth, with what it holds.
        levels = F.explode(F.sequence(F.lit(top), F.lit(depth))).alias("depth")
        sums = cells.select("*", levels).groupBy("depth", F.expr(f"shiftright(cell, {depth} - depth)").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        sums = written(sums, "shard-sums")
        small = (F.col("bytes") <= limit) | (F.col("docs") == 1) | (F.col("depth") == HASH_BITS)
        splits = sums.where(~small).select((F.col("depth") + 1).alias("d"), F.col("prefix").alias("p"))
        parent = F.shiftright("prefix", 1)
        fits = sums.where(small)
        # A leaf is a small bucket whose parent was split; small ones below a leaf have a small parent.
        found = fits.join(splits, (F.col("depth") == F.col("d")) & (parent == F.col("p")), "left_semi")
        if top == 0:
            found = found.unionByName(fits.where("depth = 0"))
        found = written(found, "shard-leaves")
        leaves = found if leaves is None else leaves.unionByName(found)
        large = written(sums.where(~small & (F.col("depth") == depth)).select("prefix"), "shard-large")
        if large.isEmpty():
            return leaves
        open_rows = open_rows.join(large, F.shiftright("hash", HASH_BITS - depth) == F.col("prefix"), "left_semi")
        top, total = depth, 0


def shard_documents(docs: DataFrame, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, shard, depth, page, shard_bytes) for every row.

    shard is the bucket's hash prefix in binary digits. A shard holds limit bytes at most, unless it is a
    single larger document. Rows whose ids agree have one hash and can't be split apart: where they exceed
    the limit they go on overflow pages of it, numbered from 0 and filled within one partition of the input
    each; page is 0 elsewhere. Null texts have no bytes; null ids share a hash; other columns are ignored; an
    empty table gives an empty result.
    """
    sizes = docs.select(docs[id_col].alias("id"), F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long").alias("n_bytes"))
    rows = written(sizes.withColumns({"hash": hash_of(F.col("id")), "part": F.spark_partition_id()}), "shard-rows")
    leaves = written(directory(rows.select("hash", F.col("n_bytes").alias("bytes")), limit), "shard-directory")
    # Leaves tile the hashes, so a row's leaf is the one with its prefix at one of the depths in use.
    depths = [r.depth for r in leaves.select("depth").distinct().collect()]  # HASH_BITS + 1 at most
    keys = F.array(*(F.struct(F.lit(d).alias("d"), F.shiftright("hash", HASH_BITS - d).alias("p")) for d in depths)) if depths else F.array().cast("array<struct<d:int,p:bigint>>")
    met = rows.withColumn("k", F.explode(keys)).join(leaves, (F.col("k.d") == F.col("depth")) & (F.col("k.p") == F.col("prefix")))
    digits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(conv(prefix, 10, 2), depth, '0')"))
    full = (F.col("depth") == HASH_BITS) & (F.col("bytes") > limit) & (F.col("docs") > 1)
    plain = met.where(~full).select("id", "n_bytes", digits.alias("shard"), "depth", F.lit(0).cast("long").alias("page"), F.col("bytes").alias("shard_bytes"))
    # Rows of one id: so many to a page that the largest of them would fit. They are numbered by partition of
    # the input, as they may be a great part of it, and only the partitions' numbers of pages are summed up.
    over = written(met.where(full).select("id", "n_bytes", digits.alias("shard"), "depth", "prefix", "part"), "shard-over")
    fit = over.groupBy("prefix").agg(F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.max("n_bytes")))).alias("per"))
    parts = over.groupBy("prefix", "part").agg(F.count("*").alias("n")).join(fit, "prefix").withColumn("pages", F.ceil(F.col("n") / F.col("per")))
    earlier = W.partitionBy("prefix").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.select("prefix", "part", "per", F.coalesce(F.sum("pages").over(earlier), F.lit(0)).alias("base"))
    nth = F.row_number().over(W.partitionBy("prefix", "part").orderBy("n_bytes")) - 1
    numbered = over.withColumn("nth", nth).join(bases, ["prefix", "part"]).withColumn("page", (F.col("base") + F.floor(F.col("nth") / F.col("per"))).cast("long"))
    paged = numbered.withColumn("shard_bytes", F.sum("n_bytes").over(W.partitionBy("prefix", "page"))).select("id", "n_bytes", "shard", "depth", "page", "shard_bytes")
    return plain.unionByName(paged).select(F.col("id").alias(id_col), "n_bytes", "shard", "depth", "page", "shard_bytes")


def _numbered(rows: DataFrame) -> DataFrame:
    """rows (__key, __bytes, __row) with __number, from 0 within equal key and bytes.

    __row grows within a partition of the input and has its number in the upper bits, so that rows are numbered
    by partition and only the partitions' counts are summed up.
    """
    group = ["__key", "__bytes", "__part"]
    rows = rows.withColumn("__part", F.shiftright("__row", 33))
    earlier = W.partitionBy("__key", "__bytes").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    bases = rows.groupBy(*group).agg(F.count("*").alias("n")).select(*group, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__base"))
    nth = F.row_number().over(W.partitionBy(*group).orderBy("__row")) - 1
    return rows.withColumn("__nth", nth).join(bases, group).withColumn("__number", F.col("__base") + F.col("__nth")).drop("__part", "__base", "__nth")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes docs under path, a folder shard=.../page=... for each shard, every row once.

    Rows of one id (null is one) share a shard. Where these fill more than a page of it, rows and pages meet by
    number among the rows of that id and size. Columns of docs named shard or page give way to the folders';
    an empty table writes no folder.
    """
    # A struct is equal to another where both hold null.
    rows = docs.withColumns({"__key": F.struct(docs[id_col]), "__bytes": F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long")}).drop("shard", "page")
    placed = shard_documents(docs, limit, id_col, text_col).select(F.struct(id_col).alias("__key"), F.col("n_bytes").alias("__bytes"), "shard", "page")
    placed = written(placed.withColumn("__row", F.monotonically_increasing_id()), "shard-placed")
    several = written(placed.where("page > 0").select("__key").distinct(), "shard-several")
    one = placed.join(several, "__key", "left_anti").select("__key", "shard", "page").distinct()
    met = rows.join(one, "__key").drop("__key", "__bytes")
    if not several.isEmpty():
        many = written(rows.withColumn("__row", F.monotonically_increasing_id()).join(several, "__key", "left_semi"), "shard-many")
        places = _numbered(placed.join(several, "__key", "left_semi")).drop("__row")
        number = ["__key", "__bytes", "__number"]
        met = met.unionByName(_numbered(many).join(places, number).drop(*number, "__row"))
    met.withColumn("shard", F.concat(F.lit("s"), "shard")).repartition("shard", "page").write.partitionBy("shard", "page").parquet(path)
