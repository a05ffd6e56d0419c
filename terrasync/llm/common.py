"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where none is set (local mode, tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='terrasync-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/terrasync-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the tables this application has written for itself; results that still read them can't be used after."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back, which cuts the lineage there.

    A lost executor costs nothing behind this point, and the table's real size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: 128 bits that stand for a row's id and text.
ROW = ["__row_a", "__row_b"]


def row_hashes(docs: DataFrame, id_col: str, text_col: str) -> dict[str, Column]:
    return {ROW[0]: F.xxhash64(docs[id_col], docs[text_col]), ROW[1]: F.xxhash64(F.lit(42), docs[text_col], docs[id_col])}


def renamed(docs: DataFrame) -> DataFrame:
    """docs with its columns named c0, c1, ...: whatever a caller calls them, they don't clash with names of our own."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def keep_firsts(docs: DataFrame, found: DataFrame, firsts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs but for those of found (ROW) that aren't in firsts (ROW), and of rows listed more than once one.

    Only rows that go and rows listed more than once are looked up, always by a shuffle, so that small tables
    take the way of large ones.
    """
    times = found.groupBy(*ROW).agg(F.count("*").alias("times"))
    judged = written(times.join(firsts.withColumn("first", F.lit(True)), ROW, "left").where("first is null or times > 1"), "keep-judged")
    names, rows = docs.columns, renamed(docs)
    rows = rows.withColumns(row_hashes(rows, rows.columns[names.index(id_col)], rows.columns[names.index(text_col)]))
    kept = rows.join(judged.select(*ROW).hint("merge"), ROW, "left_anti").drop(*ROW)
    again = judged.where("first")
    if not again.isEmpty():
        kept = kept.union(rows.join(again.select(*ROW), ROW, "left_semi").dropDuplicates(ROW).drop(*ROW))
    return kept.toDF(*names)
