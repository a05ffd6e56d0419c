"""Flags that a territory's files must be made anew, set from changes below it.

Flags are only ever set; whoever makes the files resets them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import utc

FLAG = "requires_s3_file_regeneration"


def flag(table: DataFrame, condition: Column) -> DataFrame:
    old = F.coalesce(F.col(FLAG), F.lit(False)) if FLAG in table.columns else F.lit(False)
    return table.withColumn(FLAG, F.coalesce(condition, F.lit(False)) | old)


def changed_since(mark: datetime | None, created: str = "created_at", updated: str = "updated_at") -> Column:
    """Rows made or changed later; without a mark, all."""
    if mark is None:
        return F.lit(True)
    at = F.lit(utc(mark))
    return (F.col(created) > at) | (F.col(updated) > at)


def flag_among(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Sets the flag of rows whose key is among ids (id). The ids are made distinct before the join."""
    found = ids.select(F.col("id").cast(table.schema[key].dataType).alias("__id")).where("__id is not null").distinct().withColumn("__hit", F.lit(True))
    met = table.join(found, table[key] == found["__id"], "left")
    return flag(met, F.col("__hit")).drop("__id", "__hit")


def level3_of_changed(areas: DataFrame, mark: datetime | None, parent: str = "territory_level_3_id") -> DataFrame:
    """Ids of the third-level territories that hold changed areas of interest."""
    return areas.where(changed_since(mark) & F.col(parent).isNotNull()).select(F.trim(F.col(parent).cast("string")).alias("id")).distinct()


def parents_of(level3: DataFrame, ids: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """Ids of the second-level territories above those third-level ones."""
    kind = level3.schema[key].dataType
    return level3.where(F.col(parent).isNotNull()).join(ids.select(F.col("id").cast(kind).alias(key)), key, "left_semi").select(F.col(parent).alias("id")).distinct()


def merged_ids(*ids: DataFrame) -> DataFrame:
    """Ids of several tables (id), as trimmed text, blanks left out, each once."""
    out = None
    for x in ids:
        one = x.select(F.trim(F.col("id").cast("string")).alias("id")).where("id is not null and id <> ''")
        out = one if out is None else out.unionByName(one)
    return out.distinct()
