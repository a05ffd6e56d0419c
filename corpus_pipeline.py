"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, packing, each a Spark job.

Every stage reads the table its predecessor wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrasync.llm import minhash, mixing, packing, quality, secret_scan
from terrasync.llm.common import table, written

#: Not expressible in SQL: XXH64 fingerprints, byte-pair tokens.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects. A null or blank text has no words and goes; repeated rows are each judged."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, a similarity of 0.8), the one of the smallest id.

    SimHash fingerprints meet by pigeonhole blocks as in op9, and what they link is verified exactly. Most pairs at 0.8 differ
    in more bits than blocks can serve, so MinHash bands add pairs, verified alike (README).
    Rows without an id stay; rows of one id are judged apart; ties between texts of one id go by a hash.
    """
    return minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by marks; null texts stay null, n_chars follows the text."""
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to two times. Null sources are a source; rows without words go."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids: the packed corpus itself. Repeated rows are documents of their own.

    Any stage gives an empty table for an empty one, and takes columns of any further names along but for this one.
    """
    return packing.pack(docs, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secrets", secrets), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
