"""Interaction audit of filters: what each of them removes in every order in which they can be applied.

A document's failures are a set of filters. In an order, a step is an edge of the lattice of subsets: the filters
that are already applied, and the next one. All 120 orders of five filters take their 600 steps from 80 edges. Documents
are counted by failure set first, each set then adds to the 80 edges, and the steps are looked up among the edges' sums:
nothing is done once an order.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#$%&*|"
_SPACE = re.compile(rb"[ \t-\r]")
#: Bytes of a text that are split into words at once; bounds what a very long text takes beside its distinct words.
PIECE = 1 << 20


class Counts:
    """What the filters ask of a text (UTF-8), worked out once."""

    def __init__(self, text: bytes, chars: int):
        self.text, self.chars, self.n_words = text, chars, 0
        self.distinct: set[bytes] = set()
        at = 0
        while at < len(text):
            cut = _SPACE.search(text, at + PIECE)
            end = cut.start() if cut else len(text)
            words = text[at:end].split()  # of bytes: at the six ASCII spaces only
            self.n_words += len(words)
            self.distinct.update(words)
            at = end

    @property
    def n_upper(self) -> int:
        return len(self.text) - len(self.text.translate(None, _UPPER))


@dataclass(frozen=True)
class Filter:
    """A named filter; fails says whether a text fails it. Without fails, a text fails that some smaller id has, too."""

    name: str
    fails: Callable[[Counts], bool] | None


FILTERS = (
    Filter("A", lambda c: c.n_words < 100),
    Filter("B", lambda c: 100 * len(c.distinct) < 80 * c.n_words),
    Filter("C", lambda c: 100 * c.n_upper > 10 * c.chars),
    Filter("D", lambda c: any(m in c.text for m in _MARKS)),
    Filter("E", None),
)


def failures(docs: DataFrame, filters: tuple[Filter, ...] = FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask, n): rows of docs by id, part and failed filters (bit k for the k-th), n of them each.

    A null text is empty, and a null part too. For a filter on copies, texts are told apart by 128-bit hashes; a
    row fails if a smaller id has its text. A null id is neither smaller nor larger than others; rows of one id are no copies
    of each other. Repeated rows count each. Rows are met by text and id, so no group of copies lies in one task.
    """
    one = docs.select(docs[id_col].alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    tests = [(k, f.fails) for k, f in enumerate(filters) if f.fails]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, hashes = [], []
            for text, chars in zip(pc.cast(b.column("text"), pa.large_binary()), pc.utf8_length(b.column("text")).to_pylist(), strict=True):
                raw = text.as_py()
                counts = Counts(raw, chars)
                masks.append(sum(1 << k for k, fails in tests if fails(counts)))
                hashes.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("part"), pa.array(masks, pa.int32()), pa.array(hashes, pa.binary())], ["id", "part", "mask", "hash"])

    kind = f"id {one.schema['id'].dataType.simpleString()}, part string, mask int, hash binary"
    rows = one.mapInArrow(each, kind).groupBy("hash", "id", "part", "mask").agg(F.count("*").alias("n"))
    copies = [k for k, f in enumerate(filters) if not f.fails]
    if copies:
        rows = written(rows, "audit-rows")
        first = rows.groupBy("hash").agg(F.min("id").alias("id")).where("id is not null").withColumn("first", F.lit(True))
        again = F.when(F.col("id").isNotNull() & F.col("first").isNull(), sum(1 << k for k in copies)).otherwise(0)
        rows = rows.join(first, ["hash", "id"], "left").withColumn("mask", F.col("mask") + again)
    return rows.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))


def failure_sets(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: str = "quality = 1", toxic: str = "toxic = 1") -> DataFrame:
    """(part, mask, n, n_good, n_toxic) of failures. An id is good or toxic if any of its labels says so; a null id has none."""
    said = labels.select(labels[id_col].alias("id"), F.coalesce(F.expr(good), F.lit(False)).cast("int").alias("good"), F.coalesce(F.expr(toxic), F.lit(False)).cast("int").alias("toxic"))
    said = said.where("id is not null and good + toxic > 0").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    failed = written(failed, "audit-failed")
    zero = F.lit(0).cast("long")
    every = failed.groupBy("part", "mask").agg(F.sum("n").alias("n")).select("part", "mask", "n", zero.alias("n_good"), zero.alias("n_toxic"))
    known = failed.join(said, "id").groupBy("part", "mask").agg(F.sum(F.col("n") * F.col("good")).alias("n_good"), F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"))
    both = every.unionByName(known.withColumn("n", zero))
    return both.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "n_good", "n_toxic")))


def edges(sets: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """Sums of each part by edge (applied: a subset's bits; next: the filter that follows), shapley included.

    A removal's weight is the number of orders in which its edge lies: those of the filters before, times those
    of the filters after.
    """
    all_of = F.expr(f"flatten(transform(sequence(0, {(1 << filters) - 1}), s -> transform(sequence(0, {filters - 1}), f -> struct(s AS applied, f AS next))))")
    open_ = F.filter(all_of, lambda e: F.getbit(e["applied"], e["next"]) == 0)
    each = sets.withColumn("edge", F.explode(open_)).select("*", "edge.*")
    bit = F.call_function("shiftleft", F.lit(1), F.col("next"))
    fails, before = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(F.col("applied")) != 0
    removed = fails & ~before

    def total(condition: Column, of: str, name: str) -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long").alias(name)

    summed = each.groupBy("part", "applied", "next").agg(
        total(~fails & ~before, "n", "kept"),
        total(removed, "n", "removed"),
        total(fails & before, "n", "redundant"),
        total(F.col("mask") == bit, "n", "unique_fails"),
        total(removed, "n_good", "good_lost"),
        total(removed, "n_toxic", "toxic_lost"),
    )
    k = F.bit_count("applied")
    orders = F.element_at(F.array(*(F.lit(math.factorial(i) * math.factorial(filters - 1 - i)) for i in range(filters))), k + 1)
    return summed.withColumn("shapley", F.sum(F.col("removed") * orders).over(W.partitionBy("part", "next")))


def audit(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """A row for each part, order of the filters and step, with the edge's sums; zeros included.

    See failures for nulls, repeated rows and copies. An empty table has no parts, so no rows. Labels of unknown ids
    count nowhere; other columns are ignored, whatever their names.
    """
    found = edges(failure_sets(failures(docs, filters, id_col, text_col, part_col), labels, id_col), len(filters))
    steps = [
        ("".join(filters[f].name for f in order), step + 1, sum(1 << f for f in order[:step]), order[step])
        for order in itertools.permutations(range(len(filters)))
        for step in range(len(filters))
    ]
    paths = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, applied int, next int")
    sums = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return found.join(F.broadcast(paths), ["applied", "next"]).select("part", "filter_order", "step", *sums)  # as many rows as orders have steps
