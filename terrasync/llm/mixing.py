"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

A source's documents all get the same expected number of copies, target / size of the source, of which
the whole part is certain and the fraction is a probability. Documents with fractions are paired: mass
(probability times size) moves at random from one to the other until one of the two is 0 or 1, so both
keep their expectation and the words of the pair stay the same. What is left of a group is one document
with a fraction; these residuals meet in the next level of a reduction tree, whose groups are dealt by
hash, until a source has one, which is rounded to the nearer side. A source's words then differ from its
target by half of one document at most; LANDINGS times, the settled document whose size comes closest to
what is missing or too much changes sides, which leaves a small part of that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import renamed, word_count, written

#: Weights by a source's place among the sources, repeating; the share of all words to take; copies at most.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Documents that one group of the reduction tree holds on average.
GROUP = 32
SEED = 42
#: Documents of a source that may change sides at the end, one after the other.
LANDINGS = 2
#: Equal rows that are written out from one array.
AT_ONCE = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, n_rows, target: shares by weight, none above most times its source's size.

    Sources count by code point, null last. Where capped targets leave an excess, it goes to the others by
    weight until none is above its cap: with sources ordered by cap per weight, the first ones are capped,
    and one level (words per weight) holds for the rest. Runs over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    ranked = per.select("*", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double").alias("weight"))
    ranked = ranked.select("*", (F.col("source_size") * float(most)).alias("cap"))
    # before: caps of the sources that are capped earlier; rest: weights from this source on.
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(every) * float(share) - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(
        by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)
    )
    # The level is that of the first source which it doesn't cap.
    found = ranked.select("*", level.alias("level")).select("*", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")).alias("fits"))
    chosen = F.first("fits", ignorenulls=True).over(by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return found.select("*", chosen.alias("common")).select(
        "source", "source_size", "n_rows", F.least("cap", F.coalesce(F.col("common") * F.col("weight"), F.col("cap"))).alias("target")
    )


def _settle(group: Column, level: int) -> Column:
    """Pairs up a group's documents one after the other: settled (id, one) and the residual that is left."""
    kind = "struct<id:bigint,z:double,p:double>"
    empty = F.array().cast("array<struct<id:bigint,z:double,one:boolean>>")

    def pair(a: Column, x: Column) -> Column:
        i = a["rest"]
        u = F.pmod(F.xxhash64(i["id"], x["id"], F.lit(level), F.lit(SEED)), F.lit(1 << 53)) / F.lit(float(1 << 53))
        mi, mj = i["p"] * i["z"], x["p"] * x["z"]  # words in hand
        ri, rj = (1 - i["p"]) * i["z"], (1 - x["p"]) * x["z"]  # room for words
        up, down = F.least(ri, mj), F.least(mi, rj)
        gains = u * (up + down) < down  # i gains up words, or it loses down words

        def step(settled: Column, one: Column, rest: Column, p: Column) -> Column:
            return F.struct(
                F.concat(a["settled"], F.array(F.struct(settled["id"].alias("id"), settled["z"].alias("z"), one.alias("one")))).alias("settled"),
                F.struct(rest["id"].alias("id"), rest["z"].alias("z"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p")).alias("rest"),
            )

        yes, no = F.lit(True), F.lit(False)
        return (
            F.when(i.isNull(), F.struct(a["settled"].alias("settled"), x.alias("rest")))
            .when(gains & (ri <= mj), step(i, yes, x, x["p"] - ri / x["z"]))
            .when(gains, step(x, no, i, i["p"] + mj / i["z"]))
            .when(mi <= rj, step(i, no, x, x["p"] + mi / x["z"]))
            .otherwise(step(x, yes, i, i["p"] - rj / i["z"]))
        )

    return F.aggregate(group, F.struct(empty.alias("settled"), F.lit(None).cast(kind).alias("rest")), pair)


def dependent_rounding(nodes: DataFrame) -> DataFrame:
    """Rounds probabilities: nodes (source, id, z, p), id unique, 0 < p < 1, z > 0; returns (id, one).

    Within each source the sum of z over the ones is near that of p * z. Each level of the tree is a shuffle by (source, hash) of at most GROUP times fewer rows than the one before.
    """
    settled, level = None, 0
    rest = nodes.select("source", "id", "z", "p")
    while True:
        rest = written(rest, "mix-level")
        counts = written(rest.groupBy("source").agg(F.count("*").alias("n")), "mix-counts")
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        dealt = rest.join(counts.withColumnRenamed("source", "counted"), F.col("source").eqNullSafe(F.col("counted"))).select(
            "source", F.pmod(F.xxhash64("id", F.lit(level), F.lit(SEED)), F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP))).alias("deal"), F.struct(F.xxhash64("id", F.lit(SEED)).alias("h"), "id", "z", "p").alias("x")
        )
        done = dealt.groupBy("source", "deal").agg(F.sort_array(F.collect_list("x")).alias("xs"))
        done = done.select("source", _settle(F.transform("xs", lambda x: F.struct(x["id"].alias("id"), x["z"].alias("z"), x["p"].alias("p"))), level).alias("s"))
        done = written(done, "mix-settled")
        some = done.select("source", F.explode("s.settled").alias("x")).select("source", "x.*")
        settled = some if settled is None else settled.unionByName(some)
        rest = done.select("source", "s.rest.*")
        level += 1
    last = rest.select("source", "id", "z", (F.col("p") >= 0.5).alias("one"))
    if settled is None:
        return last.select("id", "one")
    off = rest.select(F.col("source").alias("s"), ((F.col("p") - (F.col("p") >= 0.5).cast("int")) * F.col("z")).alias("off"))  # words missing
    settled = settled.unionByName(last)
    for _ in range(LANDINGS):
        missing = F.abs("off") - F.col("z")
        fits = settled.join(off, F.col("source").eqNullSafe(F.col("s"))).where((F.col("one") == (F.col("off") < 0)) & (F.abs(missing) < F.abs("off")))
        best = fits.groupBy("s").agg(F.min(F.struct(F.abs(missing).alias("left"), "id", "z", "off")).alias("b"))
        best = written(best.select("s", F.col("b.id").alias("turned"), "b.off", F.signum("b.off").alias("way"), "b.z"), "mix-landing")
        settled = settled.join(best.select("turned"), F.col("id") == F.col("turned"), "left").select("source", "id", "z", F.when(F.col("turned").isNull(), F.col("one")).otherwise(~F.col("one")).alias("one"))
        off = best.select("s", (F.col("off") - F.col("way") * F.col("z")).alias("off"))
    return settled.select("id", "one")


def _decided(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """A row for each group of equal rows (doc_id, source, size, tag): adds key, m (their number), source_size, target and all_copies."""
    group = ("doc_id", "source", "size", "tag")
    grouped = written(rows.groupBy(*group).agg(F.count("*").alias("m")), "mix-rows")
    targets = written(source_targets(grouped.select("source", (F.col("size") * F.col("m")).alias("size")), weights, share, most), "mix-targets").withColumnRenamed("source", "s")
    share_of = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    joined = grouped.join(targets.drop("n_rows"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    joined = joined.withColumn("expected", F.when(F.col("size") > 0, share_of * F.col("m")).otherwise(0.0)).withColumn("sure", F.floor("expected")).withColumn("p", F.col("expected") - F.col("sure"))
    # The tree draws by what a row holds, not by where it lies, so that reruns agree.
    joined = joined.withColumn("key", F.xxhash64(*group))
    nodes = joined.where("p > 0").select("source", F.col("key").alias("id"), F.col("size").cast("double").alias("z"), "p")
    ones = dependent_rounding(nodes).where("one").select(F.col("id").alias("key")).distinct()
    ones = written(ones, "mix-ones").withColumn("one", F.lit(1))
    total = joined.join(ones, "key", "left").withColumn("all_copies", (F.col("sure") + F.coalesce("one", F.lit(0))).cast("long"))
    return total.select(*group, "key", "m", "source_size", "target", "all_copies")


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """rows (doc_id, source, size, and tag if they have it): adds source_size, target, copies and taken, one row for each row.

    tag tells rows of one id, source and size apart. Equal rows are settled together and share their copies
    out evenly. Rows without words take nothing. A null source is a source; a null doc_id is a document; an
    empty table gives an empty result.
    """
    if "tag" not in rows.columns:
        rows = rows.withColumn("tag", F.lit(0).cast("long"))
    total = _decided(rows, weights, share, most)
    # Equal rows come back in two steps, so that no array is as long as their number.
    runs = total.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / AT_ONCE) * AT_ONCE, F.lit(AT_ONCE).cast("long"))))
    each = runs.withColumn("k", F.explode(F.sequence(F.col("from") + 1, F.least(F.col("m"), F.col("from") + AT_ONCE))))
    copies = F.floor(F.col("all_copies") / F.col("m")) + F.when(F.col("k") <= F.col("all_copies") % F.col("m"), 1).otherwise(0)
    return each.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def _measured(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> dict[str, Column]:
    return {"doc_id": docs[id_col], "source": docs[source_col], "size": word_count(docs[text_col]), "tag": F.xxhash64(docs[text_col])}


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """mix() over a table of documents, whose size is their number of words (null text: 0)."""
    return mix(docs.select(*(c.alias(n) for n, c in _measured(docs, id_col, source_col, text_col).items())), **how)


def take_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The mixed corpus: the rows of docs, each as often as the mix takes it, with the columns of docs.

    Rows without words (no tokens to weigh) aren't taken. Rows meet their decision by one key, a hash of id,
    source, size and text, null ids like others. Rows that agree in all of these share their copies out
    evenly; those that get one more are the first ones by partition of the input. An empty table gives an
    empty result; other columns may have any names.
    """
    measured = _measured(docs, id_col, source_col, text_col)
    decided = _decided(docs.select(*(c.alias(n) for n, c in measured.items())), **how).where("all_copies > 0")
    decided = decided.select(F.col("key").alias("__key"), (F.col("all_copies") / F.col("m")).cast("long").alias("__each"), (F.col("all_copies") % F.col("m")).alias("__more"))
    decided = written(decided, "mix-decided")
    names, keyed = docs.columns, renamed(docs)
    inner = keyed.columns
    keyed = keyed.withColumn("__key", F.xxhash64(*_measured(keyed, *(inner[names.index(c)] for c in (id_col, source_col, text_col))).values()))

    def copied(rows: DataFrame, copies: Column) -> DataFrame:
        return rows.withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*inner).toDF(*names)

    # Always by a shuffle, so that small tables take the way of large ones.
    even = copied(keyed.join(decided.where("__more = 0").hint("merge"), "__key"), F.col("__each"))
    uneven = decided.where("__more > 0")
    if uneven.isEmpty():
        return even
    # Equal rows may be a great part of the table: they are numbered by partition, and partitions are counted up.
    rows = written(keyed.join(uneven, "__key").withColumn("__part", F.spark_partition_id()), "mix-uneven")
    numbered = rows.withColumn("__nth", F.row_number().over(W.partitionBy("__key", "__part").orderBy(F.lit(0))))
    counts = rows.groupBy("__key", "__part").agg(F.count("*").alias("__n"))
    earlier = W.partitionBy("__key").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("__key", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    one_more = F.col("__each") + (F.col("__before") + F.col("__nth") <= F.col("__more")).cast("long")
    placed = numbered.join(counts, ["__key", "__part"]).withColumn("__copies", one_more).where("__copies > 0")
    return even.union(copied(placed, F.col("__copies")))
