from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrasync.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Sources' targets, by the rule as it is told: cap, then share the excess out by weight, again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    open_, out, left = set(order), {}, share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_targets_and_copies(spark):
    rows = [(i, ["a", "b", "é", None, "Z", "big"][min(i % 11, 5)], (i * 7919) % 300 + 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for _, s, z in rows:
        sizes[s] += z
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r["size"] and r.copies <= 2
        assert abs(r.copies - r.target / r.source_size) < 1
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 10 + 1
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 0, "b": 5}, {"a": 0}, {"a": 10, "b": 10, "c": 1000, None: 3}, {"a": 1000, "b": 1}])
def test_few_sources(spark, sizes):
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
    got = {r.source: r.target for r in mixing.mix(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_odd_rows(odd, none):
    got = mixing.mix_documents(odd).collect()
    assert len(got) == odd.count() and all(r.taken <= 2 * r["size"] for r in got)
    assert {r.taken for r in got if r.doc_id in (0, 1, 2)} == {0}
    mixed = mixing.take_mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.copies for r in got)
    have = Counter(str(r.doc_id) for r in mixed.select("doc_id").collect())
    want = Counter()
    for r in got:
        want[str(r.doc_id)] += r.copies
    assert have == +want
    assert mixing.mix_documents(none).collect() == [] and mixing.take_mix(none).collect() == []


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame([(i, "s", i + 1) for i in range(100)], "doc_id long, source string, size long").where(F.col("size") > 0)
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_probabilities_are_kept(spark):
    """Over many seeds each document is taken with its probability, and the words stay near the target."""
    nodes = spark.createDataFrame([("s", i, float(z), p) for i, (z, p) in enumerate([(10, 0.3), (20, 0.5), (5, 0.7), (40, 0.25), (8, 0.4), (13, 0.6)] * 8)], "source string, id long, z double, p double")
    hits, runs = Counter(), 25
    seed, landings, mixing.LANDINGS = mixing.SEED, mixing.LANDINGS, 0
    try:
        for mixing.SEED in range(runs):
            for r in mixing.dependent_rounding(nodes).where("one").collect():
                hits[r.id % 6] += 1
    finally:
        mixing.SEED, mixing.LANDINGS = seed, landings
    for k, p in enumerate((0.3, 0.5, 0.7, 0.25, 0.4, 0.6)):
        assert abs(hits[k] / (8 * runs) - p) < 0.13


def test_many_rows_without_an_id(spark):
    """A third of the rows share the null id; some of them are equal in all that counts."""
    texts = ["word " * (1 + i % 90) + str(i % 300) for i in range(3000)]
    rows = [(None if i % 3 == 0 else i, t, "s" if i % 2 else None, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tag long").repartition(6)
    decided = mixing.mix_documents(df).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("n")).where("n > 0").collect()
    taken = mixing.take_mix(df).collect()
    got = Counter((str(r.doc_id), str(r.source), len(r.text.split())) for r in taken)
    assert got == Counter({(str(r.doc_id), str(r.source), r["size"]): r.n for r in decided})
    assert max(Counter(r.tag for r in taken).values()) <= 2


def test_equal_rows_share_evenly(spark):
    df = spark.createDataFrame([(7, "a b c", "s")] * 9001 + [(8, "a b", "s"), (9, "d", "t")], "doc_id long, text string, source string")
    got = [r.copies for r in mixing.mix_documents(df).where("doc_id = 7").collect()]
    assert len(got) == 9001 and max(got) - min(got) <= 1
    assert mixing.take_mix(df).where("doc_id = 7").count() == sum(got)


def test_columns_of_any_names_come_back(spark, odd_rows):
    """Names like those that the operators use inside, in either case, keep their values."""
    from terrasync.llm import minhash, simhash

    extra = ["__key", "__K", "__each", "__more", "__part", "__row_a", "__ROW_B", "__nth", "c0", "c1", "first", "times"]
    rows = [(i, r[1], r[3], *(f"{n}-{i}" for n in extra)) for i, r in enumerate(odd_rows)]
    docs = spark.createDataFrame([*rows, rows[6], rows[6]], ["doc_id", "text", "source", *extra])
    for stage in (mixing.take_mix, minhash.keep_one, simhash.keep_one):
        found = stage(docs)
        assert found.columns == docs.columns
        got = found.collect()
        assert got and all(tuple(r) == rows[r.doc_id] for r in got)
