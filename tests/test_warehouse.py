"""Layers, splits and sweeps of keyed tables, against joins over plain tables."""

import random

import pytest
from pyspark.sql import functions as F

from terrasync.operators import keyed
from terrasync.sources.warehouse import Warehouse

SCHEMA = "id string, name string, n int"


def content(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def put(house, entry):
    house.publish({"t": entry})


@pytest.mark.parametrize("share,per", [(1e9, 8), (0.3, 8)])
def test_history_equals_joins(spark, tmp_path, share, per):
    """Upserts and deletes, over layers alone and with merges and splits between."""
    rng = random.Random(4)
    house = Warehouse(spark, f"file://{tmp_path}", rows_per_bucket=per, share=share, most_layers=3)
    want = spark.createDataFrame([(str(i), f"a{i}", i) for i in range(20)] + [(None, "null", 0)], SCHEMA)
    put(house, house.stage_keyed("t", want, "id", 20))
    n = house._last()[1]["t"]["buckets"]
    for step in range(5):
        changed = {rng.randrange(90): f"s{step}" for _ in range(25)}
        rows = spark.createDataFrame([(f" {k}" if k > 80 else str(k), v) for k, v in changed.items()] + [(None, f"null{step}")], "id string, name string")
        rows = rows.withColumn("id", F.trim("id"))
        gone = spark.createDataFrame([(str(rng.randrange(90)),) for _ in range(6)] + [(None,)], "nid string")
        new = step % 2 == 0
        want = keyed.without(keyed.upsert(want, rows, "id"), gone.where("nid is not null"), "id") if new else keyed.without(want, gone.where("nid is not null"), "id")
        want = spark.createDataFrame(want.collect(), want.schema)
        put(house, house.apply("t", "id", rows if new else None, gone))
        entry = house._last()[1]["t"]
        assert content(house.read("t")) == content(want)
        some = spark.createDataFrame([("3",), ("85",), ("7",)], "nid string")
        assert content(keyed.held(house.read_holding("t", some), some, "id")) == content(keyed.held(want, some, "id"))
    if share < 1:
        assert any("-" in p for p in entry["parts"]) and max(r for r, _ in entry["sizes"].values()) <= 2 * per + 5  # split on their own; nulls are of one bucket
        assert sum(r for r, _ in entry["sizes"].values()) + sum(sum(x["rows"].values()) for x in entry.get("layers", [])) >= want.count()
    assert entry["buckets"] == n


def test_columns_that_come_and_stay(spark, tmp_path):
    house = Warehouse(spark, f"file://{tmp_path}", share=1e9)
    put(house, house.stage_keyed("t", spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], SCHEMA), "id", 2))
    put(house, house.apply("t", "id", spark.createDataFrame([(1, 7), (3, 9)], "id int, extra int")))
    got = {r.id: tuple(r)[1:] for r in house.read("t").select("id", "name", "n", "extra").collect()}
    assert got == {"1": ("a", 1, 7), "2": ("b", 2, None), "3": (None, None, 9)}
    entry = house._last()[1]["t"]
    assert house.apply("t", "id", spark.createDataFrame([], "id string, n int")) == entry


def test_a_delta_writes_its_own_bytes(spark, tmp_path):
    """A hundredth of the keys, all over the buckets: what is written is the delta, not the table."""
    house = Warehouse(spark, f"file://{tmp_path}", rows_per_bucket=10_000)
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("name"), F.col("id").cast("int").alias("n"))
    put(house, house.stage_keyed("t", rows, "id", 200_000))

    def held():
        return sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))

    before = held()
    delta = rows.where("n % 100 = 7").withColumn("name", F.sha2("name", 512))
    delta.coalesce(1).write.parquet(f"file://{tmp_path}/alone")
    alone = held() - before
    put(house, house.apply("t", "id", delta))
    assert held() - before - alone < 3 * alone < before / 10
    got = house.read("t").where("n % 100 = 7 or n % 100 = 8")
    assert got.count() == 4000 and got.join(delta, ["id", "name"], "left_semi").count() == 2000
    untouched = house.apply("t", "id", None, spark.createDataFrame([("7",)], "nid string"))
    assert house.staged(untouched).count() == 199_999


def test_sweep(spark, tmp_path):
    house = Warehouse(spark, f"file://{tmp_path}", share=0.01, rows_per_bucket=4)
    put(house, house.stage_keyed("a/t", spark.createDataFrame([(str(i), "a", i) for i in range(16)], SCHEMA), "id", 16))
    for i in range(3):
        put(house, house.apply("t", "id", spark.createDataFrame([(str(i), "b", i)], SCHEMA)))
    house.stage("t", spark.createDataFrame([("x", "never published", 0)], SCHEMA))
    want = content(house.read("t"))
    assert house.sweep(keep=1) == [f"manifests/{k:012d}.json" for k in range(1, 4)]  # young folders may still be read
    gone = house.sweep(keep=1, grace=-5)
    entry = house._last()[1]
    left = {f"tables/{p.parent.relative_to(tmp_path / 'tables')}" for p in (tmp_path / "tables").rglob("*.parquet")}
    named = {p for e in entry.values() for p in [*e["parts"].values(), *(x["path"] for x in e.get("layers", []))]}
    assert gone and left == named and content(house.read("t")) == want and house.sweep(keep=1, grace=-5) == []


def test_orphans_by_digests(spark):
    """Random sets with repeated and null ids; equal sets leave no bucket."""
    rng = random.Random(9)

    def ids(keys):
        return spark.createDataFrame([(k if k is None else str(k),) for k in keys], "nid string")

    for _ in range(3):
        target = rng.sample(range(300), 120)
        source = [k for k in target if rng.random() < 0.95] + rng.sample(range(300, 400), 10) + [7, 7, None]
        fresh = [k for k in source if k is not None and k >= 300]
        got = keyed.orphan_ids(ids(target), ids(source), ids(source), ids(fresh), buckets=16)
        assert {r.nid for r in got.collect()} == {str(k) for k in set(target) - set(source)}
    some = ids(range(50))
    assert keyed.differing(some, (ids(range(40, 50)), -1), (ids(range(40)), -1)) == set()
    assert len(keyed.differing(some, (ids(range(49)), -1))) == 1
    assert keyed.orphan_ids(some, some, some).isEmpty() and keyed.orphan_ids(ids([]), some, ids([])).isEmpty()
