import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from terrasync.functions import geometry as geo
from terrasync.operators import keyed, territory
from terrasync.plans.config import load
from terrasync.plans.jobs import Engine
from terrasync.sources import state as states
from terrasync.sources.warehouse import Warehouse

T0 = datetime(2026, 1, 1, tzinfo=UTC)


def square(x, y=0.0, s=0.1):
    return json.dumps({"type": "Polygon", "coordinates": [[[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]]})


TREE = {
    "batch": {
        "admin-unit": {
            f"level-{n}": {
                "source-table": f"src.level{n}",
                "target-table": f"dsp.territory_level_{n}",
                "primary-key": "pk",
                "partition-column": "up",
                "geometry-column": "shape",
                "persist-columns": ["pk", "label", "up"],
                "column-mapping": {"pk": "id", "up": "parent_id", "made": "created_at", "changed": "updated_at", "shape": "geom"},
                "creation-date-column": "made",
                "updated-at-column": "changed",
                "srid": 4326,
            }
            for n in (1, 2, 3)
        },
        "area-of-interest": {
            "source-table": "src.areas",
            "primary-key": "pk",
            "creation-date-column": "made",
            "updated-at-column": "changed",
            "territory-level-3-column": "up",
            "geometry-column": "shape",
            "srid": 4326,
        },
        "layers": [{"source-table": "src.rivers", "primary-key": "pk", "area-of-interest-id-column": "up", "creation-date-column": "made", "geometry-column": "shape", "srid": 4326}],
    },
    "kpis": {"theme-count": 1, "area-unit-of-measurement": "ha", "themes": [{"layer-name": "rivers", "unit-of-measurement": "km²"}]},
    "execution-jobs": {"admin-unit-level-2-geoserver-job": True, "admin-unit-level-3-geoserver-job": True, "area-of-interest-geoserver-job": True, "layer-jobs": True, "kpi-job": True},
}


class World:
    def __init__(self, spark, root):
        self.spark, self.now = spark, T0 + timedelta(days=10)
        row = lambda k, up, n=0: (k, f"n{k}", up, T0 + timedelta(hours=n), None, square(k % 50))
        self.tables = {
            "src.level1": [row(1, None)],
            "src.level2": [row(10, 1), row(11, 1)],
            "src.level3": [row(20, 10), row(21, 10), row(22, 11)],
            "src.areas": [row(30, 20), row(31, 21), row(32, 22)],
            "src.rivers": [row(40, 30), row(41, 30), row(42, 31)],
        }
        self.warehouse = Warehouse(spark, f"file://{root}")
        self.engine = Engine(spark, load(TREE), self.source, self.warehouse, clock=lambda: self.now)

    def source(self, name):
        return self.spark.createDataFrame(self.tables[name], "pk long, label string, up long, made timestamp, changed timestamp, shape string")

    def run(self):
        results = {r.job: r for r in self.engine.run_all()}
        assert all(r.status == "COMPLETED" for r in results.values()), results
        return results

    def rows(self, name):
        return {r["id"]: r for r in self.warehouse.read(name).collect()}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    w = World(spark, tmp_path_factory.mktemp("w"))
    w.run()
    return w


def test_first_load_then_nothing_then_changes(world):
    assert set(world.rows("geo/dsp.area_of_interest")) == {"30", "31", "32"}
    business = world.rows("target/dsp.area_of_interest")
    assert json.loads(business["30"].centroid_coordinates)["coordinates"] == pytest.approx([30.05, 0.05])
    assert "geom" not in business["30"].asDict() and business["30"].area is not None
    measures = {r.area_of_interest_id: r for r in world.warehouse.read("target/dsp.kpi_measure").collect()}
    assert set(measures) == {"30", "31"} and measures["30"].kpi_name == "rivers" and measures["30"].value > measures["31"].value
    assert all(r[territory.FLAG] for r in world.rows("target/dsp.territory_level_3").values())

    before = {n: sorted(map(str, world.warehouse.read(n).collect())) for n in ("geo/dsp.area_of_interest", "target/dsp.area_of_interest", "geo/dsp.rivers")}
    again = world.run()
    assert not any(r.has_changes for k, r in again.items() if k != "kpi")
    assert before == {n: sorted(map(str, world.warehouse.read(n).collect())) for n in before}

    # Flags are reset by whoever makes the files; then one area moves on, one goes, one river is new.
    for n in (2, 3):
        name = f"target/dsp.territory_level_{n}"
        world.warehouse.put(name, world.warehouse.read(name).withColumn(territory.FLAG, F.lit(False)))
    world.now += timedelta(days=2)
    areas = world.tables["src.areas"]
    world.tables["src.areas"] = [(30, "n30", 21, T0, world.now, square(5)), areas[1]]
    world.tables["src.rivers"] += [(43, "n43", 31, world.now, None, square(9)), (44, "n44", 31, world.now, None, " ")]
    got = world.run()
    assert got["dsp_rivers"].skipped == 1 and got["area-of-interest"].skipped == 0
    assert got["area-of-interest"].deleted == 1 and got["area-of-interest"].read == 1 and got["dsp_rivers"].read == 1
    assert got["area-of-interest"].written == {"target/dsp.area_of_interest": 1, "geo/dsp.area_of_interest": 1} and got["dsp_rivers"].written == {"geo/dsp.rivers": 1}
    assert got["area-of-interest"].flagged == {"dsp.territory_level_3": 3, "dsp.territory_level_2": 2} and got["area-of-interest"].committed and got["area-of-interest"].sent == 0
    assert not again["dsp_rivers"].committed and again["dsp_rivers"].written == {}
    assert got["area-of-interest"].boxes.count() == 2
    assert set(world.rows("geo/dsp.area_of_interest")) == {"30", "31"} == set(world.rows("target/dsp.area_of_interest"))
    flags = {k: r[territory.FLAG] for k, r in world.rows("target/dsp.territory_level_3").items()}
    assert flags == {"20": True, "21": True, "22": True}  # left, entered, and lost an area
    assert all(r[territory.FLAG] for r in world.rows("target/dsp.territory_level_2").values())
    state = states.find(world.warehouse.read(states.TABLE), "area_of_interest")
    assert state.watermark_last_event_at.replace(tzinfo=UTC) == world.now or state.watermark_last_event_at == world.now.replace(tzinfo=None)


def test_failed_job_changes_nothing(world):
    number = world.warehouse._last()[0]
    world.tables["src.level1"] = [(1, "x", None, None, None, "no json")]
    area = world.engine.settings.area_of_interest
    kept, area.primary_key = area.primary_key, "absent"
    assert world.engine.run_areas().status == "FAILED"
    area.primary_key = kept
    assert world.warehouse._last()[0] == number


def test_failing_sink_leaves_the_old_state(spark, tmp_path):
    w = World(spark, tmp_path)
    seen = []

    def sink(contract, schema, delta, gone):
        seen.append((contract.sync_key, delta.count(), gone))
        raise OSError("no connection")

    w.engine.sink = sink
    assert w.engine.run_admin_unit(1).status == "FAILED" and seen == [("admin_unit_level_1", 1, None)]
    assert w.warehouse.read("geo/dsp.territory_level_1") is None and w.warehouse.read(states.TABLE) is None
    w.engine.sink = None
    assert w.engine.run_admin_unit(1).status == "COMPLETED" and set(w.rows("geo/dsp.territory_level_1")) == {"1"}


def test_two_writers(spark, tmp_path):
    a, b = Warehouse(spark, f"file://{tmp_path}"), Warehouse(spark, f"file://{tmp_path}")
    a.put("x", spark.range(2))
    staged = b.stage("y", spark.range(3))
    b._last = lambda: (0, {})
    with pytest.raises(RuntimeError):
        b.publish({"y": staged})
    assert a.read("x").count() == 2 and a.read("y") is None and not a.exists("y")


def test_upsert_and_latest(spark):
    target = spark.createDataFrame([(1, "old", False), (2, "old", True)], "id long, name string, flag boolean")
    delta = spark.createDataFrame([(2, "new", 1), (2, "newest", 2), (3, "new", 1)], "id long, name string, at int")
    new = keyed.upsert(target, keyed.latest(delta, "id", F.col("at")).drop("at"), "id")
    assert {tuple(r) for r in new.collect()} == {(1, "old", False), (2, "newest", True), (3, "new", None)}


def test_orphans_and_departed(spark):
    target = spark.createDataFrame([("1",), ("2",), ("4",)], "id string")
    source = spark.createDataFrame([("1",), ("2",), ("3",)], "nid string")
    assert [r.nid for r in keyed.orphans(target, source, "id").collect()] == ["4"]
    ids = territory.merged_ids(spark.createDataFrame([(" l3-a ",), ("",), (None,)], "id string"), spark.createDataFrame([(42,), (42,)], "id long"))
    assert sorted(r.id for r in ids.collect()) == ["42", "l3-a"]


def test_hierarchy(spark):
    level3 = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", None), ("d", "q")], "id string, parent_id string")
    old, new = datetime(2026, 1, 1), datetime(2026, 5, 1)
    areas = spark.createDataFrame([("a", old, new), ("c", new, None), ("d", old, None), (None, new, None)], "territory_level_3_id string, created_at timestamp, updated_at timestamp")
    mark = datetime(2026, 3, 1, tzinfo=UTC)
    ids = territory.level3_of_changed(areas, mark)
    flagged = lambda df: {r.id for r in df.collect() if r[territory.FLAG]}
    assert flagged(territory.flag_among(level3, ids)) == {"a", "c"}
    assert {r.id for r in territory.parents_of(level3, ids).collect()} == {"p"}
    assert flagged(territory.flag_among(level3, territory.level3_of_changed(areas, None))) == {"a", "c", "d"}


def test_state_keeps_what_is_not_said(spark):
    known = spark.createDataFrame([], states.SCHEMA)
    known = states.mark_orphan_check(known, "k", "s.t", T0)
    known = states.advance(known, "k", "s.t", T0, 7, T0)
    known = states.advance(known, "k", "s.t", None, 8, T0 + timedelta(days=1))
    got = states.find(known, "k")
    assert got.last_job_execution_id == 8 and got.watermark_last_event_at is not None and got.last_orphan_check_at is not None
    assert states.find(known, "other") is None


def test_a_change_of_one_key_writes_one_bucket(spark, tmp_path):
    house = Warehouse(spark, f"file://{tmp_path}", rows_per_bucket=100)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("old").alias("name"), F.lit(True).alias("flag"))
    house.publish({"t": house.stage_keyed("t", rows, "id", 1000)})
    before = house._last()[1]["t"]
    assert before["buckets"] == 16 == len(before["parts"])
    delta = spark.createDataFrame([("7", "new", 1)], "id string, name string, extra int")
    ids = delta.select(F.col("id").alias("nid"))
    house.publish({"t": house.restage("t", "id", lambda rows: keyed.upsert(rows, delta, "id"), ids)})
    after = house._last()[1]["t"]
    assert sum(before["parts"][b] != after["parts"][b] for b in before["parts"]) == 1
    assert len(list(tmp_path.glob("tables/t/*/*/*.parquet"))) == len(before["parts"]) + 1
    got = {r.id: tuple(r)[1:] for r in house.read("t").select("id", "name", "flag", "extra").collect()}
    assert len(got) == 1000 and got["7"] == ("new", True, 1) and got["8"] == ("old", True, None)
    assert house.read_holding("t", ids).count() < 200
    gone = spark.createDataFrame([("7",), ("8",)], "nid string")
    house.publish({"t": house.restage("t", "id", lambda rows: keyed.without(rows, gone, "id"), gone)})
    assert house.read("t").count() == 998
    with pytest.raises(ValueError, match="wasn't given"):
        house.restage("t", "id", lambda rows: rows.unionByName(rows.limit(1).withColumn("id", F.explode(F.array(*map(F.lit, map(str, range(200))))))), gone)
    nulls = spark.createDataFrame([(None, "n")], "id string, name string")
    house.publish({"t": house.restage("t", "id", lambda rows: keyed.upsert(rows, nulls, "id"), nulls.select(F.col("id").alias("nid")))})
    assert house.read("t").count() == 999
    none = house.restage("t", "id", lambda rows: rows, gone.limit(0))
    assert none == house._last()[1]["t"]


def test_jobs_over_many_buckets(spark, tmp_path):
    """The same runs as over one bucket, with a bucket for each row or so."""
    w = World(spark, tmp_path)
    w.warehouse.rows_per_bucket, w.warehouse.share = 1, 1e9
    seen = []
    w.engine.record = lambda flags, state: seen.append(({t: (k, {r.nid for r in ids.collect()}) for t, (k, ids) in flags.items()}, state.first()))
    w.run()
    assert [s.sync_key for _, s in seen] == ["admin_unit_level_1", "admin_unit_level_2", "admin_unit_level_3", "area_of_interest", "dsp_rivers"]
    assert seen[1][0] == {"dsp.territory_level_2": ("id", {"10", "11"})} and seen[0][0] == {} == seen[4][0]
    assert seen[3][0] == {"dsp.territory_level_3": ("id", {"20", "21", "22"}), "dsp.territory_level_2": ("id", {"10", "11"})}
    w.now += timedelta(days=2)
    before = w.warehouse._last()[1]["geo/dsp.area_of_interest"]
    areas = w.tables["src.areas"]
    w.tables["src.areas"] = [(30, "n30", 21, T0, w.now, square(5)), areas[1]]
    got = w.run()
    assert got["area-of-interest"].deleted == 1 and got["area-of-interest"].boxes.count() == 2
    assert set(w.rows("geo/dsp.area_of_interest")) == {"30", "31"} == set(w.rows("target/dsp.area_of_interest"))
    assert w.rows("geo/dsp.area_of_interest")["30"].territory_level_3_id == "21"
    after = w.warehouse._last()[1]["geo/dsp.area_of_interest"]
    layer = after["layers"][-1]["rows"]
    assert before["buckets"] == 4 and after["parts"] == before["parts"] and {int(b) for b in layer} == w.warehouse._touched(before, spark.createDataFrame([("30",), ("32",)], "nid string"))
    measured = w.warehouse._last()[1]["measured/geo/dsp.area_of_interest"]["layers"]
    assert sum(measured[-1]["rows"].values()) == 2 == sum(layer.values())  # the changed area is measured, the removed one's mark is kept
    want = w.warehouse.read("geo/dsp.area_of_interest").select("id", geo.geodesic_area(F.col("geom"), 4326).alias("m2")).collect()
    assert {tuple(r) for r in w.warehouse.read("measured/geo/dsp.area_of_interest").select("id", "m2").collect()} == {tuple(r) for r in want}
    assert w.warehouse._last()[1]["measured/geo/dsp.rivers"].get("layers") is None  # nothing new, nothing measured
    assert all(r[territory.FLAG] for n in (2, 3) for r in w.rows(f"target/dsp.territory_level_{n}").values())


def test_a_file_is_run(spark, tmp_path, capsys):
    import yaml

    from terrasync import run

    (tmp_path / "c.yml").write_text(yaml.safe_dump(TREE))
    w = World(spark, tmp_path / "w")
    w.tables["src.areas"] = None  # this job fails
    assert run.main([f"file://{tmp_path}/c.yml", "x"], engine=lambda _, settings, root: type("E", (), {"run_all": lambda self: [w.engine.run_admin_unit(1), w.engine.run_areas()]})()) == 1
    said = capsys.readouterr().out
    assert "admin-unit-level-1: COMPLETED, read 1" in said and "area-of-interest: FAILED" in said
    assert run.main([]) == 2
