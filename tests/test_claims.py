"""Runs that claim the warehouse, and what dead ones leave in a database."""

import json
import time
from datetime import timedelta

import pytest

from terrasync.sources.warehouse import Busy, Warehouse

from test_jobs import T0, World, square


def test_one_claim_at_a_time(spark, tmp_path):
    a, b = Warehouse(spark, f"file://{tmp_path}"), Warehouse(spark, f"file://{tmp_path}")
    with a.claim() as held:
        with pytest.raises(Busy), b.claim():
            pass
        with pytest.raises(Busy):
            b.put("x", spark.range(1))
        a.publish({"x": a.stage("x", spark.range(2))}, held)
        with pytest.raises(Busy):  # one manifest each
            a.publish({"x": a.stage("x", spark.range(3))}, held)
    b.put("x", spark.range(4))
    assert a.read("x").count() == 4 and a._last()[0] == 2 and not a._children("claims")


def test_a_dead_claim_is_taken_over_and_a_live_one_is_not(spark, tmp_path):
    house = Warehouse(spark, f"file://{tmp_path}", lease=1.0)
    with house.claim():
        time.sleep(2.5)  # kept by its beats
        with pytest.raises(Busy), house.claim():
            pass
    dead = house.claim().__enter__()
    dead._over.set()
    dead._beats.join()
    time.sleep(1.5)
    with house.claim() as heir:
        with pytest.raises(Busy):
            dead.check()
        with pytest.raises(Busy):
            house.publish({"x": house.stage("x", spark.range(1))}, dead)
        dead.__exit__()  # what isn't its own stays
        house.publish({"x": house.stage("x", spark.range(2))}, heir)
    assert house.read("x").count() == 2 and not house._children("claims")


def test_a_busy_warehouse_keeps_jobs_from_the_database(spark, tmp_path):
    w = World(spark, tmp_path)
    w.engine.sink = lambda *_: pytest.fail("sent without a claim")
    with Warehouse(spark, f"file://{tmp_path}").claim():
        result = w.engine.run_areas()
    assert result.status == "FAILED" and "claimed" in result.error and not w.warehouse.unfinished("area_of_interest")


class Killed(Exception):
    pass


@pytest.mark.parametrize("step,later", [("sink", "publish"), ("record", "sink")])
def test_killed_at_each_step(spark, tmp_path, step, later):
    """A run dies before, within or after its writes to the database; what it left is put right by the next one."""
    w, database, kill = World(spark, tmp_path), {}, []

    def sink(contract, schema, delta, gone):
        database.update({str(r["id"]): json.loads(r["geom"]) for r in delta.collect()})
        for r in gone.collect() if gone is not None else []:
            database.pop(r.nid, None)
        if "sink" in kill:
            raise Killed

    def record(flags, state):
        if "record" in kill:
            raise Killed

    publish = w.warehouse.publish

    def published(tables, claim=None):
        if "publish" in kill:
            raise Killed
        publish(tables, claim)

    w.engine.sink, w.engine.record, w.warehouse.publish = sink, record, published

    def agree():
        want = {str(r[0]): json.loads(r[5]) for r in w.tables["src.areas"]}
        assert database == want == {k: json.loads(r["geom"]) for k, r in w.rows("geo/dsp.area_of_interest").items()}
        assert not w.warehouse.unfinished("area_of_interest") and not w.warehouse._children("claims")

    assert w.engine.run_areas().status == "COMPLETED"
    agree()
    mark = w.engine._states().where("sync_key = 'area_of_interest'").first().watermark_last_event_at

    # The dead run sends two new areas and deletes one; then one of the new ones goes, and the deleted one comes back as it was.
    old = w.tables["src.areas"]
    new = [(k, f"n{k}", 20, T0 + timedelta(days=11), None, square(k)) for k in (60, 61)]
    w.tables["src.areas"] = old[1:] + new
    w.now += timedelta(days=3)
    kill.append(step)
    assert w.engine.run_areas().status == "FAILED"
    assert {"60", "61"} <= set(database) and "30" not in database and len(w.warehouse.unfinished("area_of_interest")) == 1
    assert w.warehouse.sweep(grace=-1.0) is not None and w.warehouse.unfinished("area_of_interest")
    kill.clear()
    w.tables["src.areas"] = [*old, new[0]]
    result = w.engine.run_areas()
    assert result.status == "COMPLETED", result.error
    agree()

    # The same where nothing else has changed: the mark stays.
    before = w.engine._states().where("sync_key = 'area_of_interest'").first().watermark_last_event_at
    w.tables["src.areas"] = old[1:] + new[:1]
    w.now += timedelta(days=3)
    kill.append(later)
    assert w.engine.run_areas().status == "FAILED" and "30" not in database
    kill.clear()
    w.tables["src.areas"] = [*old, new[0]]
    assert w.engine.run_areas().status == "COMPLETED"
    agree()
    assert mark < w.engine._states().where("sync_key = 'area_of_interest'").first().watermark_last_event_at == before
