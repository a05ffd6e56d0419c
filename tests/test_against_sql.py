"""Queries and functions against their SQL where single digits and signs decide."""

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from terrasync import catalog
from terrasync.functions import geometry as geo


@pytest.fixture
def around_the_equator(tmp_path):
    """orders and lineitem whose squares lie on both sides of the equator."""
    con = duckdb.connect()
    for t, k in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.execute(f"COPY (SELECT * REPLACE ({k} + 131500 AS {k}) FROM '/root/testdata/sf0.001/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    return str(tmp_path), con


def test_a_box_on_the_equator_keeps_its_sign(spark, around_the_equator):
    folder, con = around_the_equator
    want = sorted(con.execute(catalog.ORACLES["affected_bboxes"]).fetchall())
    assert sum(",-0.000000," in w for w, in want) > 20
    assert sorted(map(tuple, catalog.QUERIES["affected_bboxes"](spark, folder).collect())) == want


def boxes(keys):
    x, y, s = -74.0 + (keys % 400) * 0.1, -33.0 + ((keys // 400) % 380) * 0.1, 0.01 * (1 + keys % 5)
    return [[[a, b], [a + c, b], [a + c, b + c], [a, b + c], [a, b]] for a, b, c in zip(x.tolist(), y.tolist(), s.tolist(), strict=True)]


def polygons(rings):
    return [{"type": "Polygon", "coordinates": [r]} for r in rings]


def test_areas_of_small_boxes_are_the_sql_s_to_the_last_digit():
    """Sums of many areas are rounded, so noise of a hundred-thousandth of a square metre would show in some."""
    keys = np.arange(0, 152_000, 7)
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT range AS k FROM range(0, 152000, 7)")
    want = con.execute(f"SELECT m2 FROM ({catalog.squares_sql('k', 't', 'k')}) ORDER BY k").fetchnumpy()["m2"]
    assert np.abs(geo.geodesic_areas(polygons(boxes(keys))) - want).max() < 1e-8


def test_the_closed_form_of_small_boxes_is_the_geodesic_area():
    """Against the general way, which a ring with a sixth point on a meridian takes; whatever the ring's sense and first point, with holes and other shapes beside them."""
    rings = boxes(np.arange(0, 152_000, 301)) + [[[9, y], [9.05, y], [9.05, y + 0.05], [9, y + 0.05], [9, y]] for y in (-84.9, 0.0, 70.0, 84.9, 89.0)]
    six = polygons([[*r[:2], [r[1][0], (r[1][1] + r[2][1]) / 2], *r[2:]] for r in rings])
    want = geo.geodesic_areas(six)
    for turned in (rings, [r[::-1] for r in rings], [[*r[1:], r[1]] for r in rings]):
        assert np.abs(geo.geodesic_areas(polygons(turned)) - want).max() < 1e-4
    mixed = [six[0], polygons(rings)[1], None, {"type": "Polygon", "coordinates": [rings[4], [[x, y] for x, y in rings[4][:3]]]}, {"type": "Point", "coordinates": [1, 2]}]
    got = geo.geodesic_areas(mixed)
    triangle = geo.geodesic_areas(polygons([rings[4][:3]]))[0]
    assert np.abs(got - [want[0], want[1], 0, want[4] - triangle, 0]).max() < 1e-4


def keyed_folder(tmp_path, n):
    con = duckdb.connect()
    for t, columns in (("customer", "range AS c_custkey"), ("orders", "range AS o_orderkey"), ("events", "range AS event_id, range % 5 AS user_id")):
        con.execute(f"COPY (SELECT {columns} FROM range({n})) TO '{tmp_path}/{t}.parquet'")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["geometry_kinds", "force2d_envelope", "centroid", "geodesic_area", "geodesic_polar_sectors", "utm_points", "kpi_theme_geodesic"])
def test_geometries_of_one_file_are_dealt_over_tasks(spark, tmp_path, monkeypatch, name):
    """A file of one split holds millions of keys; no task works on more than about so many."""
    monkeypatch.setattr(catalog, "ROWS_PER_TASK", 100)
    got = catalog.QUERIES[name](spark, keyed_folder(tmp_path, 1000))
    if name == "kpi_theme_geodesic":
        assert "RoundRobinPartitioning(10)" in got._jdf.queryExecution().executedPlan().toString()
    else:
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 10 and max(sizes) <= 110
    assert spread_rows(spark, 0) == 0 and spread_rows(spark, 101) == 101


def spread_rows(spark, n):
    return catalog.spread(spark.range(n)).distinct().count()
