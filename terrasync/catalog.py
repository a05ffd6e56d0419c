"""Queries over the driver's tables, each with the SQL that gives the same rows.

Roles: region, nation and customer are the three levels of territories, orders the areas of interest
(updated at their last shipping), events and lineitem layers of features. A key k stands for a square of
side s = 0.01 * (1 + k % 5) degrees at (-74 + (k % 400) * 0.1, -33 + ((k / 400) % 380) * 0.1).
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import geometry as geo
from .functions.ids import all_whole_numbers, box_text, normal
from .functions.temporal import EventColumn, Temporal, change_filter, last_event, pin_utc
from .functions.units import area_in
from .operators import keyed, kpi, territory
from .plans.config import AreaOfInterest, Layer, Settings
from .plans.contract import Contract, adopter, area_contract, layer_contract, where_all
from .sources import state as states
from .plans.jobs import Engine
from .sources.jdbc import between, key_bounds, split_range, splitters
from .sources.warehouse import Warehouse

MARK = datetime(2001, 6, 1, tzinfo=UTC)
ZONE = "Asia/Kolkata"  # five and a half hours ahead of UTC, without changes in the tables' years

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query of the function's name, with its SQL."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---------------------------------------------------------------- roles


#: Rows whose geometries one task works on.
ROWS_PER_TASK = 20_000


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt evenly over tasks by their number: keys are a few bytes in a file, so its splits hold millions, and geometries are made of each.

    They are counted for that, which reads no column; keys are shuffled, not texts.
    """
    return rows.repartition(max(1, math.ceil(rows.count() / ROWS_PER_TASK)))


def square(k: Column) -> tuple[Column, Column, Column]:
    s = F.lit(0.01) * (1 + k % 5)
    return F.lit(-74.0) + (k % 400) * 0.1, F.lit(-33.0) + (F.floor(k / 400) % 380) * 0.1, s


def square_text(k: Column) -> Column:
    x, y, s = square(k)
    ring = F.array(*(F.array(a, b) for a, b in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def area_source(t) -> DataFrame:
    shipped = t("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("changed"))
    orders = t("orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.select("o_orderkey", "o_custkey", "o_orderdate", "changed", "o_totalprice", "o_orderstatus", square_text(F.col("o_orderkey")).alias("the_geom"))


AREA = AreaOfInterest(
    source_table="source.orders",
    primary_key="o_orderkey",
    creation_date_column="o_orderdate",
    updated_at_column="changed",
    territory_level_3_column="o_custkey",
    geometry_column="the_geom",
    additional_columns=["o_orderstatus"],
    srid=4326,
    source_timezone="UTC",
)
EVENTS = Layer(
    source_table="source.events",
    layer_name="user-events",
    primary_key="event_id",
    area_of_interest_id_column="user_id",
    creation_date_column="ts",
    label_column="event_type",
    geometry_column="the_geom",
    srid=4326,
    source_timezone="UTC",
)

AREA_SQL = """
SELECT o_orderkey, o_custkey, o_orderdate, changed, o_totalprice, o_orderstatus FROM orders
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS changed FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
"""
NEW_SQL = "o_orderdate IS NOT NULL AND (o_orderdate > TIMESTAMP '2001-06-01' OR (changed IS NOT NULL AND changed > TIMESTAMP '2001-06-01'))"


def of_areas(t) -> tuple[DataFrame, Contract]:
    source = area_source(t)
    return source, area_contract(AREA, source.schema)


def stamp(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def stamp_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def rounded(c: Column, digits: int) -> Column:
    """Half up; what rounds to zero keeps its sign, as in SQL's round, since a text shows it."""
    r = F.round(c, digits)
    return F.when(r == 0, c * 0.0).otherwise(r)


def rounded_box(b: Column, digits: int = 6) -> list[Column]:
    return [rounded(b[c], digits).alias(c) for c in ("x0", "y0", "x1", "y1")]


def square_sql(k: str) -> dict[str, str]:
    x, y, s = f"(-74.0::DOUBLE + ({k} % 400) * 0.1::DOUBLE)", f"(-33.0::DOUBLE + (({k} // 400) % 380) * 0.1::DOUBLE)", f"(0.01::DOUBLE * (1 + {k} % 5))"
    return {"x0": x, "y0": y, "x1": f"({x} + {s})", "y1": f"({y} + {s})"}


# ---------------------------------------------------------------- contracts, scans and changes

_K = square_sql("o_orderkey")
_METRES = {"x0": f"6378137 * radians({_K['x0']})", "x1": f"6378137 * radians({_K['x1']})"} | {
    c: f"6378137 * ln(tan(pi() / 4 + radians({_K[c]}) / 2))" for c in ("y0", "y1")
}


@query(f"""WITH a AS ({AREA_SQL}) SELECT CAST(o_orderkey AS VARCHAR) AS id, {stamp_sql('o_orderdate')} AS created_at, {stamp_sql('changed')} AS updated_at,
CAST(o_custkey AS VARCHAR) AS territory_level_3_id, o_orderstatus, {', '.join(f'round({_METRES[c]}, 2) AS {c}' for c in _METRES)} FROM a WHERE {NEW_SQL}""")
def aoi_delta(t):
    source, contract = of_areas(t)
    rows = contract.scan(source, MARK)
    b = geo.box_in_metres(F.col("geom"), 4326)
    return rows.select("id", stamp("created_at").alias("created_at"), stamp("updated_at").alias("updated_at"), "territory_level_3_id", "o_orderstatus", *rounded_box(b, 2))


@query(f"SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS area_of_interest_id, {stamp_sql('ts')} AS created_at, event_type AS label FROM events")
def contract_projection(t):
    source = t("events").withColumn("the_geom", square_text(F.col("event_id")))
    contract = layer_contract(EVENTS, source.schema)
    return source.select(*contract.projection(source.schema)).select("id", "area_of_interest_id", stamp("created_at").alias("created_at"), "label")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus = 'O'")
def first_load_scan(t):
    source, contract = of_areas(t)
    return source.where(where_all(contract.selected(None), adopter("o_orderstatus = 'O'"))).select(F.col("o_orderkey").alias("id"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01'")
def delta_created_only(t):
    return t("orders").where(change_filter(EventColumn("o_orderdate", Temporal.TIMESTAMP, "UTC"), None, MARK)).select(F.col("o_orderkey").alias("id"))


@query(f"WITH a AS ({AREA_SQL}) SELECT o_orderkey AS id FROM a WHERE {NEW_SQL}")
def delta_created_or_updated(t):
    source, contract = of_areas(t)
    return source.where(change_filter(contract.created, contract.updated, MARK)).select(F.col("o_orderkey").alias("id"))


@query("SELECT event_id AS id FROM events WHERE ts > (SELECT min(ts) FROM events) AND ts > TIMESTAMP '2024-01-15 05:30:00'")
def delta_ntz_zone(t):
    rows = t("events")
    first = rows.agg(F.min("ts").alias("first"))
    late = rows.where(EventColumn("ts", Temporal.TIMESTAMP, ZONE).newer_than(datetime(2024, 1, 15, tzinfo=UTC)))
    return late.crossJoin(F.broadcast(first)).where("ts > first").select(F.col("event_id").alias("id"))


@query("SELECT o_orderkey AS id FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2001-06-01'")
def delta_date_zone(t):
    rows = t("orders").withColumn("day", F.to_date("o_orderdate"))
    return rows.where(EventColumn("day", Temporal.DATE, ZONE).newer_than(MARK)).select(F.col("o_orderkey").alias("id"))


@query(f"SELECT o_orderkey AS id, {stamp_sql('o_orderdate - INTERVAL 330 MINUTE')} AS instant FROM orders")
def event_instant_utc(t):
    return t("orders").select(F.col("o_orderkey").alias("id"), stamp(EventColumn("o_orderdate", Temporal.TIMESTAMP, ZONE).instant()).alias("instant"))


@query(f"WITH a AS ({AREA_SQL}) SELECT {stamp_sql('max(greatest(o_orderdate, changed))')} AS proposed, count(*) AS n FROM a WHERE {NEW_SQL}")
def proposed_watermark(t):
    source, contract = of_areas(t)
    return source.where(contract.selected(MARK)).agg(stamp(F.max(last_event(contract.created, contract.updated))).alias("proposed"), F.count("*").alias("n"))


@query("SELECT o_orderkey AS id FROM orders WHERE (o_orderstatus = 'F' OR o_totalprice > 100000) AND o_orderdate > TIMESTAMP '2001-06-01'")
def where_combination(t):
    change = change_filter(EventColumn("o_orderdate", Temporal.TIMESTAMP, "UTC"), None, MARK)
    return t("orders").where(where_all(adopter(" 1=1 "), adopter("o_orderstatus = 'F' OR o_totalprice > 100000"), None, change)).select(F.col("o_orderkey").alias("id"))


@query("SELECT CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) AS price_id, trim(o_orderpriority) AS priority_id, o_orderkey AS k FROM orders")
def normalized_ids(t):
    rows = t("orders").withColumn("o_orderpriority", F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")))
    return rows.select(normal(rows, "o_totalprice").alias("price_id"), normal(rows, "o_orderpriority").alias("priority_id"), F.col("o_orderkey").alias("k"))


# ---------------------------------------------------------------- orphans and departures


def stale(t) -> tuple[DataFrame, DataFrame]:
    """A source that has lost what isn't open any more, and the target that still has all."""
    source = t("orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("nid"))
    return source, t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("territory_level_3_id"), square_text(F.col("o_orderkey")).alias("geom"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def orphan_ids(t):
    source, target = stale(t)
    return keyed.orphans(target.where(geo.has_positions(F.col("geom"))), source, "id").select(F.col("nid").alias("id"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'lost' AS run FROM orders WHERE o_orderkey % 997 = 5 AND o_orderkey % 5 <> 3
UNION ALL SELECT 'none', 'differing buckets of equal sets'""")
def orphan_digests(t):
    """Ids that the source has lost, compared in buckets that don't add up; keys that only this run brings are fresh."""
    ids = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("nid"))
    target, source, fresh = ids.where("k % 5 <> 3").select("nid"), ids.where("k % 997 <> 5").select("nid"), ids.where("k % 5 = 3 and k % 997 <> 5").select("nid")
    lost = keyed.orphan_ids(target, source, source, fresh)
    same = keyed.differing(ids.select("nid"), (target, -1), (ids.where("k % 5 = 3").select("nid"), -1))
    said = ids.sparkSession.createDataFrame([("none" if not same else str(len(same)), "differing buckets of equal sets")], "id string, run string")
    return lost.select(F.col("nid").alias("id"), F.lit("lost").alias("run")).unionByName(said)


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {', '.join(f'round({_METRES[c]}, 2) AS {c}' for c in _METRES)} FROM orders WHERE o_orderstatus = 'P'")
def orphan_with_bbox(t):
    source, target = stale(t)
    lost = keyed.held(target, keyed.orphans(target.select("id"), source, "id"), "id")  # geometries stay out of the shuffle
    return lost.select(F.col("nid").alias("id"), *rounded_box(geo.box_in_metres(F.col("geom"), 4326), 2))


@query(f"WITH a AS ({AREA_SQL}) SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM a WHERE {NEW_SQL}")
def departed_from_delta(t):
    source, contract = of_areas(t)
    _, target = stale(t)
    delta = source.where(contract.selected(MARK)).select(F.col("o_orderkey").alias("id"))
    return territory.merged_ids(target.join(delta, "id", "left_semi").select(F.col("territory_level_3_id").alias("id")))


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'P'")
def departed_from_orphans(t):
    source, target = stale(t)
    return territory.merged_ids(keyed.orphans(target, source, "id").select(F.col("territory_level_3_id").alias("id")))


@query(f"WITH a AS ({AREA_SQL}) SELECT CAST(o_custkey AS VARCHAR) AS id FROM a WHERE {NEW_SQL} UNION SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P'")
def departed_merged(t):
    return territory.merged_ids(departed_from_delta(t), departed_from_orphans(t))


# ---------------------------------------------------------------- keyed writes


def _target(t) -> DataFrame:
    rows = t("customer").where("c_acctbal < 5000")
    return rows.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_acctbal", (F.col("c_nationkey") == 1).alias("flag"))


@query("""SELECT coalesce(d.id, t.id) AS id, CASE WHEN d.id IS NULL THEN t.name ELSE d.name END AS name, CASE WHEN d.id IS NULL THEN t.bal ELSE d.bal END AS c_acctbal, coalesce(t.flag, false) AS flag
FROM (SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal, c_nationkey = 1 AS flag FROM customer WHERE c_acctbal < 5000) t
FULL JOIN (SELECT c_custkey AS id, c_mktsegment AS name, c_acctbal AS bal FROM customer WHERE c_nationkey < 10) d ON t.id = d.id""")
def upsert_result(t):
    delta = t("customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), "c_acctbal")
    return keyed.upsert(_target(t), delta, "id").select("id", "name", "c_acctbal", F.coalesce("flag", F.lit(False)).alias("flag"))


@query("SELECT l_orderkey AS id, max(l_shipdate)::DATE::VARCHAR AS shipped FROM lineitem GROUP BY 1")
def latest_in_batch(t):
    rows = t("lineitem").select(F.col("l_orderkey").alias("id"), "l_shipdate", "l_linenumber")
    return keyed.latest(rows, "id", F.col("l_shipdate")).select("id", F.to_date("l_shipdate").cast("string").alias("shipped"))


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal < 5000 AND c_nationkey <> 3")
def delete_result(t):
    gone = t("customer").where("c_nationkey = 3").select(F.col("c_custkey").cast("string").alias("nid"))
    return keyed.without(_target(t), gone, "id").select("id", "name")


@query("SELECT DISTINCT o_custkey AS ref FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 5)")
def fk_violations(t):
    return keyed.dangling(t("orders").select(F.col("o_custkey").alias("ref")), "ref", t("customer").where("c_nationkey <> 5"), "c_custkey").distinct()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations(t):
    return keyed.repeated_keys(t("lineitem"), "l_orderkey", "l_linenumber")


# ---------------------------------------------------------------- territory flags

_CHANGED = "(o_orderdate > TIMESTAMP '2001-06-01' OR changed > TIMESTAMP '2001-06-01')"


def _areas(t) -> DataFrame:
    return area_source(t).select(F.col("o_custkey").alias("territory_level_3_id"), F.col("o_orderdate").cast("timestamp").alias("created_at"), F.col("changed").cast("timestamp").alias("updated_at"))


def _level3(t) -> DataFrame:
    return t("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("parent_id"))


def _level2(t) -> DataFrame:
    return t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


@query(f"WITH a AS ({AREA_SQL}) SELECT o_orderkey AS id, coalesce({_CHANGED}, false) AS requires_s3_file_regeneration FROM a")
def flag_changed(t):
    rows = area_source(t).select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("created_at"), F.col("changed").cast("timestamp").alias("updated_at"))
    return territory.flag(rows, territory.changed_since(MARK)).select("id", territory.FLAG)


@query(f"WITH a AS ({AREA_SQL}) SELECT c_custkey AS id, c_custkey IN (SELECT o_custkey FROM a WHERE {_CHANGED}) AS requires_s3_file_regeneration FROM customer")
def flag_parents_l3(t):
    return territory.flag_among(_level3(t), territory.level3_of_changed(_areas(t), MARK)).select("id", territory.FLAG)


@query(f"""WITH a AS ({AREA_SQL}) SELECT n_nationkey AS id, n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_custkey IN
(SELECT o_custkey FROM a WHERE {_CHANGED})) AS requires_s3_file_regeneration FROM nation""")
def flag_parents_l2(t):
    ids = territory.parents_of(_level3(t), territory.level3_of_changed(_areas(t), MARK))
    return territory.flag_among(_level2(t), ids).select("id", territory.FLAG)


@query("SELECT n_nationkey AS id, n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) AS requires_s3_file_regeneration FROM nation")
def flag_departed_l2(t):
    return territory.flag_among(_level2(t), territory.parents_of(_level3(t), departed_from_orphans(t))).select("id", territory.FLAG)


# ---------------------------------------------------------------- runs into a warehouse


def _warehouse(spark: SparkSession) -> Warehouse:
    """A new one in the folder that all executors share, or in local mode in a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='terrasync-')}"
    return Warehouse(spark, f"{path.rstrip('/')}/terrasync-warehouse-{uuid.uuid4().hex}")


@query("""SELECT c_custkey AS id, CASE WHEN c_nationkey < 3 THEN 'moved' ELSE c_name END AS name, CAST(CASE WHEN c_nationkey < 3 THEN c_nationkey + 100 ELSE c_nationkey END AS INTEGER) AS parent_id, c_mktsegment AS segment
FROM customer WHERE c_nationkey <> 2 AND c_custkey % 10 <> 3
UNION ALL SELECT 1000000000 + n_nationkey, n_name, n_regionkey, NULL FROM nation""")
def warehouse_layers(t):
    """Changes and removals as layers over a keyed table: columns that a change doesn't have stay, new keys come, removed ones go."""
    rows = t("customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("int").alias("parent_id"), F.col("c_mktsegment").alias("segment"))
    house = _warehouse(rows.sparkSession)
    house.publish({"t": house.stage_keyed("t", rows, "id", rows.count())})
    moved = rows.where("parent_id < 3").select("id", F.lit("moved").alias("name"), (F.col("parent_id") + 100).alias("parent_id"))
    added = t("nation").select((F.lit(1_000_000_000) + F.col("n_nationkey")).cast("long").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("parent_id"))
    house.publish({"t": house.apply("t", "id", moved, rows.where("parent_id = 2").select(F.col("id").cast("string").alias("nid")))})
    house.publish({"t": house.apply("t", "id", added, rows.where("id % 10 = 3").select(F.col("id").cast("string").alias("nid")))})
    return house.read("t")


@query(f"""WITH a AS ({AREA_SQL}) SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS territory_level_3_id, {stamp_sql("o_orderdate")} AS created_at, {stamp_sql("changed")} AS updated_at,
round({_K["x0"]}, 6) AS x0, round({_K["y1"]}, 6) AS y1 FROM a WHERE o_orderstatus <> 'P' AND o_orderdate IS NOT NULL""")
def engine_two_runs(t):
    """Areas of interest after two runs of the job: as they were before the mark, then all but those in process, which are removed."""
    source = area_source(t)
    spark = source.sparkSession
    mark = F.lit(MARK)
    before = source.where(F.col("o_orderdate") <= mark).withColumn("changed", F.when(F.col("changed") <= mark, F.col("changed")))
    states_of = [before, source.where("o_orderstatus <> 'P'")]
    clock = iter([datetime(2001, 6, 2, tzinfo=UTC), datetime(2026, 1, 1, tzinfo=UTC)])
    house = _warehouse(spark)
    engine = Engine(spark, Settings(area_of_interest=AREA), lambda name: states_of[0], house, clock=lambda: next(clock))
    for _ in range(2):
        engine.sync(area_contract(AREA, source.schema))
        states_of.pop(0)
        states_of.append(source)
    rows = house.read("geo/dsp.area_of_interest")
    b = geo.bounds(F.col("geom"))
    return rows.select("id", "territory_level_3_id", stamp("created_at").alias("created_at"), stamp("updated_at").alias("updated_at"), F.round(b["x0"], 6).alias("x0"), F.round(b["y1"], 6).alias("y1"))


# ---------------------------------------------------------------- geometry

_BOX_TEXT = ", ".join(f"round({_METRES[c]}, 2)" for c in ("x0", "y0", "x1", "y1"))


@query(f"""WITH a AS ({AREA_SQL}) SELECT printf('%.6f,%.6f,%.6f,%.6f', {_BOX_TEXT}) AS bbox FROM a WHERE {NEW_SQL}
UNION ALL SELECT printf('%.6f,%.6f,%.6f,%.6f', {_BOX_TEXT}) FROM orders WHERE o_orderstatus = 'P'""")
def affected_bboxes(t):
    (source, contract), (there, target) = of_areas(t), stale(t)
    changed = source.where(contract.selected(MARK)).select(F.col("the_geom").alias("geom"))
    lost = keyed.held(target, keyed.orphans(target.select("id"), there, "id"), "id").select("geom")
    boxes = changed.unionByName(lost).select(geo.box_in_metres(F.col("geom"), 4326).alias("b"))
    return boxes.select(box_text(*rounded_box(F.col("b"), 2)).alias("bbox"))


@query(f"SELECT o_orderkey AS id, {', '.join(f'round({_K[c]}, 6) AS {c}' for c in _K)} FROM orders")
def force2d_envelope(t):
    with_height = F.regexp_replace(square_text(F.col("o_orderkey")), r"\[(-?[0-9.E]+),(-?[0-9.E]+)\]", r"[$1,$2,7.5]")
    rows = spread(t("orders").select("o_orderkey")).select(F.col("o_orderkey").alias("id"), geo.envelope(geo.force_2d(with_height)).alias("e"))
    return rows.select("id", *rounded_box(geo.bounds(F.col("e"))))


@query(f"SELECT o_orderkey AS id, round(({_K['x0']} + {_K['x1']}) / 2, 6) AS x, round(({_K['y0']} + {_K['y1']}) / 2, 6) AS y FROM orders")
def centroid(t):
    p = geo.positions(geo.centroid(square_text(F.col("o_orderkey"))))[0]
    return spread(t("orders").select("o_orderkey")).select(F.col("o_orderkey").alias("id"), p.alias("p")).select("id", F.round(F.col("p")[0], 6).alias("x"), F.round(F.col("p")[1], 6).alias("y"))


#: Between parallels and meridians areas have a closed form; a geodesic bulges from its parallel by a sliver, of which the leading term is all that shows here.
_A, _E2 = 6378137.0, (2 - 1 / 298.257223563) / 298.257223563


def _below_sql(lat: str) -> str:
    """For an edge along latitude lat (radians) over d (radians): square metres down to the equator, sliver included."""
    w = f"(1 - {_E2!r} * sin({lat}) ** 2)"
    root = f"sqrt({_E2!r})"
    band = f"{_A!r} ** 2 * (1 - {_E2!r}) / 2 * d * (sin({lat}) / {w} + ln((1 + {root} * sin({lat})) / (1 - {root} * sin({lat}))) / (2 * {root}))"
    return f"({band} + {_A!r} ** 2 / {w} * sin({lat}) * cos({lat}) ** 2 * d ** 3 / 12)"


def squares_sql(k: str, table: str, keys: str) -> str:
    """id and geodesic area of the squares of a table's keys."""
    q = square_sql(k)
    return f"SELECT *, {_below_sql('n')} - {_below_sql('s')} AS m2 FROM (SELECT {keys}, radians({q['x1']} - {q['x0']}) AS d, radians({q['y0']}) AS s, radians({q['y1']}) AS n FROM {table})"


@query(f"SELECT id, round(m2) AS m2 FROM ({squares_sql('c_custkey', 'customer', 'c_custkey AS id')})")
def geodesic_area(t):
    return spread(t("customer").select("c_custkey")).select(F.col("c_custkey").alias("id"), F.round(geo.geodesic_area(square_text(F.col("c_custkey")))).alias("m2"))


def _turned(x: Column) -> Column:
    return F.pmod(x + 180, F.lit(360.0)) - 180


@query("SELECT c_custkey AS id, round(510065621724088.44 * (10 + c_custkey % 170) / 720, -3) AS m2 FROM customer")
def geodesic_polar_sectors(t):
    """From a stretch of the equator to a pole, over the date line for some: a share of the hemisphere."""
    k = F.col("c_custkey")
    x, w, pole = (k % 360 - 180).cast("double"), (10 + k % 170).cast("double"), F.when(k % 2 == 0, F.lit(90.0)).otherwise(-90.0)
    east, zero = _turned(x + w), F.lit(0.0)
    ring = F.array(*(F.array(a, b) for a, b in ((x, zero), (_turned(x + w / 2), zero), (east, zero), (east, pole), (x, pole), (x, zero))))
    g = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    return spread(t("customer").select("c_custkey")).select(k.alias("id"), F.round(geo.geodesic_area(g), -3).alias("m2"))


_N = 1 / 298.257222101 / (2 - 1 / 298.257222101)
_ARCS = [6378137 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64), -3 / 2 * _N + 9 / 16 * _N**3, 15 / 16 * _N**2 - 15 / 32 * _N**4, -35 / 48 * _N**3, 315 / 512 * _N**4]
_MERIDIAN = f"{_ARCS[0]!r}::DOUBLE * (f + {' + '.join(f'({c!r})::DOUBLE * sin({2 * i} * f)' for i, c in enumerate(_ARCS[1:], 1))})"


@query(f"""SELECT c_custkey AS id, 500000.0::DOUBLE AS east, round(10000000 + 0.9996::DOUBLE * {_MERIDIAN}, 2) AS north, round(x, 7) AS x, round(y, 7) AS y
FROM (SELECT c_custkey, radians(-33.0::DOUBLE + (c_custkey % 380) * 0.1::DOUBLE) AS f, -48.0::DOUBLE + (c_custkey % 61) * 0.1::DOUBLE AS x, -33.0::DOUBLE + (c_custkey % 380) * 0.1::DOUBLE AS y FROM customer)""")
def utm_points(t):
    """Points on a zone's central meridian, whose northing is the meridian's length, and points of the zone there and back."""
    k, zone = F.col("c_custkey"), geo.Utm.of(31983)
    x, y = F.lit(-48.0) + (k % 61) * 0.1, F.lit(-33.0) + (k % 380) * 0.1
    middle = zone.forward(F.lit(-45.0), y)
    back = F.transform(F.array(zone.forward(x, y)), lambda p: zone.back(p[0], p[1]))[0]
    rows = spread(t("customer").select("c_custkey")).select(k.alias("id"), middle.alias("m"), back.alias("b"))
    return rows.select("id", F.round(F.col("m")[0], 2).alias("east"), F.round(F.col("m")[1], 2).alias("north"), F.round(F.col("b")[0], 7).alias("x"), F.round(F.col("b")[1], 7).alias("y"))


def kinds_text(k: Column) -> Column:
    """A geometry of the square of key k of each kind, by k % 9: with heights, members in any order, holes, collections in collections."""
    x, y, s = square(k)

    def at(a: Column, b: Column) -> Column:
        return F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit(",7.5]"))

    def ring(a, b, side) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", at(a, b), at(a + side, b), at(a + side, b + side), at(a, b + side), at(a, b)), F.lit("]"))

    def text(template: str, *parts: Column) -> Column:
        pieces = template.split("%")
        return F.concat(F.lit(pieces[0]), *(z for part, rest in zip(parts, pieces[1:], strict=True) for z in (part, F.lit(rest))))

    point, outer, hole = at(x, y), ring(x, y, s), ring(x + s / 4, y + s / 4, s / 2)
    far = at(x + 1, y + 2)
    shapes = [
        text('{"type":"Point","coordinates":%}', point),
        text('{"coordinates":[%,%],"type":"LineString"}', point, far),
        text('{"bbox":[0,0,1,1],"type":"Polygon","coordinates":[%,%]}', outer, hole),
        text('{"type":"MultiPoint","crs":{"type":"name"},"coordinates":[%,%]}', far, point),
        text('{"type":"MultiPolygon","coordinates":[[%],[%]]}', outer, hole),
        text('{"geometries":[{"type":"Point","coordinates":%},{"coordinates":[%],"type":"Polygon"}],"type":"GeometryCollection"}', far, outer),
        text('{"bbox":[0,0,1,1],"type":"GeometryCollection","geometries":[{"type":"MultiLineString","coordinates":[[%,%]]}]}', point, far),
        text('{"type":"GeometryCollection","geometries":[{"geometries":[{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":%}]},{"type":"Polygon","coordinates":[%]}],"type":"GeometryCollection"}]}', far, outer),
        F.lit('{"type":"GeometryCollection","geometries":[{"type":"Polygon","coordinates":[]}]}'),
    ]
    chosen = F.lit(None).cast("string")
    for i, shape in reversed(list(enumerate(shapes))):
        chosen = F.when(k % 9 == i, shape).otherwise(chosen)
    return chosen


_C = square_sql("c_custkey")


@query(f"""SELECT c_custkey AS id, c_custkey % 9 <> 8 AS present, [1, 2, 10, 2, 10, 6, 2, 6, 0][c_custkey % 9 + 1] AS n_positions,
CASE WHEN c_custkey % 9 < 8 THEN round({_C['x0']}, 6) END AS x0, CASE WHEN c_custkey % 9 < 8 THEN round({_C['y0']}, 6) END AS y0,
CASE WHEN c_custkey % 9 IN (1, 3, 5, 6, 7) THEN round({_C['x0']} + 1, 6) WHEN c_custkey % 9 = 0 THEN round({_C['x0']}, 6) WHEN c_custkey % 9 < 8 THEN round({_C['x1']}, 6) END AS x1,
CASE WHEN c_custkey % 9 IN (1, 3, 5, 6, 7) THEN round({_C['y0']} + 2, 6) WHEN c_custkey % 9 = 0 THEN round({_C['y0']}, 6) WHEN c_custkey % 9 < 8 THEN round({_C['y1']}, 6) END AS y1,
CASE c_custkey % 9 WHEN 2 THEN round(0.75 * (({_C['x1']} - {_C['x0']}) ** 2), 9) WHEN 4 THEN round(1.25 * (({_C['x1']} - {_C['x0']}) ** 2), 9) WHEN 5 THEN round(({_C['x1']} - {_C['x0']}) ** 2, 9) WHEN 7 THEN round(({_C['x1']} - {_C['x0']}) ** 2, 9) ELSE 0 END AS square_degrees
FROM customer""")
def geometry_kinds(t):
    """All kinds of geometries, in two dimensions and read back: positions, bounds, and the plane area of all rings."""
    raw = spread(t("customer").select(F.col("c_custkey").alias("id"))).select("id", kinds_text(F.col("id")).alias("g"))
    rows = raw.select("id", geo.has_positions(F.col("g")).alias("present"), geo.force_2d(F.col("g")).alias("g"))
    read = rows.select("id", "present", geo.positions(F.col("g")).alias("p"), F.round(geo.planar_area(F.col("g")), 9).alias("square_degrees"))
    boxes = read.select("id", "present", F.size("p").alias("n_positions"), geo.bounds_of(F.col("p")).alias("b"), "square_degrees")
    return boxes.select("id", "present", "n_positions", *rounded_box(F.col("b")), "square_degrees")


# ---------------------------------------------------------------- partitions


@query("SELECT bool_and(regexp_full_match(trim(CAST(o_orderkey AS VARCHAR)), '-?[0-9]+')) AS keys_whole, bool_and(regexp_full_match(trim(o_orderpriority), '-?[0-9]+')) AS priorities_whole FROM orders")
def numeric_key_guard(t):
    return t("orders").agg(all_whole_numbers(F.col("o_orderkey")).alias("keys_whole"), all_whole_numbers(F.col("o_orderpriority")).alias("priorities_whole"))


@query("SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders")
def partition_bounds(t):
    rows = t("orders")
    return rows.sparkSession.createDataFrame([key_bounds(rows, "o_orderkey")], "low bigint, high bigint")


@query("""WITH b AS (SELECT min(o_orderkey) AS low, max(o_orderkey) - min(o_orderkey) + 1 AS n FROM orders)
SELECT CAST(i AS INTEGER) AS part, CAST(low + i * (n // 12) + least(i, n % 12) AS BIGINT) AS low, CAST(low + (i + 1) * (n // 12) + least(i + 1, n % 12) - 1 AS BIGINT) AS high FROM b, (SELECT range AS i FROM range(12))""")
def range_partitions(t):
    rows = t("orders")
    parts = [(i, low, high) for i, (low, high) in enumerate(split_range(*key_bounds(rows, "o_orderkey"), 12))]
    return rows.sparkSession.createDataFrame(parts, "part int, low bigint, high bigint")


@query("SELECT CAST(range AS INTEGER) AS part, true AS balanced, (SELECT count(*) FROM orders) AS n_all FROM range(12)")
def range_partitions_text(t):
    """Ranges of a text key, of numbers that crowd in a hundredth of their range, without a row lost or read twice."""
    crowded = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderkey") * 1000).otherwise(F.col("o_orderkey"))
    rows = t("orders").select(F.concat(F.lit("O'"), F.lpad(F.hex(crowded), 12, "0")).alias("k"))
    conditions = between("k", splitters(rows, "k", 12))
    counts = rows.agg(*(F.count_if(F.expr(c)).alias(f"n{i}") for i, c in enumerate(conditions)), F.count("*").alias("n"))
    each = counts.select(F.posexplode(F.array(*(f"n{i}" for i in range(len(conditions))))).alias("part", "held"), F.expr("+".join(f"n{i}" for i in range(len(conditions)))).alias("n_all"), "n")
    return each.select("part", ((F.col("held") * 24 >= F.col("n")) & (F.col("held") * 6 <= F.col("n"))).alias("balanced"), "n_all")


# ---------------------------------------------------------------- key figures and state


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS area_of_interest_id, CAST(round(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) * CAST(0.0001 AS DECIMAL(5,4)), 3) AS DECIMAL(18,3))::VARCHAR AS value
FROM lineitem GROUP BY 1""")
def kpi_theme_sum(t):
    rows = t("lineitem").select(F.col("l_orderkey").alias("area_of_interest_id"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("m2"))
    return kpi.summed(rows, "prices", "ha").select("area_of_interest_id", F.col("value").cast("string").alias("value"))


@query("""WITH v AS (SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(26,9)) AS d FROM orders)
SELECT id, CAST(round(d, 3) AS DECIMAL(18,3))::VARCHAR AS m2, CAST(round(d * 0.0001, 3) AS DECIMAL(18,3))::VARCHAR AS ha, CAST(round(d * 0.000001, 3) AS DECIMAL(18,3))::VARCHAR AS km2 FROM v""")
def kpi_units(t):
    m2 = F.col("o_totalprice")
    return t("orders").select(F.col("o_orderkey").alias("id"), *(area_in(m2, u).cast("string").alias(n) for u, n in (("m²", "m2"), ("ha", "ha"), ("km²", "km2"))))


@query("""SELECT c_custkey AS id, CASE WHEN c_nationkey < 12 THEN CAST(round(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(26,9)), 3) AS DECIMAL(18,3)) ELSE CAST(7 AS DECIMAL(18,3)) END::VARCHAR AS area FROM customer""")
def kpi_area_update(t):
    business = t("customer").select(F.col("c_custkey").alias("id"), F.lit("7").cast("decimal(18,3)").alias("area"))
    measured = t("customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("id"), area_in(F.col("c_acctbal"), "m²").alias("area"))
    return kpi.with_areas(business, measured).select("id", F.col("area").cast("string").alias("area"))


@query(f"""SELECT CAST(user_id AS VARCHAR) AS area_of_interest_id, CAST(round(sum(CAST(m2 AS DECIMAL(26,9))) / 10000, 3) AS DECIMAL(18,3))::VARCHAR AS value, 'user-events' AS kpi_name
FROM ({squares_sql('event_id', 'events', 'user_id')}) WHERE user_id IS NOT NULL GROUP BY user_id""")
def kpi_theme_geodesic(t):
    features = spread(t("events").select("user_id", "event_id")).select(F.col("user_id").alias("area_of_interest_id"), square_text(F.col("event_id")).alias("geom"))
    return kpi.theme(features, "user-events", "ha").select("area_of_interest_id", F.col("value").cast("string").alias("value"), "kpi_name")


@query("""SELECT r_name AS sync_key, 'dsp.' || lower(r_name) AS source_table, CASE WHEN r_regionkey = 2 THEN '2001-06-02 00:00:00' WHEN r_regionkey % 2 = 0 THEN '2000-01-01 00:00:00' END AS watermark,
CASE WHEN r_regionkey = 2 THEN '2001-07-01 00:00:00' END AS orphan_check FROM region""")
def sync_state_upsert(t):
    old = F.when(F.col("r_regionkey") % 2 == 0, F.lit("2000-01-01")).cast("timestamp")
    rows = t("region").select(F.col("r_name").alias("sync_key"), F.concat(F.lit("dsp."), F.lower("r_name")).alias("source_table"), old.alias("watermark_last_event_at"))
    known = rows.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(states.SCHEMA).fields[3:]))
    name = t("region").where("r_regionkey = 2").first().r_name
    now = datetime(2001, 7, 1, tzinfo=UTC)
    known = states.advance(known, name, f"dsp.{name.lower()}", datetime(2001, 6, 2, tzinfo=UTC), 1, now)
    known = states.mark_orphan_check(known, name, f"dsp.{name.lower()}", now)
    return known.select("sync_key", "source_table", stamp("watermark_last_event_at").alias("watermark"), stamp("last_orphan_check_at").alias("orphan_check"))
