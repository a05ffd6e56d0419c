"""PostGIS as a source and as a target of jobs.

Geometries leave the database as GeoJSON in a subquery, since Spark can't push down functions it doesn't
know; column pruning and all other conditions are pushed into that subquery by Spark itself.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from ..functions.geometry import check_srid
from ..functions.ids import TableName
from ..plans import ddl
from ..plans.config import Settings
from ..functions.temporal import ContractError
from ..plans.contract import BOX, CENTROID, Contract, has_higher_dimensions
from . import jdbc

log = logging.getLogger(__name__)


def properties(store: dict) -> dict[str, str]:
    return {"driver": "org.postgresql.Driver"} | {k: str(store[v]) for k, v in (("user", "username"), ("password", "password"), ("driver", "driver-class-name")) if store.get(v)}


def conditions_of(settings: Settings) -> dict[str, str]:
    """Of each configured source table: the adopter's condition, in the database's own language; blank and 1=1 say nothing."""
    every = [*settings.admin_units.values(), *([settings.area_of_interest] if settings.area_of_interest else []), *settings.layers]
    return {x.source_table: text for x in every if (text := (x.where_clause or "").strip()) not in ("", "1=1")}


def geometry_as_json(table: TableName, columns: list[str], geometry: str, srid: int, condition: str | None = None) -> str:
    """A subquery with the table's columns, its geometry as two-dimensional GeoJSON in srid; empty ones left out.

    The condition is the database's, over the table as it is, geometry included.
    """
    g = ddl.quoted(geometry)
    shown = [ddl.quoted(c) for c in columns if c != geometry]
    shown.append(f"ST_AsGeoJSON(ST_Force2D(ST_Transform({g}, {check_srid(srid)})))::text AS {g}")
    return f"(SELECT {', '.join(shown)} FROM {ddl.quoted(table.schema, table.table)} WHERE {g} IS NOT NULL AND NOT ST_IsEmpty(ST_MakeValid({g})){f' AND ({condition})' if condition else ''}) AS src"


def tables_of(settings: Settings) -> dict[str, tuple[str, str, int | None, str]]:
    """Of each configured source table: its geometry, key to split reads by, SRID (if configured), and job name."""
    out = {u.source_table: (u.geometry_column, u.partition_column or u.primary_key, u.srid, f"admin-unit-level-{n}-geoserver-job") for n, u in settings.admin_units.items()}
    if area := settings.area_of_interest:
        out[area.source_table] = (area.geometry_column, area.primary_key, area.srid, "area-of-interest-geoserver-job")
    return out | {x.source_table: (x.geometry_column, x.primary_key, x.srid, "layer-jobs") for x in settings.layers}


def describe(ask: Callable[[str], list[Row]], table: TableName, geometry: str) -> dict:
    """What the source's catalog says of a geometry and its table: srid, geometry_type and indexes (name, definition).

    ask gives the rows of a subquery. A system that isn't registered is taken from one row. Indexes of primary
    keys are left out.
    """

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    found: dict = {}
    where = f"f_table_schema = {text(table.schema)} AND f_table_name = {text(table.table)} AND f_geometry_column = {text(geometry)}"
    for r in ask(f"(SELECT srid, type, coord_dimension FROM geometry_columns WHERE {where}) AS g")[:1]:
        found = {"geometry_type": r.type} | ({"srid": r.srid} if r.srid else {})
        if has_higher_dimensions(r.type, r.coord_dimension or 2):
            log.warning("%s.%s is of type %s in %s dimensions; only two are copied", table, geometry, r.type, r.coord_dimension)
    if "srid" not in found:
        g = ddl.quoted(geometry)
        for r in ask(f"(SELECT ST_SRID({g}) AS srid FROM {ddl.quoted(table.schema, table.table)} WHERE {g} IS NOT NULL LIMIT 1) AS s"):
            found |= {"srid": r.srid} if r.srid else {}
    indexes = ask(f"(SELECT indexname, indexdef FROM pg_indexes WHERE schemaname = {text(table.schema)} AND tablename = {text(table.table)}) AS i")
    return found | {"indexes": [[r.indexname, r.indexdef] for r in indexes if not r.indexname.endswith("_pkey")]}


def bounds_known(ask: Callable[[str], list[Row]], table: TableName, key: str) -> list[str]:
    """What the catalog's statistics know of a key's distribution: bounds of ranges with equally many rows, as text, in the database's order."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    found = ask(f"(SELECT unnest(histogram_bounds::text::text[]) AS bound FROM pg_stats WHERE schemaname = {text(table.schema)} AND tablename = {text(table.table)} AND attname = {text(key)}) AS h")
    return [r.bound for r in found]


def key_conditions(ask: Callable[[str], list[Row]], keys: DataFrame, table: TableName, key: str, ranges: int) -> list[str]:
    """Conditions that read a table in so many ranges of its key (keys has it as k).

    Where the catalog knows the key's distribution, by that, in the database's own order; numbers else in ranges of equal width, and
    texts by a sample of the keys, in the order of their bytes.
    """
    number = isinstance(keys.schema["k"].dataType, T.NumericType)
    quoted = ddl.quoted(key)
    if len(known := bounds_known(ask, table, key)) > ranges:
        cuts = [known[len(known) * i // ranges] for i in range(1, ranges)]
        return jdbc.between(quoted, list(dict.fromkeys(cuts)), text=not number)
    low, high = jdbc.key_bounds(keys, "k")
    if low is not None:
        return jdbc.range_predicates(quoted, jdbc.split_range(low, high, ranges))
    return jdbc.between(f'{quoted} COLLATE "C"', jdbc.splitters(keys, "k", ranges))


def reader(spark: SparkSession, settings: Settings) -> Callable[[str], DataFrame]:
    """The source of an Engine: tables of the source database, read in ranges of their keys.

    Geometries come in the configured system, else in the one of the column or of a row; that, the type and the
    table's indexes are metadata of the geometry.
    """
    store = settings.stores["source"]
    url, props, known = store["url"], properties(store), tables_of(settings)
    conditions = conditions_of(settings)

    def read(name: str) -> DataFrame:
        geometry, key, srid, job = known[name]
        table, parallel = TableName.parse(name), settings.parallel_for(job)
        catalog = f"(SELECT column_name FROM information_schema.columns WHERE table_schema = '{table.schema}' AND table_name = '{table.table}' ORDER BY ordinal_position) AS c"
        columns = [r.column_name for r in spark.read.jdbc(url, catalog, properties=props).collect()]
        said = describe(lambda q: spark.read.jdbc(url, q, properties=props).collect(), table, geometry)
        srid = srid or said.get("srid")
        if not srid:
            raise ContractError(f"no SRID is known for {geometry!r} of {name}; set srid")
        condition = conditions.get(name)
        query = geometry_as_json(table, columns, geometry, srid, condition)
        predicates = None
        if parallel.ranges > 1:
            ask = lambda q: spark.read.jdbc(url, q, properties=props).collect()
            predicates = key_conditions(ask, spark.read.jdbc(url, f"(SELECT {ddl.quoted(key)} AS k FROM {ddl.quoted(table.schema, table.table)}) AS b", properties=props), table, key, parallel.ranges)
        said |= {"srid": srid} | ({"adopter": condition} if condition else {})
        return jdbc.read_table(spark, url, query, properties=props, fetch_size=parallel.page_size, predicates=predicates).withMetadata(geometry, said)

    return read


def writer(spark: SparkSession, settings: Settings, execute=jdbc.execute, stage=jdbc.stage_rows) -> Callable:
    """The sink of an Engine: upserts and deletes in the business and geometry databases, in this order.

    Rows are written to a staging table by the executors; one statement then moves them into the target.
    """

    def apply(contract: Contract, schema: T.StructType, delta: DataFrame, gone: DataFrame | None) -> None:
        for name, business in (("target", True), ("geo-target", False)):
            if business and not contract.business:
                continue
            store = settings.stores[name]
            url, props = store["url"], properties(store)
            rows = contract.for_business(delta) if business else delta
            shapes = (BOX, CENTROID) if business else (contract.geometry_target,)
            execute(spark, url, ddl.create_table(contract, schema, business), props)
            staging = f"{contract.target.schema}.staging_{uuid.uuid4().hex}"
            stage(rows, url, staging, props)
            statements = [ddl.upsert_from(contract, staging, rows.columns, shapes), f"DROP TABLE {staging}"]
            if gone is not None:
                listing = f"{contract.target.schema}.listing_{uuid.uuid4().hex}"
                stage(gone.select("nid").distinct(), url, listing, props)
                statements += [ddl.delete_listed(contract, listing), f"DROP TABLE {listing}"]
            execute(spark, url, statements, props)

    return apply


def kpi_writer(spark: SparkSession, settings: Settings, execute=jdbc.execute, stage=jdbc.stage_rows) -> Callable:
    """The sink of key figures of an Engine: areas and measures in the business database, in one transaction."""

    def apply(areas: DataFrame, measures: DataFrame) -> None:
        store = settings.stores["target"]
        url, props = store["url"], properties(store)
        table = TableName.parse(settings.area_of_interest.target_table if settings.area_of_interest else "dsp.area_of_interest")
        name, statements = ddl.quoted(table.schema, table.table), []
        execute(spark, url, ddl.create_kpi_table(name), props)
        for rows, moved in ((areas, lambda s: [ddl.update_areas(name, s)]), (measures, ddl.refresh_kpis)):
            staging = f"{table.schema}.staging_{uuid.uuid4().hex}"
            stage(rows, url, staging, props)
            statements += [*moved(staging), f"DROP TABLE {staging}"]
        execute(spark, url, statements, props)

    return apply


def recorder(spark: SparkSession, settings: Settings, execute=jdbc.execute, stage=jdbc.stage_rows) -> Callable:
    """Takes an Engine's flags to the business database, in one transaction, and its sync state to the batch database.

    Without a batch database of its own the state goes to the business database. The state comes last, so a run
    that fails before is done again.
    """

    def apply(flags: dict[str, tuple[str, DataFrame]], state: DataFrame) -> None:
        store = settings.stores["target"]
        statements = []
        for name, (key, ids) in flags.items():
            table = TableName.parse(name)
            listing = f"{table.schema}.listing_{uuid.uuid4().hex}"
            stage(ids.select("nid").distinct(), store["url"], listing, properties(store))
            statements += [ddl.flag_listed(ddl.quoted(table.schema, table.table), key, listing), f"DROP TABLE {listing}"]
        if statements:
            execute(spark, store["url"], statements, properties(store))
        store = settings.stores.get("batch", store)
        execute(spark, store["url"], ddl.create_state_table(), properties(store))
        staging = f"{ddl.STATE_TABLE[0]}.staging_{uuid.uuid4().hex}"
        stage(state, store["url"], staging, properties(store))
        execute(spark, store["url"], [ddl.upsert_state(staging, state.columns), f"DROP TABLE {staging}"], properties(store))

    return apply
