"""Statements for a PostgreSQL target: schema, table, indexes, and the upsert from a staging table."""

from __future__ import annotations

from pyspark.sql import types as T

from ..operators.territory import FLAG
from .contract import BOX, CENTROID, Contract, Index

#: Lengths of the text columns that every target has.
TEXT_LENGTHS = {"id": 255, "area_of_interest_id": 255, "territory_level_3_id": 64}
#: The table of measures, its constraint and its indexes.
KPI_TABLE, KPI_UNIQUE, KPI_INDEXES = ("dsp", "kpi_measure"), "uq_kpi_measure_aoi_name", {"idx_kpi_measure_aoi_id": "area_of_interest_id", "idx_kpi_measure_name": "kpi_name"}
#: The table of sync states.
STATE_TABLE = ("data_migration", "batch_job_execution_sync_state")
_NAMES = {T.ShortType: "smallint", T.IntegerType: "integer", T.LongType: "bigint", T.BooleanType: "boolean", T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamptz", T.DoubleType: "double precision", T.FloatType: "real"}


def quoted(*parts: str) -> str:
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts)


def column_type(kind: T.DataType) -> str:
    if isinstance(kind, T.VarcharType | T.CharType):
        return f"varchar({kind.length})"
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision})" if not kind.scale else f"numeric({kind.precision},{kind.scale})"
    return _NAMES.get(type(kind), "text")


def table_columns(contract: Contract, source: T.StructType, business: bool) -> dict[str, str]:
    """Names and types of a target table's columns. The attribute store has box and centroid for the geometry."""
    events = {e.name for e in (contract.created, contract.updated) if e}
    out: dict[str, str] = {}
    for name, target in contract.columns:
        if name in events:
            out.setdefault(target, "timestamptz")
        elif target in contract.as_text:
            out.setdefault(target, f"varchar({TEXT_LENGTHS.get(target, 255)})")
        else:
            out.setdefault(target, column_type(source[name].dataType))
    if not business:
        return out | {contract.geometry_target: f"geometry(Geometry, {contract.srid})"}
    if contract.regenerates == 0:
        out.setdefault("area", "numeric")
        out.setdefault("updated_at", "timestamptz")
    return out | {BOX: f"geometry(Polygon, {contract.srid})", CENTROID: f"geometry(Point, {contract.srid})"}


def create_table(contract: Contract, source: T.StructType, business: bool = False) -> list[str]:
    name = quoted(contract.target.schema, contract.target.table)
    columns = [f"{quoted(c)} {t}" for c, t in table_columns(contract, source, business).items()]
    made = [f"CREATE SCHEMA IF NOT EXISTS {quoted(contract.target.schema)}", f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}, PRIMARY KEY ({quoted(contract.key)}))"]
    if business:
        table = contract.target.table
        return made + [create_index(contract, Index(f"{table}_business_{c}", (c,))) for c in ("created_at", "updated_at")]
    return made + [create_index(contract, i) for i in contract.target_indexes()]


def create_index(contract: Contract, index: Index) -> str:
    kind = "UNIQUE INDEX" if index.unique else "INDEX"
    on = quoted(contract.target.schema, contract.target.table)
    return f"CREATE {kind} IF NOT EXISTS {quoted(index.name)} ON {on} USING {index.method.upper()} ({', '.join(map(quoted, index.columns))})"


def upsert_from(contract: Contract, staging: str, columns: list[str], geometries: tuple[str, ...]) -> str:
    """Rows of a staging table into the target; geometries are GeoJSON text there. Other columns are left alone."""
    values = [f"ST_SetSRID(ST_Force2D(ST_GeomFromGeoJSON({quoted(c)})), {contract.srid})" if c in geometries else quoted(c) for c in columns]
    rest = [f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in columns if c != contract.key]
    target = quoted(contract.target.schema, contract.target.table)
    action = f"UPDATE SET {', '.join(rest)}" if rest else "NOTHING"
    return f"INSERT INTO {target} ({', '.join(map(quoted, columns))}) SELECT {', '.join(values)} FROM {staging} ON CONFLICT ({quoted(contract.key)}) DO {action}"


def delete_listed(contract: Contract, listing: str) -> str:
    """Deletes the rows whose key, as text, a staging table lists (nid)."""
    target = quoted(contract.target.schema, contract.target.table)
    return f"DELETE FROM {target} WHERE trim({quoted(contract.key)}::text) IN (SELECT nid FROM {listing})"


def create_kpi_table(areas: str) -> list[str]:
    """The table of measures, which belong to areas of interest (a quoted table), and its two indexes."""
    name = quoted(*KPI_TABLE)
    columns = [
        "id BIGSERIAL PRIMARY KEY",
        f"area_of_interest_id varchar({TEXT_LENGTHS['area_of_interest_id']}) NOT NULL REFERENCES {areas} (id)",
        "value numeric(18,3) NOT NULL",
        "kpi_name varchar(255) NOT NULL",
        f"CONSTRAINT {KPI_UNIQUE} UNIQUE (area_of_interest_id, kpi_name)",
    ]
    made = [f"CREATE SCHEMA IF NOT EXISTS {quoted(KPI_TABLE[0])}", f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)})"]
    return made + [f"CREATE INDEX IF NOT EXISTS {i} ON {name} ({c})" for i, c in KPI_INDEXES.items()]


def refresh_kpis(staging: str) -> list[str]:
    """All measures anew from a staging table, also where it is empty."""
    columns = "area_of_interest_id, value, kpi_name"
    return [f"TRUNCATE TABLE {quoted(*KPI_TABLE)}", f"INSERT INTO {quoted(*KPI_TABLE)} ({columns}) SELECT {columns} FROM {staging}"]


def update_areas(areas: str, staging: str) -> str:
    """Measured areas (id, area) of a staging table into the areas of interest; others keep theirs."""
    return f"UPDATE {areas} AS t SET area = s.area FROM {staging} AS s WHERE t.id::text = s.id::text"


def create_state_table() -> list[str]:
    columns = [
        "sync_key varchar(255) PRIMARY KEY",
        "source_table varchar(255)",
        "watermark_last_event_at timestamptz",
        "last_success_at timestamptz",
        "last_job_execution_id bigint",
        "last_orphan_check_at timestamptz",
        "updated_at timestamptz",
    ]
    return [f"CREATE SCHEMA IF NOT EXISTS {quoted(STATE_TABLE[0])}", f"CREATE TABLE IF NOT EXISTS {quoted(*STATE_TABLE)} ({', '.join(columns)})"]


def upsert_state(staging: str, columns: list[str]) -> str:
    """Whole rows of sync states, which already keep what a run didn't say."""
    names, rest = ", ".join(columns), ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != "sync_key")
    return f"INSERT INTO {quoted(*STATE_TABLE)} ({names}) SELECT {names} FROM {staging} ON CONFLICT (sync_key) DO UPDATE SET {rest}"


def flag_listed(table: str, key: str, listing: str) -> str:
    """Sets the regeneration flag of the rows of a quoted table whose key, as text, a staging table lists (nid)."""
    return f"UPDATE {table} SET {FLAG} = TRUE WHERE trim({quoted(key)}::text) IN (SELECT nid FROM {listing})"
