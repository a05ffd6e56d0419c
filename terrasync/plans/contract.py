"""Table contracts: which source columns are copied, under which names and types.

A contract is settled once, on the driver, from a configuration block and the source's schema; it then is
one select. Column names are compared exactly, also where Spark would not tell them apart by case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions.ids import TableName, normal_id, safe_name
from ..functions.temporal import ContractError, EventColumn, Temporal, change_filter, classify, last_event
from .config import AdminUnit, AreaOfInterest, Layer, Settings

BOX, CENTROID = "boundary_box", "centroid_coordinates"


@dataclass(frozen=True)
class Index:
    name: str
    columns: tuple[str, ...]
    method: str = "btree"
    unique: bool = False

    @classmethod
    def parse(cls, name: str, definition: str) -> Index:
        """From the text PostgreSQL keeps of an index."""
        upper = definition.upper()
        method = next((m for m in ("gist", "gin") if f"USING {m.upper()}" in upper), "btree")
        inner = re.search(r"\((.*)\)", definition, re.S)
        columns = tuple(c.strip().removeprefix('"').removesuffix('"') for c in inner[1].split(",") if c.strip()) if inner else ()
        return cls(name, columns, method, "UNIQUE INDEX" in upper)


@dataclass(frozen=True)
class Contract:
    """What a job copies from where to where."""

    sync_key: str
    source: TableName
    target: TableName
    primary_key: str  # as the source calls it
    created: EventColumn
    updated: EventColumn | None
    geometry: str
    srid: int
    columns: tuple[tuple[str, str], ...]  # (source, target), in target order, without the geometry
    geometry_target: str = "geom"
    where: str | None = None
    source_srid: int | None = None
    parent: str | None = None  # target column that names the row's parent
    business: bool = True  # whether the attribute store has the table too
    as_text: frozenset = frozenset()  # target columns that are text whatever the source has
    indexes: tuple[Index, ...] = ()
    regenerates: int | None = None  # level of territories whose files depend on this table; 0: areas of interest

    @property
    def key(self) -> str:
        return dict(self.columns)[self.primary_key]

    # ---- as columns of the source

    def selected(self, mark) -> Column:
        """Rows to copy: with a geometry, meeting the adopter's condition, changed since the mark."""
        # The cheapest condition first; the geometry's text is looked at only where the others hold.
        return where_all(change_filter(self.created, self.updated, mark), adopter(self.where), geo.has_positions(F.col(self.geometry)))

    def changed(self, mark) -> Column:
        """selected, with or without a geometry."""
        return where_all(change_filter(self.created, self.updated, mark), adopter(self.where))

    def present(self) -> Column:
        """Rows that should be in the target, changed or not."""
        return where_all(adopter(self.where), geo.has_positions(F.col(self.geometry)))

    def last_event(self) -> Column:
        return last_event(self.created, self.updated)

    def projection(self, schema: T.StructType) -> list[Column]:
        """The copied columns under their target names and types; the geometry as two-dimensional GeoJSON."""
        events = {e.name: e for e in (self.created, self.updated) if e is not None}
        out = []
        for source, target in self.columns:
            c = F.col(f"`{source}`")
            if source in events:
                c = events[source].instant()
            elif target in self.as_text:
                c = normal_id(c, schema[source].dataType)
            out.append(c.alias(target))
        g = F.col(f"`{self.geometry}`")
        return [*out, geo.transform(g, self.source_srid or self.srid, self.srid).alias(self.geometry_target)]

    def scan(self, source: DataFrame, mark) -> DataFrame:
        return source.where(self.selected(mark)).select(*self.projection(source.schema))

    # ---- as columns of the targets

    def for_business(self, rows: DataFrame) -> DataFrame:
        """Attributes, bounding box and centroid, without the geometry itself."""
        g = F.col(self.geometry_target)
        return rows.withColumn(BOX, geo.envelope(g)).withColumn(CENTROID, geo.centroid(g)).drop(self.geometry_target)

    def target_indexes(self) -> list[Index]:
        """The target's indexes: the canonical ones, and those of the source whose columns are copied.

        An index on one column that a canonical one serves already is left out.
        """
        table, names = self.target.table, {t for _, t in self.columns}
        own = [Index(f"{table}_geom_gist", (self.geometry_target,), "gist")]
        own += [Index(f"{table}_{short}", (c,)) for c, short in (("area_of_interest_id", "aoi_id"), ("created_at", "created_at"), ("updated_at", "updated_at")) if c in names]
        rename = dict(self.columns) | {self.geometry: self.geometry_target}
        served = {i.columns[0] for i in own[1:]}
        for i in self.indexes:
            mapped = tuple(rename.get(c, "") for c in i.columns)
            if not mapped or "" in mapped:
                continue
            if len(mapped) == 1 and (mapped[0] in served or (mapped[0] == self.geometry_target and i.method == "gist")):
                continue
            own.append(Index(safe_name(f"{table}_{i.name}"), mapped, i.method, i.unique))
        return own


def adopter(text: str | None) -> Column | None:
    """The adopter's condition; blank and 1=1 say nothing."""
    text = (text or "").strip()
    return None if text in ("", "1=1") else F.expr(f"({text})")


def where_all(*conditions: Column | None) -> Column | None:
    """All conditions together; none given: none."""
    out = None
    for c in conditions:
        if c is not None:
            out = c if out is None else out & c
    return out


# ---------------------------------------------------------------- types

#: PostgreSQL's types and what a target table has for them.
TARGET_TYPES = {
    "int2": "smallint",
    "int4": "integer",
    "int8": "bigint",
    "bool": "boolean",
    "float8": "double precision",
    "float4": "real",
}
#: Their Spark types, other names being carried as text.
SPARK_TYPES = {
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp",
    "float8": "double",
    "float4": "float",
}


def target_type(udt: str, length: int | None = None, precision: int | None = None, scale: int | None = None) -> str | None:
    """The type of a target column for a source column of PostgreSQL type udt; a geometry has none."""
    if udt in ("geometry", "geography"):
        return None
    if udt in ("varchar", "bpchar"):
        return f"varchar({length})" if length is not None else "varchar"
    if udt == "numeric":
        return "numeric" if precision is None else f"numeric({precision})" if not scale else f"numeric({precision},{scale})"
    return TARGET_TYPES.get(udt, udt)


def spark_type(udt: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """The Spark type of a PostgreSQL type; numbers without a precision get decimal(38,10)."""
    if udt == "numeric":
        return T.DecimalType(38, 10) if precision is None else T.DecimalType(precision, scale or 0)
    return T.DataType.fromDDL(SPARK_TYPES.get(udt, "string"))


# ---------------------------------------------------------------- settling


def _has(schema: T.StructType, name: str, what: str) -> str:
    name = name.strip()
    if name not in schema.fieldNames():
        raise ContractError(f"{what}: the source has no column {name!r}")
    return name


def _whatever_case(schema: T.StructType, name: str, what: str) -> str:
    """The source's name of a column: the same one, else the only one that differs in case alone."""
    alike = [n for n in schema.fieldNames() if n.lower() == name.lower()]
    if name in alike or not alike:
        return name
    if len(alike) > 1:
        raise ContractError(f"{what}: the source has {', '.join(map(repr, alike))} for {name!r}")
    return alike[0]


def _event(schema: T.StructType, name: str, what: str, zone: str | None) -> EventColumn | None:
    if not (name or "").strip():
        return None
    name = _has(schema, _whatever_case(schema, name.strip(), what), what)
    kind = classify(schema[name].dataType)
    return EventColumn(name, kind, zone if kind.needs_zone else None)


def _still(schema: T.StructType, geometry: str, text: str | None) -> str | None:
    """The adopter's condition, unless the source has met it already (metadata of the geometry): a database does, in its own language."""
    said = schema[geometry].metadata.get("adopter")
    return None if said is not None and said == (text or "").strip() else text


def _geometry(schema: T.StructType, name: str) -> str:
    name = _has(schema, name, "geometry-column")
    if not isinstance(schema[name].dataType, T.StringType):
        raise ContractError(f"geometry-column {name!r} isn't GeoJSON text")
    return name


def _srid(schema: T.StructType, geometry: str, configured: int | None, sample: int | None = None) -> int:
    """The configured system, else the one registered with the column, else a sampled row's."""
    for found in (configured, schema[geometry].metadata.get("srid"), sample):
        if found:
            return geo.check_srid(found)
    raise ContractError(f"no SRID is known for {geometry!r}; set srid")


def _indexes(schema: T.StructType, geometry: str, copied: list[tuple[str, str]], given: tuple[Index, ...]) -> tuple[Index, ...]:
    """The given indexes, else those the source's catalog says (metadata of the geometry), whose columns are all copied."""
    known = given or tuple(Index.parse(*x) for x in schema[geometry].metadata.get("indexes", ()))
    return tuple(i for i in known if i.columns and set(i.columns) <= {s for s, _ in copied} | {geometry})


def layer_contract(layer: Layer, schema: T.StructType, settings: Settings | None = None, indexes: tuple[Index, ...] = (), sample_srid: int | None = None) -> Contract:
    layer.check()
    zone = (settings or Settings()).zone(layer.source_timezone)
    pk = _has(schema, layer.primary_key, "primary-key")
    aoi = _has(schema, layer.area_of_interest_id_column, "area-of-interest-id-column")
    created = _event(schema, layer.creation_date_column, "creation-date-column", zone)
    updated = _event(schema, layer.updated_at_column, "updated-at-column", zone)
    label = _has(schema, layer.label_column, "label-column") if layer.label_column.strip() else None
    geometry = _geometry(schema, layer.geometry_column)
    for extra in layer.additional_columns:
        _has(schema, extra, "additional-columns")
        if classify(schema[extra].dataType) is Temporal.INTERVAL:
            raise ContractError(f"additional-columns: {extra!r} is an interval")
    pairs = [(pk, "id"), (aoi, "area_of_interest_id"), (created.name, "created_at")]
    pairs += [(updated.name, "updated_at")] if updated else []
    pairs += [(label, "label")] if label else []
    pairs += [(x, x) for x in layer.additional_columns]
    return Contract(
        layer.sync_key,
        TableName.parse(layer.source_table),
        TableName.parse(layer.target_table),
        pk,
        created,
        updated,
        geometry,
        _srid(schema, geometry, layer.srid, sample_srid),
        _first_wins(pairs),
        where=_still(schema, geometry, layer.where_clause),
        source_srid=schema[geometry].metadata.get("srid"),
        business=False,
        as_text=frozenset({"id", "area_of_interest_id"}),
        indexes=_indexes(schema, geometry, pairs, indexes),
    )


def area_contract(area: AreaOfInterest, schema: T.StructType, settings: Settings | None = None, indexes: tuple[Index, ...] = ()) -> Contract:
    area.check()
    zone = (settings or Settings()).zone(area.source_timezone)
    pk = _has(schema, area.primary_key, "primary-key")
    created = _event(schema, area.creation_date_column, "creation-date-column", zone)
    updated = _event(schema, area.updated_at_column, "updated-at-column", zone)
    level3 = _has(schema, area.territory_level_3_column, "territory-level-3-column")
    geometry = _geometry(schema, area.geometry_column)
    pairs = [(pk, "id"), (created.name, "created_at")]
    pairs += [(updated.name, "updated_at")] if updated else []
    pairs += [(level3, "territory_level_3_id")]
    pairs += [(_has(schema, area.total_area_column, "total-area-column"), "area")] if area.total_area_column.strip() else []
    pairs += [(_has(schema, x, "additional-columns"), x) for x in area.additional_columns]
    return Contract(
        area.sync_key,
        TableName.parse(area.source_table),
        TableName.parse(area.target_table),
        pk,
        created,
        updated,
        geometry,
        geo.check_srid(area.srid),
        _first_wins(pairs),
        where=_still(schema, geometry, area.where_clause),
        source_srid=schema[geometry].metadata.get("srid"),
        parent="territory_level_3_id",
        as_text=frozenset({"id", "territory_level_3_id"}),
        indexes=_indexes(schema, geometry, pairs, indexes),
        regenerates=0,
    )


def unit_contract(unit: AdminUnit, schema: T.StructType, settings: Settings | None = None) -> Contract:
    unit.check()
    zone = (settings or Settings()).zone(unit.source_timezone)
    created = _event(schema, unit.creation_date_column, "creation-date-column", zone)
    updated = _event(schema, unit.updated_at_column, "updated-at-column", zone)
    pk = _has(schema, unit.primary_key, "primary-key")
    geometry = _geometry(schema, unit.geometry_column)
    events = [e.name for e in (created, updated) if e]
    named = [pk, *(x for x in unit.persist_columns if x != geometry), *events]
    pairs = [(_has(schema, x, "persist-columns"), unit.column_mapping.get(x, x)) for x in named]
    return Contract(
        unit.sync_key,
        TableName.parse(unit.source_table),
        TableName.parse(unit.target_table),
        pk,
        created,
        updated,
        geometry,
        geo.check_srid(unit.srid),
        _first_wins(pairs),
        geometry_target=unit.column_mapping.get(geometry, geometry),
        where=_still(schema, geometry, unit.where_clause),
        source_srid=schema[geometry].metadata.get("srid"),
        as_text=frozenset({unit.column_mapping.get(pk, pk)}),
        regenerates=unit.level if unit.level > 1 else None,
    )


def _first_wins(pairs: list[tuple[str, str]]) -> tuple[tuple[str, str], ...]:
    """Each source column once, under the first name given to it."""
    out: dict[str, str] = {}
    for source, target in pairs:
        out.setdefault(source, target)
    return tuple(out.items())


def check_existing(contract: Contract, schema: T.StructType | None) -> None:
    """An existing target keeps created_at as an instant; it is never altered."""
    if schema is None:
        return
    created = dict(contract.columns)[contract.created.name]
    if created not in schema.fieldNames():
        raise ContractError(f"{contract.target} exists without a column {created!r}")
    if classify(schema[created].dataType) is not Temporal.TIMESTAMPTZ:
        raise ContractError(f"{created!r} of {contract.target} must be an instant, not {schema[created].dataType.simpleString()}")


def has_higher_dimensions(kind: str, dimensions: int = 2) -> bool:
    """Whether a geometry type, or the number of its ordinates, has a Z or M that a copy drops."""
    return dimensions > 2 or (kind or "").upper().endswith(("Z", "M"))
