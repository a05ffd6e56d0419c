"""The declarative configuration: YAML blocks as dataclasses, checked as a whole before anything runs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from ..functions.geometry import check_srid
from ..functions.ids import TableName
from ..functions.temporal import ContractError, resolve_zone
from ..functions.units import unit_factor

#: Names of the target tables that fixed jobs own, and of the columns every target has.
RESERVED_TABLES = ("territory_level_1", "territory_level_2", "territory_level_3", "area_of_interest")
TARGET_SCHEMA = "dsp"
LAYER_COLUMNS = ("id", "area_of_interest_id", "created_at", "updated_at", "label", "geom")
AREA_COLUMNS = ("id", "created_at", "updated_at", "territory_level_3_id", "area", "geom")


def _snake(block: Mapping) -> dict:
    return {str(k).replace("-", "_"): v for k, v in block.items()}


def _from(cls, block: Mapping):
    """Keys that the class doesn't know are ignored."""
    known = {f.name for f in fields(cls)}
    return cls(**{k: v for k, v in _snake(block).items() if k in known and v is not None})


def _required(where: str, owner, *names: str) -> None:
    for n in names:
        if not str(getattr(owner, n) or "").strip():
            raise ContractError(f"{where}: {n.replace('_', '-')} is required")


def _extras(where: str, extras, taken: tuple, canonical: tuple, fold: bool) -> tuple[str, ...]:
    seen: list[str] = []
    for raw in extras or ():
        name = (raw or "").strip()
        if not name:
            raise ContractError(f"{where}: additional-columns has a blank entry")
        if name in seen:
            raise ContractError(f"{where}: additional-columns has {name!r} twice")
        if name in taken:
            raise ContractError(f"{where}: additional-columns entry {name!r} is mapped already")
        if (name.lower() if fold else name) in canonical:
            raise ContractError(f"{where}: additional-columns entry {name!r} is the name of a target column")
        seen.append(name)
    return tuple(seen)


@dataclass
class AdminUnit:
    """One level of administrative units, copied to both stores."""

    level: int = 1
    source_table: str = ""
    target_table: str = ""
    primary_key: str = ""
    partition_column: str = ""
    geometry_column: str = ""
    where_clause: str = "1=1"
    persist_columns: list = field(default_factory=list)
    layer_name: str = ""
    column_mapping: dict = field(default_factory=dict)
    srid: int | None = None
    creation_date_column: str = ""
    updated_at_column: str = ""
    source_timezone: str = ""
    sync_key: str = ""

    def check(self) -> AdminUnit:
        where = f"batch.admin-unit.level-{self.level}"
        self.sync_key = self.sync_key or f"admin_unit_level_{self.level}"
        self.partition_column = self.partition_column or self.primary_key
        _required(where, self, "source_table", "target_table", "primary_key", "geometry_column", "creation_date_column", "sync_key")
        TableName.parse(self.source_table), TableName.parse(self.target_table)
        check_srid(self.srid)
        return self


@dataclass
class AreaOfInterest:
    source_table: str = ""
    target_table: str = "dsp.area_of_interest"
    primary_key: str = ""
    creation_date_column: str = ""
    updated_at_column: str = ""
    territory_level_3_column: str = ""
    total_area_column: str = ""
    geometry_column: str = ""
    additional_columns: list = field(default_factory=list)
    where_clause: str = "1=1"
    srid: int | None = None
    layer_name: str = ""
    source_timezone: str = ""
    sync_key: str = "area_of_interest"

    def check(self) -> AreaOfInterest:
        where = "batch.area-of-interest"
        _required(where, self, "source_table", "target_table", "primary_key", "creation_date_column", "territory_level_3_column", "geometry_column")
        TableName.parse(self.source_table), TableName.parse(self.target_table)
        check_srid(self.srid)
        taken = (self.primary_key, self.creation_date_column, self.territory_level_3_column, self.geometry_column, self.updated_at_column, self.total_area_column)
        self.additional_columns = list(_extras(where, self.additional_columns, taken, AREA_COLUMNS, fold=False))
        self.layer_name = self.layer_name or TableName.parse(self.target_table).table
        return self


@dataclass
class Layer:
    """A layer of features, each within an area of interest; copied to the geometry store."""

    source_table: str = ""
    layer_name: str = ""
    primary_key: str = ""
    area_of_interest_id_column: str = ""
    creation_date_column: str = ""
    updated_at_column: str = ""
    label_column: str = ""
    geometry_column: str = ""
    additional_columns: list = field(default_factory=list)
    where_clause: str = "1=1"
    srid: int | None = None
    source_timezone: str = ""
    enabled: bool = True

    @property
    def name(self) -> str:
        return self.layer_name.strip() or TableName.parse(self.source_table).table

    @property
    def physical_name(self) -> str:
        return self.name.replace("-", "_")

    @property
    def target_table(self) -> str:
        return f"{TARGET_SCHEMA}.{self.physical_name}"

    @property
    def sync_key(self) -> str:
        return f"{TARGET_SCHEMA}_{self.physical_name}"

    def check(self) -> Layer:
        where = "batch.layers"
        _required(where, self, "source_table", "primary_key", "area_of_interest_id_column", "creation_date_column", "geometry_column")
        TableName.parse(self.source_table)
        taken = (self.primary_key, self.area_of_interest_id_column, self.creation_date_column, self.geometry_column, self.updated_at_column, self.label_column)
        self.additional_columns = list(_extras(where, self.additional_columns, taken, LAYER_COLUMNS, fold=True))
        return self


def check_layers(layers: list[Layer]) -> list[Layer]:
    """Checks all layers, the disabled ones too; gives the enabled ones."""
    seen: set[str] = set()
    for layer in layers:
        layer.check()
        if layer.physical_name in RESERVED_TABLES:
            raise ContractError(f"batch.layers: {layer.target_table} belongs to a fixed job")
        if layer.physical_name in seen:
            raise ContractError(f"batch.layers: {layer.target_table} is the target of two layers")
        seen.add(layer.physical_name)
    return [x for x in layers if x.enabled]


@dataclass
class Theme:
    slot: int = 0
    layer_name: str = ""
    unit_of_measurement: str = ""
    label: str = ""


@dataclass
class Kpis:
    theme_count: int = 0
    area_unit_of_measurement: str = "m²"
    themes: list = field(default_factory=list)

    def check(self) -> Kpis:
        themes = [t if isinstance(t, Theme) else _from(Theme, t) for t in self.themes or () if t]
        self.themes = [t for t in themes if t.layer_name.strip()]
        if self.theme_count < 0:
            raise ContractError("kpis: theme-count can't be negative")
        if len(self.themes) != self.theme_count:
            raise ContractError(f"kpis: theme-count is {self.theme_count}, but there are {len(self.themes)} themes")
        for t in self.themes:
            _required("kpis.themes", t, "layer_name", "unit_of_measurement")
            unit_factor(t.unit_of_measurement)
        unit_factor(self.area_unit_of_measurement)
        return self


@dataclass
class Parallel:
    """What a job's parallelization block means here: JDBC ranges, rows per fetch and rows per batch written."""

    enabled: bool = True
    thread_pool_size: int = 1
    chunk_size: int = 100
    page_size: int = 1000
    queue_capacity: int = 100

    @property
    def ranges(self) -> int:
        return max(1, self.thread_pool_size) if self.enabled else 1


#: Jobs and whether they run where nothing is said.
JOBS = {
    "admin-unit-level-1-geoserver-job": True,
    "admin-unit-level-2-geoserver-job": False,
    "admin-unit-level-3-geoserver-job": False,
    "area-of-interest-geoserver-job": False,
    "layer-jobs": False,
    "kpi-job": False,
}


@dataclass
class Settings:
    admin_units: dict[int, AdminUnit] = field(default_factory=dict)
    area_of_interest: AreaOfInterest | None = None
    layers: list[Layer] = field(default_factory=list)
    kpis: Kpis = field(default_factory=Kpis)
    jobs: dict[str, bool] = field(default_factory=lambda: dict(JOBS))
    source_timezone: str | None = None
    stores: dict[str, dict] = field(default_factory=dict)
    parallel: dict[str, Parallel] = field(default_factory=dict)

    def parallel_for(self, job: str) -> Parallel:
        return self.parallel.get(job) or Parallel()

    def zone(self, own: str | None) -> str | None:
        return resolve_zone(own, self.source_timezone)


def load(tree: Mapping) -> Settings:
    """Settings from a parsed YAML document."""
    batch = tree.get("batch") or {}
    units = batch.get("admin-unit") or {}
    jobs = dict(JOBS) | {k: bool(v) for k, v in (tree.get("execution-jobs") or {}).items() if k in JOBS}
    area = batch.get("area-of-interest")
    found = Settings(
        admin_units={n: _from(AdminUnit, {**units[f"level-{n}"], "level": n}).check() for n in (1, 2, 3) if units.get(f"level-{n}")},
        area_of_interest=_from(AreaOfInterest, area).check() if area else None,
        layers=[_from(Layer, x) for x in batch.get("layers") or ()],
        kpis=_from(Kpis, tree.get("kpis") or {}).check(),
        jobs=jobs,
        source_timezone=batch.get("source-timezone"),
        stores=dict(((tree.get("spring") or {}).get("datasource")) or {}),
        parallel={k: _from(Parallel, v or {}) for k, v in ((tree.get("parallelization") or {}).get("jobs") or {}).items()},
    )
    check_layers(found.layers)
    found.zone(None)
    return found


def load_yaml(text: str) -> Settings:
    import yaml

    return load(yaml.safe_load(text) or {})
