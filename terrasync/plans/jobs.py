"""The jobs: administrative units, areas of interest, layers, and key figures, in this order.

A job claims the warehouse, reads its source once, writes its new tables, and publishes them with its new state in one
step; other jobs fail meanwhile, before they have sent anything. A job that fails leaves everything as it was; running it again gives the same
tables, and databases that a dead job had written to are put right by the next one.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.ids import normal, normal_id
from ..functions.temporal import ContractError, is_due, pin_utc, utc
from ..operators import keyed, kpi, territory
from ..sources import state as states
from ..sources.warehouse import Claim, Entry, Warehouse
from .config import JOBS, Layer, Settings, check_layers
from .contract import Contract, area_contract, check_existing, layer_contract, unit_contract

log = logging.getLogger(__name__)
KPI_TABLE = "target/dsp.kpi_measure"


@dataclass
class Result:
    """What a run did. boxes: (x0, y0, x1, y1) in the web map's metres, of all rows that changed or went.

    written: rows by table of the warehouse, removals not among them; flagged: territories by table, those that had the flag already included;
    sent: rows that a database sink took over, upserts and removals; committed: whether the run was published.
    """

    job: str
    status: str = "COMPLETED"
    read: int = 0
    skipped: int = 0  # changed rows without a geometry
    upserted: int = 0
    deleted: int = 0
    has_changes: bool = False
    watermark: datetime | None = None
    written: dict[str, int] = field(default_factory=dict)
    flagged: dict[str, int] = field(default_factory=dict)
    sent: int = 0
    committed: bool = False
    seconds: float = 0.0
    error: str | None = None
    boxes: DataFrame | None = field(default=None, repr=False)


Source = Callable[[str], DataFrame]


def _nids(ids: DataFrame) -> DataFrame:
    return ids.select(normal_id(F.col("id"), ids.schema["id"].dataType).alias("nid"))


class Engine:
    """Runs jobs of one configuration from a source into one warehouse.

    source gives the DataFrame of a source table by its name; transform is a hook on every delta. sink, if
    given, gets (contract, source schema, delta, removed rows or None) before a run is published, to apply
    them to a database as well; where it fails, the run isn't published and the next one does it again.
    kpi_sink does the same with (measured areas, measures) of the key figures, and record with (flags by table:
    key and ids to flag (nid), the run's row of sync state), once a sink is through.
    """

    def __init__(self, spark: SparkSession, settings: Settings, source: Source, warehouse: Warehouse, clock: Callable[[], datetime] = lambda: datetime.now(UTC), transform: Callable[[DataFrame], DataFrame] | None = None, sink: Callable | None = None, kpi_sink: Callable | None = None, record: Callable | None = None):
        pin_utc(spark)
        self.spark, self.settings, self.source, self.warehouse, self.clock, self.transform, self.sink, self.kpi_sink, self.record = spark, settings, source, warehouse, clock, transform, sink, kpi_sink, record

    # ---- one table

    def _states(self) -> DataFrame:
        found = self.warehouse.read(states.TABLE)
        return found if found is not None else self.spark.createDataFrame([], states.SCHEMA)

    def _left_by_dead_jobs(self, contract: Contract, source_ids: DataFrame, unfinished: list[dict]) -> DataFrame:
        """Rows (nid, parent, box) that jobs sent without being published, and that the source no longer has: the warehouse never had them, so they are no orphans there."""
        parts = [self.warehouse.staged(x["delta"]) for x in unfinished]
        parent = [contract.parent] if contract.parent else []
        rows = [p.select(normal(p, contract.key).alias("nid"), *parent, geo.box_in_metres(F.col(contract.geometry_target), contract.srid).alias("box")) for p in parts]
        sent = reduce(DataFrame.unionByName, rows).where("nid is not null").dropDuplicates(["nid"])
        return sent.join(source_ids.join(sent.select("nid"), "nid", "left_semi").distinct(), "nid", "left_anti")

    def sync(self, contract: Contract) -> Result:
        with self.warehouse.claim() as claim:
            return self._sync(contract, claim)

    def _sync(self, contract: Contract, claim: Claim) -> Result:
        now = utc(self.clock())
        source = self.source(str(contract.source))
        known = self._states()
        state = states.find(known, contract.sync_key)
        mark = utc(state.watermark_last_event_at) if state and state.watermark_last_event_at else None
        geo_name, business_name = f"geo/{contract.target}", f"target/{contract.target}"
        old_geo, old_business = self.warehouse.read(geo_name), self.warehouse.read(business_name)
        check_existing(contract, old_geo.schema if old_geo is not None else None)

        # The delta feeds boxes, the watermark, departures and two upserts, so it is written once.
        g = F.col(f"`{contract.geometry}`")
        counted = Observation()
        changed = source.where(contract.changed(mark))
        unfinished = self.warehouse.unfinished(contract.sync_key) if self.sink is not None else []
        removed = [self.warehouse.staged(x["gone"]).select("nid") for x in unfinished if x["gone"]]
        if removed:  # ids that a dead job has deleted from the databases, and that the source has again
            changed = changed.unionByName(keyed.held(source.where(contract.selected(None)), reduce(DataFrame.union, removed), contract.primary_key).drop("nid"))
        changed = changed.observe(counted, F.count(F.lit(1)).alias("n"))
        picked = changed.where(geo.has_positions(g))
        box = geo.box_in_metres(g, contract.srid)
        rows = picked.select(*contract.projection(source.schema), contract.last_event().alias("__event"), box.alias("__box"))
        rows = self.warehouse.staged(self.warehouse.stage(f"delta/{contract.sync_key}", rows))
        seen = rows.agg(F.count("*").alias("n"), F.max("__event").alias("event")).first()
        event = seen.event if seen.event is None or mark is None or utc(seen.event) > mark else state.watermark_last_event_at  # rows sent again don't set it back
        result = Result(contract.sync_key, read=seen.n, skipped=counted.get["n"] - seen.n, has_changes=seen.n > 0, watermark=event)
        delta = keyed.latest(rows, contract.key, F.col("__event")).drop("__event", "__box")
        delta = self.transform(delta) if self.transform else delta
        # Both stores, departures, flags and the sink read it: the newest rows are settled once.
        delta_at = self.warehouse.stage(f"delta/{contract.sync_key}", delta)
        delta = self.warehouse.staged(delta_at)
        boxes = rows.select("__box.*")

        there = source.where(contract.present())
        ids = there.select(normal(there, contract.primary_key).alias("nid"))
        going = [self._left_by_dead_jobs(contract, ids, unfinished)] if unfinished else []
        checked = old_geo is not None and is_due(state.last_orphan_check_at if state else None, now)
        if checked:
            valid = old_geo.where(geo.has_positions(F.col(contract.geometry_target)))  # rows without geometry never go
            # Only ids are shuffled, of buckets that don't add up; parents and boxes are then looked up in the buckets that hold lost ones.
            copied = source.where(contract.selected(None))
            new = delta.select(normal(delta, contract.key).alias("nid"))
            fresh = new.join(keyed.held(self.warehouse.read_holding(geo_name, new), new, contract.key).select("nid"), "nid", "left_anti")
            lost = keyed.orphan_ids(valid.select(normal(valid, contract.key).alias("nid")), ids, copied.select(normal(copied, contract.primary_key).alias("nid")), fresh)
            lost = self.warehouse.staged(self.warehouse.stage(f"orphans/{contract.sync_key}", lost))
            going.append(keyed.held(self.warehouse.read_holding(geo_name, lost), lost, contract.key).select("nid", *([contract.parent] if contract.parent else []), geo.box_in_metres(F.col(contract.geometry_target), contract.srid).alias("box")))
        gone, gone_at = None, None
        if going:
            held = going[0] if len(going) == 1 else reduce(DataFrame.unionByName, going).dropDuplicates(["nid"])
            gone_at = self.warehouse.stage(f"orphans/{contract.sync_key}", held)
            gone = self.warehouse.staged(gone_at)
            result.deleted = gone.count()
            boxes = boxes.unionByName(gone.select("box.*"))

        departed = None
        if contract.parent and old_geo is not None:
            # Taken from the tables as they were: the territories that changed areas were in, and those of removed ones.
            parts = []
            if mark is not None:
                before = old_geo.join(delta.select(contract.key), contract.key, "left_semi")
                parts.append(before.select(F.col(contract.parent).alias("id")))
            if gone is not None:
                parts.append(gone.select(F.col(contract.parent).alias("id")))
            departed = territory.merged_ids(*parts) if parts else None

        tables: dict[str, Entry] = {}
        if contract.business and (entry := self._applied(business_name, old_business, contract.for_business(delta), contract, gone, result, mark)) is not None:
            tables[business_name] = entry
        if (entry := self._applied(geo_name, old_geo, delta, contract, gone, result, mark)) is not None:
            tables[geo_name] = entry
        if contract.regenerates == 0 and result.deleted and (measures := self.warehouse.read(KPI_TABLE)) is not None:
            tables[KPI_TABLE] = self.warehouse.stage(KPI_TABLE, keyed.without(measures, gone, "area_of_interest_id"))
        if result.watermark is not None:
            result.upserted = delta.count()
            result.written = {name: result.upserted for name in (business_name, geo_name) if name in tables}
        flags = self._flag(contract, tables, mark, departed, business_name, result)
        if contract.regenerates in (2, 3) and result.has_changes:
            flags = {str(contract.target): (contract.key, delta.select(normal(delta, contract.key).alias("nid")))}
            result.flagged = {str(contract.target): result.upserted}

        if result.watermark is not None:
            known = states.advance(known, contract.sync_key, str(contract.source), result.watermark, int(now.timestamp() * 1000), now)
        if checked or old_geo is None:
            known = states.mark_orphan_check(known, contract.sync_key, str(contract.source), now)
        if self.sink is not None and (result.has_changes or result.deleted):
            claim.check()
            self.warehouse.note_sent(contract.sync_key, delta_at, gone_at)
            self.sink(contract, source.schema, delta, gone)
            result.sent = result.upserted + result.deleted
        if self.record is not None and (checked or tables):
            claim.check()
            self.record(flags, known.where(F.col("sync_key") == contract.sync_key))
        if checked or tables:
            tables[states.TABLE] = self.warehouse.stage(states.TABLE, known.coalesce(1))
            self.warehouse.publish(tables, claim)
            result.committed = True
        if self.sink is not None:
            self.warehouse.forget(contract.sync_key)
        result.boxes = boxes
        return result

    def _applied(self, name: str, old: DataFrame | None, delta: DataFrame, contract: Contract, gone: DataFrame | None, result: Result, mark: datetime | None) -> Entry | None:
        """The table after the run, staged, or None where nothing changes. Only changed rows and marks of removed keys are written.

        Territories' own tables get the flags of their changed rows on the way; without a mark all rows are new.
        """

        def flagged(rows: DataFrame) -> DataFrame:
            if contract.regenerates not in (2, 3) or not name.startswith("target/"):
                return rows
            events = [dict(contract.columns)[e.name] for e in (contract.created, contract.updated) if e]
            return territory.flag(rows, territory.changed_since(mark, events[0], events[-1]))

        def change(rows: DataFrame) -> DataFrame:
            new = keyed.upsert(rows, delta, contract.key) if result.has_changes else rows
            return flagged(keyed.without(new, gone, contract.key) if result.deleted else new)

        if old is None:
            return self.warehouse.stage_keyed(name, flagged(delta), contract.key, result.read)
        if not (result.has_changes or result.deleted):
            return None
        if mark is None:
            return self.warehouse.restage(name, contract.key, change, None)
        if territory.FLAG in old.columns and contract.regenerates in (2, 3) and result.has_changes:
            flags = self.warehouse.read_holding(name, delta.select(normal(delta, contract.key).alias("nid"))).select(contract.key, territory.FLAG)
            delta = delta.join(flags, contract.key, "left")
        return self.warehouse.apply(name, contract.key, flagged(delta) if result.has_changes else None, gone.select("nid") if result.deleted else None)

    def _flag(self, contract: Contract, tables: dict[str, Entry], mark: datetime | None, departed: DataFrame | None, name: str, result: Result) -> dict[str, tuple[str, DataFrame]]:
        """Sets the regeneration flags of the territories above changed areas of interest; gives their keys and ids by table."""
        if contract.regenerates != 0:
            return {}
        if not {2, 3} <= self.settings.admin_units.keys():
            return {}
        two, three = (f"target/{self.settings.admin_units[n].target_table}" for n in (2, 3))
        level2, level3 = self.warehouse.read(two), self.warehouse.read(three)
        areas = self.warehouse.staged(tables[name]) if name in tables else self.warehouse.read(name)
        if level2 is None or level3 is None or areas is None:
            return {}
        units = self.settings.admin_units
        key3, key2 = (units[n].column_mapping.get(units[n].primary_key, units[n].primary_key) for n in (3, 2))
        parent = units[3].column_mapping.get(units[3].partition_column, units[3].partition_column)
        events = areas if "updated_at" in areas.columns else areas.withColumn("updated_at", F.lit(None).cast("timestamp"))
        ids = territory.level3_of_changed(events, mark)
        if departed is not None:
            ids = territory.merged_ids(ids, departed)
        ids = self.warehouse.staged(self.warehouse.stage("delta/flags", ids))
        above = self.warehouse.staged(self.warehouse.stage("delta/flags", territory.parents_of(self.warehouse.read_holding(three, _nids(ids)), ids, key3, parent)))
        for table, key, found in ((three, key3, ids), (two, key2, above)):
            there = keyed.held(self.warehouse.read_holding(table, _nids(found)), _nids(found), key).drop("nid")
            result.flagged[table.removeprefix("target/")] = there.count()
            unset = ~F.coalesce(F.col(territory.FLAG), F.lit(False)) if territory.FLAG in there.columns else F.lit(True)
            tables[table] = self.warehouse.apply(table, key, there.where(unset).withColumn(territory.FLAG, F.lit(True)))
        return {units[n].target_table: (key, _nids(found)) for n, key, found in ((3, key3, ids), (2, key2, above))}

    # ---- jobs

    def _guarded(self, job: str, run: Callable[[], Result]) -> Result:
        began = time.monotonic()
        try:
            result = run()
        except Exception as e:
            log.exception("job %s failed", job)
            result = Result(job, status="FAILED", error=str(e))
        result.job, result.seconds = job, time.monotonic() - began
        log.info("%s", result)
        return result

    def run_admin_unit(self, level: int) -> Result:
        unit = self.settings.admin_units[level]
        return self._guarded(f"admin-unit-level-{level}", lambda: self.sync(unit_contract(unit, self.source(unit.source_table).schema, self.settings)))

    def run_areas(self) -> Result:
        area = self.settings.area_of_interest
        if area is None:
            raise ContractError("batch.area-of-interest isn't configured")
        return self._guarded("area-of-interest", lambda: self.sync(area_contract(area, self.source(area.source_table).schema, self.settings)))

    def run_layer(self, layer: Layer) -> Result:
        return self._guarded(layer.sync_key, lambda: self.sync(layer_contract(layer, self.source(layer.source_table).schema, self.settings)))

    def _measured(self, name: str, shapes: DataFrame, key: str, srid: int, tables: dict[str, Entry]) -> DataFrame:
        """(id, m2) of the geometries of a table. Measures are kept in a table of their own: only new and changed geometries are measured, told by 128 bits of their text.

        Rows without a key are measured by nobody. The kept table's next version is put among tables.
        """
        kept, g = f"measured/{name}", F.col("geom")
        shapes = shapes.where(geo.has_positions(g)).withColumn("nid", normal(shapes, key)).where("nid is not null")
        seen = shapes.select("nid", "geom", F.xxhash64("geom", F.lit(srid)).alias("a"), F.xxhash64(F.lit(srid), "geom").alias("b"))
        old = self.warehouse.read(kept)

        def measured(rows: DataFrame) -> DataFrame:
            return rows.select(F.col("nid").alias("id"), "a", "b", geo.geodesic_area(g, srid).alias("m2"))

        if old is None:
            tables[kept] = self.warehouse.stage_keyed(kept, measured(seen), "id", seen.count())
        else:
            known = old.select(F.col("id").alias("nid"), "a", "b")
            new = seen.join(known, ["nid", "a", "b"], "left_anti")
            gone = known.join(seen.select("nid"), "nid", "left_anti").select("nid")
            tables[kept] = self.warehouse.apply(kept, "id", measured(new), gone)
        return self.warehouse.staged(tables[kept]).select("id", "m2")

    def run_kpis(self) -> Result:
        """The areas of interest and themes of now; only geometries that are new since the last run are measured. A failure is raised."""
        with self.warehouse.claim() as claim:
            return self._run_kpis(claim)

    def _run_kpis(self, claim: Claim) -> Result:
        kpis, area = self.settings.kpis.check(), self.settings.area_of_interest
        target = area.target_table if area else "dsp.area_of_interest"
        srid = area.srid if area else 4326
        shapes, business = self.warehouse.read(f"geo/{target}"), self.warehouse.read(f"target/{target}")
        if shapes is None or business is None:
            raise ContractError(f"{target} isn't there; run the areas of interest first")
        tables: dict[str, Entry] = {}
        measured = kpi.in_unit(self._measured(f"geo/{target}", shapes, "id", srid, tables), kpis.area_unit_of_measurement)
        areas = self.warehouse.staged(self.warehouse.stage("kpi/areas", measured))
        tables[f"target/{target}"] = self.warehouse.apply(f"target/{target}", "id", kpi.changed_areas(business, areas))
        out = self.spark.createDataFrame([], kpi.KPI_SCHEMA)
        for t in kpis.themes:
            layer = next((x for x in self.settings.layers if x.name == t.layer_name.strip()), Layer(layer_name=t.layer_name.strip()))
            features = self.warehouse.read(f"geo/{layer.target_table}")
            if features is None:
                raise ContractError(f"{layer.target_table} of theme {t.layer_name!r} isn't there; run its layer first")
            m2 = self._measured(f"geo/{layer.target_table}", features, "id", layer.srid or 4326, tables)
            of = features.select(normal(features, "id").alias("id"), "area_of_interest_id").where("area_of_interest_id is not null")
            out = out.unionByName(kpi.summed(of.join(m2, "id").select("area_of_interest_id", "m2"), t.layer_name.strip(), t.unit_of_measurement))
        staged = self.warehouse.stage(KPI_TABLE, out)
        measures = self.warehouse.staged(staged)
        if not keyed.dangling(measures, "area_of_interest_id", shapes, "id").isEmpty():
            raise ContractError("a measure names an area of interest that isn't there")
        if not keyed.repeated_keys(measures, "area_of_interest_id", "kpi_name").isEmpty():
            raise ContractError("an area of interest has two measures of one name")
        if self.kpi_sink is not None:
            claim.check()
            self.kpi_sink(areas, measures)
        self.warehouse.publish(tables | {KPI_TABLE: staged}, claim)
        n = measures.count()
        return Result("kpi", upserted=n, written={KPI_TABLE: n}, has_changes=True, committed=True)

    def run_all(self) -> list[Result]:
        on, out = dict(JOBS) | self.settings.jobs, []
        for level in (1, 2, 3):
            if on[f"admin-unit-level-{level}-geoserver-job"] and level in self.settings.admin_units:
                out.append(self.run_admin_unit(level))
        if on["area-of-interest-geoserver-job"]:
            out.append(self.run_areas())
        if on["layer-jobs"]:
            out += [self.run_layer(x) for x in check_layers(self.settings.layers)]
        if on["kpi-job"]:
            out.append(self.run_kpis())
        self.warehouse.sweep()
        return out
