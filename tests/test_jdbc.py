import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasync.plans import ddl
from terrasync.plans.config import AreaOfInterest, Layer
from terrasync.plans.contract import Index, area_contract, layer_contract
from terrasync.sources import jdbc

URL = "jdbc:derby:memory:terrasync;create=true"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(i if i else None, f"n{i}") for i in range(50)], "K long, NAME string")
    jdbc.stage_rows(df, URL, "ROWS_", DERBY, connections=2)
    return df


def test_ranges_read_every_row_once(spark, rows):
    low, high = jdbc.key_bounds(jdbc.read_table(spark, URL, "ROWS_", properties=DERBY), "K")
    assert (low, high) == (1, 49)
    got = jdbc.read_table(spark, URL, "ROWS_", "K", jdbc.split_range(low, high, 4), DERBY)
    assert got.rdd.getNumPartitions() == 4
    assert sorted(r.NAME for r in got.collect()) == sorted(r.NAME for r in rows.collect())


def test_ranges_of_text_keys_are_even(spark):
    """Keys that crowd, quotes in them and one without a key: every row once, in ranges within a factor of two."""
    keys = [f"k'{i:06d}" if i % 10 else f"z{i * 100}" for i in range(20_000)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "K string, N int")
    jdbc.stage_rows(df, URL, "TEXTS", DERBY | {"createTableColumnTypes": "K VARCHAR(20)"}, connections=2)
    jdbc.execute(spark, URL, ["INSERT INTO TEXTS VALUES (NULL, -1)"])
    read = jdbc.read_table(spark, URL, "TEXTS", properties=DERBY)
    conditions = jdbc.between("K", jdbc.splitters(read, "K", 8))
    got = jdbc.read_table(spark, URL, "TEXTS", properties=DERBY, predicates=conditions)
    sizes = got.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.min() > 20_000 / 16 and sizes.max() < 20_000 / 4
    assert sorted(r.N for r in got.select("N").collect()) == list(range(-1, 20_000))
    assert jdbc.between("K", []) == ["1=1"] and jdbc.evenly(["a"] * 9, 4) == [] == jdbc.evenly([], 3)


def test_conditions_of_keys(spark):
    """The catalog's bounds come first; then equal widths for numbers, and a sample for texts."""
    from pyspark.sql import Row

    from terrasync.functions.ids import TableName
    from terrasync.sources import postgis

    table, asked = TableName("a", "ri'vers"), []
    texts = spark.createDataFrame([(f"t{i}",) for i in range(40)], "k string")
    found = postgis.key_conditions(lambda q: asked.append(q) or [Row(bound=f"b{i}") for i in range(101)], texts, table, "code", 4)
    assert found == ["(\"code\" < 'b25' OR \"code\" IS NULL)", "\"code\" >= 'b25' AND \"code\" < 'b50'", "\"code\" >= 'b50' AND \"code\" < 'b75'", "\"code\" >= 'b75'"]
    assert "pg_stats" in asked[0] and "tablename = 'ri''vers'" in asked[0] and "attname = 'code'" in asked[0]
    assert postgis.key_conditions(lambda q: [], texts, table, "code", 2)[1] == "\"code\" COLLATE \"C\" >= 't27'"
    numbers = spark.range(100).select(F.col("id").alias("k"))
    assert postgis.key_conditions(lambda q: [], numbers, table, "n", 2)[1] == 'CAST("n" AS BIGINT) BETWEEN 50 AND 99'
    assert postgis.key_conditions(lambda q: [Row(bound=str(i * i)) for i in range(9)], numbers, table, "n", 2) == ['("n" < 16 OR "n" IS NULL)', '"n" >= 16']


def test_the_adopters_condition_is_the_databases(spark):
    from terrasync.functions.ids import TableName
    from terrasync.plans.config import load
    from terrasync.sources import postgis

    where = "ST_Area(geom) > 0 AND name ~ '^A' AND made > now() - interval '1 year'"
    tree = {"batch": {"layers": [{"source-table": "a.rivers", "primary-key": "pk", "area-of-interest-id-column": "aoi", "creation-date-column": "made", "geometry-column": "shape", "srid": 4674, "where-clause": f" {where} "}]}}
    s = load(tree)
    assert postgis.conditions_of(s) == {"a.rivers": where}
    assert postgis.geometry_as_json(TableName("a", "rivers"), ["pk", "shape"], "shape", 4674, where).endswith(f"AND ({where})) AS src")
    schema = T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, shape string")
    assert layer_contract(s.layers[0], schema, s).where.strip() == where  # a file source has to meet it in Spark's language
    schema["shape"].metadata = {"adopter": where}
    assert layer_contract(s.layers[0], schema, s).where is None


def test_statements_run_together(spark, rows):
    jdbc.execute(spark, URL, ["CREATE TABLE T1 (A INT)", "INSERT INTO T1 VALUES (1)"])
    with pytest.raises(Exception):
        jdbc.execute(spark, URL, ["INSERT INTO T1 VALUES (2)", "INSERT INTO NOWHERE VALUES (1)"])
    assert [r.A for r in jdbc.read_table(spark, URL, "T1", properties=DERBY).collect()] == [1]


def test_all_dead_connections_are_told(spark, rows):
    good = {"url": URL, "driver-class-name": DERBY["driver"], "probe": "(SELECT 1 AS ONE FROM SYSIBM.SYSDUMMY1) probe"}
    jdbc.check_connections(spark, {"source": good})
    with pytest.raises(ConnectionError) as e:
        jdbc.check_connections(spark, {"source": good, "a": {"url": "jdbc:derby:memory:absent"}, "b": {"url": "jdbc:nothing:x"}})
    assert "a:" in str(e.value) and "b:" in str(e.value) and "source:" not in str(e.value)


def test_statements_of_a_layer():
    schema = T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, code varchar(40), n decimal(12,4), shape string")
    layer = Layer(source_table="a.rivers", primary_key="pk", area_of_interest_id_column="aoi", creation_date_column="made", geometry_column="shape", additional_columns=["code", "n"], srid=4674)
    c = layer_contract(layer, schema, indexes=(Index("by code", ("code",), unique=True),))
    schema_, table, *indexes = ddl.create_table(c, schema)
    assert '"id" varchar(255), "area_of_interest_id" varchar(255), "created_at" timestamptz, "code" varchar(40), "n" numeric(12,4), "geom" geometry(Geometry, 4674), PRIMARY KEY ("id")' in table
    assert "IF NOT EXISTS" in schema_ and any("UNIQUE INDEX" in i and '"rivers_by_code"' in i for i in indexes) and any("USING GIST" in i for i in indexes)
    up = ddl.upsert_from(c, "st", ["id", "code", "geom"], ("geom",))
    assert 'ON CONFLICT ("id") DO UPDATE SET "code" = EXCLUDED."code", "geom" = EXCLUDED."geom"' in up and "ST_GeomFromGeoJSON" in up
    assert "NOTHING" in ddl.upsert_from(c, "st", ["id"], ())


def test_statements_of_areas():
    schema = T.StructType.fromDDL("pk bigint, up bigint, made timestamp, shape string")
    area = AreaOfInterest(source_table="a.b", primary_key="pk", creation_date_column="made", territory_level_3_column="up", geometry_column="shape", srid=4326)
    columns = ddl.table_columns(area_contract(area, schema), schema, business=True)
    assert columns == {"id": "varchar(255)", "created_at": "timestamptz", "territory_level_3_id": "varchar(64)", "area": "numeric", "updated_at": "timestamptz", "boundary_box": "geometry(Polygon, 4326)", "centroid_coordinates": "geometry(Point, 4326)"}
    assert "IN (SELECT nid FROM gone)" in ddl.delete_listed(area_contract(area, schema), "gone")


def settings():
    from terrasync.plans.config import load

    return load(
        {
            "batch": {"layers": [{"source-table": "a.rivers", "primary-key": "pk", "area-of-interest-id-column": "aoi", "creation-date-column": "made", "geometry-column": "shape", "srid": 4674}]},
            "parallelization": {"jobs": {"layer-jobs": {"thread-pool-size": 12, "page-size": 500}}},
            "spring": {"datasource": {"geo-target": {"url": "jdbc:postgresql://geo/db", "username": "u"}, "target": {"url": "jdbc:postgresql://t/db"}}},
        }
    )


def test_source_query_and_ranges():
    from terrasync.functions.ids import TableName
    from terrasync.sources import postgis

    s = settings()
    assert s.parallel_for("layer-jobs").ranges == 12 and s.parallel_for("layer-jobs").page_size == 500 and s.parallel_for("other").ranges == 1
    assert postgis.tables_of(s) == {"a.rivers": ("shape", "pk", 4674, "layer-jobs")}
    text = postgis.geometry_as_json(TableName("a", "rivers"), ["pk", "shape", "name"], "shape", 4674)
    assert text.startswith('(SELECT "pk", "name", ST_AsGeoJSON(ST_Force2D(ST_Transform("shape", 4674)))::text AS "shape" FROM "a"."rivers"') and "ST_IsEmpty" in text


def test_sink_stages_then_moves(spark):
    from terrasync.sources import postgis

    done = []
    s = settings()
    schema = T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, shape string")
    contract = layer_contract(s.layers[0], schema, s)
    sink = postgis.writer(spark, s, execute=lambda _, url, statements, props: done.append((url, statements)), stage=lambda rows, url, table, props: done.append((url, table, rows.columns)))
    delta = spark.createDataFrame([], "id string, area_of_interest_id string, created_at timestamp, geom string")
    sink(contract, schema, delta, spark.createDataFrame([("1",)], "nid string"))
    assert {d[0] for d in done} == {"jdbc:postgresql://geo/db"}  # a layer has no business table
    assert done[1][2] == ["id", "area_of_interest_id", "created_at", "geom"] and done[2][2] == ["nid"]
    assert [x.split()[0] for x in done[3][1]] == ["INSERT", "DROP", "DELETE", "DROP"]


def test_key_figures_reach_the_database(spark):
    """Both kinds of rows are staged, and one transaction moves them; the table comes with its constraint and indexes."""
    from types import SimpleNamespace

    from terrasync.sources import postgis

    settings = SimpleNamespace(stores={"target": {"url": "u", "username": "me"}}, area_of_interest=None)
    ran, staged = [], []
    apply = postgis.kpi_writer(spark, settings, execute=lambda _, url, statements, props: ran.append(statements), stage=lambda rows, url, table, props: staged.append((rows, table)))
    apply("areas", "measures")
    made, moved = ran
    assert made[1].startswith('CREATE TABLE IF NOT EXISTS "dsp"."kpi_measure"') and "UNIQUE (area_of_interest_id, kpi_name)" in made[1] and 'REFERENCES "dsp"."area_of_interest" (id)' in made[1]
    assert [s.split(" ON ")[0] for s in made[2:]] == ["CREATE INDEX IF NOT EXISTS idx_kpi_measure_aoi_id", "CREATE INDEX IF NOT EXISTS idx_kpi_measure_name"]
    assert [r for r, _ in staged] == ["areas", "measures"]
    (_, areas), (_, measures) = staged
    assert moved == [ddl.update_areas('"dsp"."area_of_interest"', areas), f"DROP TABLE {areas}", 'TRUNCATE TABLE "dsp"."kpi_measure"', ddl.refresh_kpis(measures)[1], f"DROP TABLE {measures}"]


def test_what_the_catalog_says():
    from pyspark.sql import Row

    from terrasync.functions.ids import TableName
    from terrasync.sources import postgis

    asked = []

    def ask(query, registered=0):
        asked.append(query)
        if "geometry_columns" in query:
            return [Row(srid=registered, type="MULTIPOLYGON", coord_dimension=3)]
        if "pg_indexes" in query:
            return [Row(indexname="rivers_pkey", indexdef="CREATE UNIQUE INDEX rivers_pkey ON a.rivers USING btree (pk)"), Row(indexname="by_code", indexdef="CREATE INDEX by_code ON a.rivers USING btree (code)")]
        return [Row(srid=31982)]

    said = postgis.describe(ask, TableName("a", "ri'vers"), "shape")
    assert said == {"geometry_type": "MULTIPOLYGON", "srid": 31982, "indexes": [["by_code", "CREATE INDEX by_code ON a.rivers USING btree (code)"]]}
    assert all("'ri''vers'" in q for q in asked if "ST_SRID" not in q)
    assert postgis.describe(lambda q: ask(q, 4674), TableName("a", "b"), "shape")["srid"] == 4674
    # A layer without srid takes both from the geometry's metadata.
    schema = T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, code string, n int, shape string")
    schema["shape"].metadata = said | {"indexes": said["indexes"] + [["by_n", "CREATE INDEX by_n ON a.rivers USING btree (n)"]]}
    layer = Layer(source_table="a.rivers", primary_key="pk", area_of_interest_id_column="aoi", creation_date_column="made", geometry_column="shape", additional_columns=["code"])
    c = layer_contract(layer, schema)
    assert c.srid == 31982 and [i.name for i in c.indexes] == ["by_code"] and "rivers_by_code" in [i.name for i in c.target_indexes()]


def test_flags_and_state_reach_the_database(spark):
    from types import SimpleNamespace

    from terrasync.sources import postgis
    from terrasync.sources import state as states

    ran, staged = [], []
    settings = SimpleNamespace(stores={"target": {"url": "t"}, "batch": {"url": "b"}})
    apply = postgis.recorder(spark, settings, execute=lambda _, url, statements, props: ran.append((url, statements)), stage=lambda rows, url, table, props: staged.append((rows.columns, url)))
    ids = spark.createDataFrame([("20",)], "nid string")
    apply({"dsp.level3": ("id", ids), "dsp.level2": ("code", ids)}, spark.createDataFrame([], states.SCHEMA))
    assert [u for u, _ in ran] == ["t", "b", "b"] and staged[0] == (["nid"], "t") and staged[-1][1] == "b" and len(staged) == 3
    flags, made, moved = (s for _, s in ran)
    assert flags[0].startswith('UPDATE "dsp"."level3" SET requires_s3_file_regeneration = TRUE WHERE trim("id"::text) IN') and 'trim("code"::text)' in flags[2]
    assert "sync_key varchar(255) PRIMARY KEY" in made[1] and "ON CONFLICT (sync_key) DO UPDATE SET source_table = EXCLUDED.source_table" in moved[0]
