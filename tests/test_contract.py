from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrasync.functions.ids import TableName, normal, safe_name
from terrasync.functions.temporal import ContractError
from terrasync.functions.units import area_in
from terrasync.plans.config import AreaOfInterest, Kpis, Layer, check_layers, load, load_yaml
from terrasync.plans.contract import Index, adopter, area_contract, check_existing, has_higher_dimensions, layer_contract, spark_type, target_type, where_all
from terrasync.sources.jdbc import key_bounds, range_predicates, split_range

SCHEMA = T.StructType.fromDDL(
    "source_pk bigint, conservation_unit_id bigint, nome string, data_criacao timestamp, data_atualizacao timestamp, codigo string, ignored string, updated_at string, gap interval day to second, the_geom string"
)


def layer(**more):
    return Layer(
        **{
            "source_table": "conservation.rivers",
            "primary_key": "source_pk",
            "area_of_interest_id_column": "conservation_unit_id",
            "creation_date_column": "data_criacao",
            "updated_at_column": "data_atualizacao",
            "label_column": "nome",
            "geometry_column": "the_geom",
            "additional_columns": ["codigo"],
            "srid": 4674,
        }
        | more
    )


def test_projection_order_and_names():
    c = layer_contract(layer(), SCHEMA)
    assert [s for s, _ in c.columns] == ["source_pk", "conservation_unit_id", "data_criacao", "data_atualizacao", "nome", "codigo"]
    assert [t for _, t in c.columns] == ["id", "area_of_interest_id", "created_at", "updated_at", "label", "codigo"]
    assert str(c.target) == "dsp.rivers" and c.sync_key == "dsp_rivers" and not c.business


@pytest.mark.parametrize(
    "more",
    [
        {"primary_key": ""},
        {"primary_key": "nothing"},
        {"additional_columns": ["GEOM"]},
        {"additional_columns": [" "]},
        {"additional_columns": ["codigo", "codigo"]},
        {"additional_columns": ["nome"]},
        {"additional_columns": ["updated_at"]},
        {"additional_columns": ["gap"]},
        {"additional_columns": ["absent"]},
        {"creation_date_column": "nome"},
        {"geometry_column": "source_pk"},
        {"srid": None},
        {"source_table": "rivers"},
    ],
)
def test_bad_layers(more):
    with pytest.raises(ContractError):
        layer_contract(layer(**more), SCHEMA)


def test_srid_order():
    schema = T.StructType([*SCHEMA.fields[:-1], T.StructField("the_geom", T.StringType(), True, {"srid": 4674})])
    assert layer_contract(layer(srid=4326), schema).srid == 4326
    assert layer_contract(layer(srid=None), schema).srid == 4674
    assert layer_contract(layer(srid=None), SCHEMA, sample_srid=3857).srid == 3857


def test_layer_names():
    assert layer(layer_name="zona-seguranca-300m").target_table == "dsp.zona_seguranca_300m"
    assert layer(source_table="cliente.zona_app").name == "zona_app"
    with pytest.raises(ContractError):
        check_layers([layer(layer_name="tipo-a"), layer(layer_name="tipo_a", enabled=False)])
    with pytest.raises(ContractError):
        check_layers([layer(layer_name="territory_level_1")])
    assert len(check_layers([layer(layer_name="tipo-a"), layer(layer_name="tipo-b", enabled=False)])) == 1


@pytest.mark.parametrize("name", ["sem_schema", "", ".tabela", "schema.", "foo.bar.baz", None])
def test_bad_table_names(name):
    with pytest.raises(ContractError):
        TableName.parse(name)
    assert str(TableName.parse(" a.b ")) == "a.b"


def test_area_contract():
    area = AreaOfInterest(source_table="s.a", primary_key="source_pk", creation_date_column="data_criacao", territory_level_3_column="conservation_unit_id", geometry_column="the_geom", srid=4326)
    c = area_contract(area, SCHEMA)
    assert [t for _, t in c.columns] == ["id", "created_at", "territory_level_3_id"] and c.parent == "territory_level_3_id"
    assert area_contract(replace(area, additional_columns=["GEOM"]), T.StructType([*SCHEMA.fields, T.StructField("GEOM", T.StringType())]))
    for more in ({"srid": 0}, {"territory_level_3_column": ""}, {"additional_columns": ["area"]}):
        with pytest.raises(ContractError):
            area_contract(replace(area, **more), SCHEMA)


def test_target_indexes():
    found = (
        Index("by_aoi", ("conservation_unit_id",)),
        Index.parse("both", 'CREATE UNIQUE INDEX both ON t USING btree ("conservation_unit_id", nome)'),
        Index("extra!", ("codigo",), "gin"),
        Index("absent", ("ignored",)),
        Index("shape", ("the_geom",), "gist"),
    )
    got = {i.name: i for i in layer_contract(layer(), SCHEMA, indexes=found).target_indexes()}
    assert set(got) == {"rivers_geom_gist", "rivers_aoi_id", "rivers_created_at", "rivers_updated_at", "rivers_both", "rivers_extra_"}
    assert got["rivers_both"].unique and got["rivers_both"].columns == ("area_of_interest_id", "label")
    assert safe_name("a-b c") == "a_b_c"


@pytest.mark.parametrize(
    "args, want",
    [(("varchar", 80), "varchar(80)"), (("bpchar",), "varchar"), (("numeric", None, 12, 4), "numeric(12,4)"), (("numeric", None, 10, 0), "numeric(10)"), (("numeric",), "numeric"), (("int8",), "bigint"), (("float8",), "double precision"), (("_int4",), "_int4"), (("geometry",), None), (("jsonb",), "jsonb")],
)
def test_target_types(args, want):
    assert target_type(*args) == want


def test_spark_types():
    assert spark_type("numeric", 12, 4) == T.DecimalType(12, 4) and spark_type("int8") == T.LongType() and spark_type("uuid") == T.StringType()


def test_existing_target():
    c = layer_contract(layer(), SCHEMA)
    check_existing(c, None)
    check_existing(c, T.StructType.fromDDL("created_at timestamp"))
    for bad in ("created_at timestamp_ntz", "made timestamp"):
        with pytest.raises(ContractError):
            check_existing(c, T.StructType.fromDDL(bad))


def test_where_all(spark):
    a, b = F.expr("true"), F.expr("false")
    assert where_all(None, adopter(" 1=1 "), adopter(" ")) is None
    assert where_all(a, None) is a
    assert spark.range(1).select(where_all(a, b)).first()[0] is False
    assert has_higher_dimensions("PointZ") and has_higher_dimensions("POINTM") and not has_higher_dimensions("MULTIPOLYGON")


def test_kpis_and_yaml():
    with pytest.raises(ContractError):
        Kpis(theme_count=1).check()
    with pytest.raises(ContractError):
        Kpis(theme_count=1, themes=[{"layer_name": "x", "unit_of_measurement": "acre"}]).check()
    text = """
batch:
  source-timezone: America/Sao_Paulo
  layers:
    - {source-table: a.rivers, primary-key: id, area-of-interest-id-column: aoi, creation-date-column: made, geometry-column: g, name-column: ignored}
kpis: {theme-count: 1, themes: [{slot: 1, layer-name: rivers, unit-of-measurement: ha}, {layer-name: ''}]}
execution-jobs: {kpi-job: true}
"""
    s = load_yaml(text.replace("layer-name", "layer_name").replace("unit-of-measurement", "unit_of_measurement"))
    assert s.layers[0].sync_key == "dsp_rivers" and s.zone(None) == "America/Sao_Paulo" and s.jobs["kpi-job"] and s.jobs["admin-unit-level-1-geoserver-job"]
    assert load({}).admin_units == {}


def test_units(spark):
    df = spark.createDataFrame([(10000.0,), (1000000.0,), (1000499.9999996,), (None,)], "m2 double")
    got = [[str(v) for v in r] for r in df.select(area_in(F.col("m2"), "ha"), area_in(F.col("m2"), "km²"), area_in(F.col("m2"), None), area_in(F.col("m2"), "ft2")).collect()]
    assert got[0][0] == "1.000" and got[1][1] == "1.000" and got[2][1] == "1.000" and got[3] == ["0.000"] * 4
    assert got[0][3] == "107639.104"
    with pytest.raises(ContractError):
        area_in(F.col("m2"), "acre")


def test_ids(spark):
    df = spark.createDataFrame([(42, " x "), (None, None)], "n bigint, s string")
    assert [tuple(r) for r in df.select(normal(df, "n"), normal(df, "s")).collect()] == [("42", "x"), (None, None)]


def test_ranges(spark):
    assert split_range(1, 10, 3) == [(1, 4), (5, 7), (8, 10)] and split_range(7, 7, 3) == [(7, 7)] and split_range(None, None, 4) == [(None, None)]
    assert len(split_range(1, 5, 12)) == 5
    assert key_bounds(spark.createDataFrame([("1",), (" 30 ",), (None,)], "k string"), "k") == (1, 30)
    assert key_bounds(spark.createDataFrame([("1",), ("a",)], "k string"), "k") == (None, None)
    assert "IS NULL" in range_predicates("k", [(1, 4), (5, 7)])[0]


def test_event_columns_are_found_whatever_their_case():
    layer = Layer(source_table="a.b", primary_key="pk", area_of_interest_id_column="aoi", creation_date_column="MADE", updated_at_column="Changed", geometry_column="shape", srid=4326)
    c = layer_contract(layer, T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, changed timestamp, shape string"))
    assert (c.created.name, c.updated.name) == ("made", "changed")
    exact = layer_contract(layer, T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, MADE timestamp, changed timestamp, shape string"))
    assert exact.created.name == "MADE"
    with pytest.raises(ContractError, match="'made', 'Made'"):
        layer_contract(layer, T.StructType.fromDDL("pk bigint, aoi bigint, made timestamp, Made timestamp, changed timestamp, shape string"))
