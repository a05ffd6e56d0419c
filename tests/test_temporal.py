from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from terrasync.functions.temporal import ContractError, EventColumn, Temporal, change_filter, classify, is_due, last_event, resolve_zone

SP = "America/Sao_Paulo"


@pytest.mark.parametrize("name, kind", [("timestamptz", Temporal.TIMESTAMPTZ), ("timestamp", Temporal.TIMESTAMP), ("date", Temporal.DATE), ("time", Temporal.TIME), ("timetz", Temporal.TIMETZ), ("interval", Temporal.INTERVAL), ("text", Temporal.NONE)])
def test_classify(name, kind):
    assert classify(name) is kind
    assert kind.is_event_time == (name in ("timestamptz", "timestamp", "date"))


def test_event_columns_need_zone_and_type():
    with pytest.raises(ContractError):
        EventColumn("t", Temporal.TIMESTAMP)
    with pytest.raises(ContractError):
        EventColumn("t", Temporal.TIME, SP)
    assert EventColumn("t", Temporal.TIMESTAMPTZ).zone is None
    assert resolve_zone(" ", SP) == SP and resolve_zone(None, None) is None
    with pytest.raises(ContractError):
        resolve_zone("Mars/Olympus", None)


def test_instants_in_zone(spark):
    rows = [("2026-01-15 12:00:00", "2026-01-15 15:00:00"), ("2018-11-04 00:00:00", "2018-11-04 03:00:00"), ("2018-02-17 23:30:00", "2018-02-18 01:30:00")]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = df.select(EventColumn("t", Temporal.TIMESTAMP, SP).instant().cast("string").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)
    day = spark.createDataFrame([(date(2026, 6, 1),)], "d date").select(EventColumn("d", Temporal.DATE, SP).instant().cast("string")).first()[0]
    assert day == "2026-06-01 03:00:00"


def test_change_filter(spark):
    mark = datetime(2026, 3, 1, tzinfo=UTC)
    old, new = mark - timedelta(days=1), mark + timedelta(days=1)
    rows = [("a", old, None), ("b", old, new), ("c", new, None), ("d", None, new), ("e", mark, mark), ("f", old, mark)]
    df = spark.createDataFrame(rows, "id string, c timestamp, u timestamp")
    c, u = EventColumn("c", Temporal.TIMESTAMPTZ), EventColumn("u", Temporal.TIMESTAMPTZ)
    assert {r.id for r in df.where(change_filter(c, u, mark)).collect()} == {"b", "c"}
    assert {r.id for r in df.where(change_filter(c, None, mark)).collect()} == {"c"}
    assert {r.id for r in df.where(change_filter(c, u, None)).collect()} == {"a", "b", "c", "e", "f"}
    assert df.agg(F.max(last_event(c, u)).cast("string")).first()[0] == "2026-03-02 00:00:00"


def test_date_mark_takes_later_local_days(spark):
    df = spark.createDataFrame([(date(2026, 8, 10),), (date(2026, 8, 11),)], "d date")
    got = df.where(EventColumn("d", Temporal.DATE, SP).newer_than(datetime(2026, 8, 10, 3, tzinfo=UTC))).collect()
    assert [r.d for r in got] == [date(2026, 8, 11)]


def test_filter_is_pushed_down(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2026, 1, 1))], "id int, t timestamp").withColumn("t", F.col("t").cast("timestamp_ntz"))
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t")).where(change_filter(EventColumn("t", Temporal.TIMESTAMP, SP), None, datetime(2025, 1, 1, tzinfo=UTC)))
    assert "GreaterThan(t," in read._jdf.queryExecution().executedPlan().toString()


def test_is_due():
    now = datetime(2026, 1, 2, tzinfo=UTC)
    assert is_due(None, now) and not is_due(now, now) and is_due(now - timedelta(hours=24, seconds=1), now)
