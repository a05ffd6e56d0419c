"""Runs the jobs of a YAML file between its databases: python -m terrasync.run CONFIG WAREHOUSE."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .plans.config import Settings, load_yaml
from .plans.jobs import Engine, Result
from .sources import jdbc, postgis
from .sources.warehouse import Warehouse


def engine_of(spark: SparkSession, settings: Settings, warehouse: str) -> Engine:
    """An Engine from the source database into the warehouse and the target databases, once all of them have answered."""
    jdbc.check_connections(spark, settings.stores)
    return Engine(
        spark,
        settings,
        postgis.reader(spark, settings),
        Warehouse(spark, warehouse),
        sink=postgis.writer(spark, settings),
        kpi_sink=postgis.kpi_writer(spark, settings),
        record=postgis.recorder(spark, settings),
    )


def main(arguments: list[str], engine=engine_of) -> int:
    """0 if every job that is switched on has completed, 1 if one failed, 2 for wrong arguments."""
    if len(arguments) != 2:
        print(__doc__, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("terrasync").getOrCreate()
    text = spark.read.text(arguments[0], wholetext=True).first()[0]
    results: list[Result] = engine(spark, load_yaml(text), arguments[1]).run_all()
    for r in results:
        print(f"{r.job}: {r.status}, read {r.read}, skipped {r.skipped}, upserted {r.upserted}, deleted {r.deleted}, flagged {sum(r.flagged.values())}, sent {r.sent}, {'committed' if r.committed else 'nothing committed'}, {r.seconds:.1f} s{', ' + r.error if r.error else ''}")
    return int(any(r.status != "COMPLETED" for r in results))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
