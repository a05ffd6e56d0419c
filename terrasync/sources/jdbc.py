"""Tables of a database, read in ranges of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import all_whole_numbers


def split_range(low: int | None, high: int | None, parts: int) -> list[tuple[int | None, int | None]]:
    """Whole numbers from low to high in at most that many ranges of nearly equal size, the larger ones first."""
    if low is None or high is None or low == high:
        return [(low, high)]
    base, more = divmod(high - low + 1, max(1, parts))
    out, at = [], low
    for i in range(max(1, parts)):
        size = base + (i < more)
        if size > 0:
            out.append((at, at + size - 1))
            at += size
    return out


def key_bounds(df: DataFrame, column: str) -> tuple[int | None, int | None]:
    """Smallest and largest key; none where some key isn't a whole number."""
    c = F.col(column)
    number = F.expr(f"try_cast(trim(cast(`{column}` as string)) as bigint)")
    row = df.agg(all_whole_numbers(c).alias("whole"), F.min(number).alias("low"), F.max(number).alias("high")).first()
    return (row.low, row.high) if row.whole else (None, None)


def range_predicates(column: str, ranges: list[tuple[int | None, int | None]]) -> list[str]:
    """Conditions for the reader; keys that are null go with the first range, so no row is lost."""
    out = []
    for k, (low, high) in enumerate(ranges):
        part = "1=1" if low is None else f"CAST({column} AS BIGINT) BETWEEN {low} AND {high}"
        out.append(f"({part} OR {column} IS NULL)" if k == 0 and low is not None else part)
    return out


#: Keys of a sample from which ranges of nearly equal numbers of rows are cut, for each range.
SAMPLED = 200


def evenly(keys: list, parts: int) -> list:
    """At most parts - 1 of the sorted keys, each once, that cut them into parts of nearly equal size."""
    cut = [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []
    return list(dict.fromkeys(k for k in cut if k > keys[0]))


def splitters(keys: DataFrame, column: str, parts: int) -> list:
    """Keys, in order, between which ranges of a text or number have nearly equally many rows, however the keys are distributed.

    Taken from a sample by hash of about SAMPLED keys a range; a small table's are exact. One key can't be cut in two.
    """
    c = F.col(column)
    total = keys.where(c.isNotNull()).count()
    share = int((1 << 30) * min(1.0, SAMPLED * parts / max(total, 1)))
    drawn = keys.where(c.isNotNull() & (F.pmod(F.xxhash64(c, F.lit("range")), F.lit(1 << 30)) < share)).select(c)
    return evenly([r[0] for r in drawn.orderBy(c).collect()], parts)


def between(column: str, cuts: list, text: bool = True) -> list[str]:
    """Conditions for the reader, one a range; keys that are null go with the first, so no row is lost."""

    def literal(v) -> str:
        return "'" + str(v).replace("'", "''") + "'" if text else str(int(v))

    if not cuts:
        return ["1=1"]
    edges = [literal(v) for v in cuts]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:], strict=False)]
    return [f"({column} < {edges[0]} OR {column} IS NULL)", *middle, f"{column} >= {edges[-1]}"]


def read_table(spark: SparkSession, url: str, table: str, column: str | None = None, ranges=None, properties: dict | None = None, fetch_size: int = 1000, predicates: list[str] | None = None) -> DataFrame:
    """A table over JDBC; with a key column and ranges, or with conditions, one Spark partition for each."""
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if predicates and len(predicates) > 1:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if column and ranges and ranges[0][0] is not None:
        return spark.read.jdbc(url, table, predicates=range_predicates(column, ranges), properties=props)
    return spark.read.jdbc(url, table, properties=props)


def check_connections(spark: SparkSession, stores: dict[str, dict], timeout: int = 5) -> None:
    """Asks every store for one row and reports all that don't answer, not just the first."""
    failed = []
    for name, s in stores.items():
        try:
            # Of the driver, for all connections: a host that doesn't answer must not hang the probe.
            spark._jvm.java.sql.DriverManager.setLoginTimeout(timeout)
            props = {k: str(s[v]) for k, v in (("user", "username"), ("password", "password"), ("driver", "driver-class-name")) if s.get(v)}
            spark.read.jdbc(s["url"], s.get("probe", "(SELECT 1 AS one) probe"), properties=props | {"queryTimeout": str(timeout)}).first()
        except Exception as e:
            failed.append(f"{name}: {str(e).splitlines()[0]}")
    if failed:
        raise ConnectionError("; ".join(failed))


def execute(spark: SparkSession, url: str, statements: list[str], properties: dict | None = None) -> None:
    """Runs statements over one connection of the driver, all or none."""
    props = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        for s in statements:
            made = connection.createStatement()
            made.execute(s)
            made.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def stage_rows(df: DataFrame, url: str, table: str, properties: dict | None = None, batch_size: int = 1000, connections: int = 8) -> None:
    """Writes rows to a staging table in batches, over so many connections.

    The shuffle before it lets the rows be worked out by as many tasks as they have.
    """
    df.repartition(connections).write.mode("overwrite").option("batchsize", batch_size).jdbc(url, table, properties=properties or {})
