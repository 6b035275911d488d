"""JDBC tables: partitioned reads and batched writes.

Spark's JDBC source does the work: ``partitionColumn`` splits a scan into
``numPartitions`` range queries run by the executors in parallel,
``fetchsize`` sets rows per round trip, simple filters and limits are pushed
into the SQL sent to the database, and writes go out per partition in
batches.
"""

from __future__ import annotations

from urllib.parse import parse_qsl, urlsplit

from pyspark.sql import DataFrame, SparkSession


def jdbc_url(url: str) -> tuple[str, dict[str, str]]:
    """``postgresql://user:pw@host:port/db?sslmode=require`` style URL to a JDBC URL + properties.

    Already-JDBC URLs pass through. User, password and query parameters
    become connection properties (so ``sslmode`` travels as a property).
    """
    if url.startswith("jdbc:"):
        return url, {}
    parts = urlsplit(url)
    scheme = parts.scheme.split("+", 1)[0]
    scheme = {"postgres": "postgresql", "mssql": "sqlserver"}.get(scheme, scheme)
    props = dict(parse_qsl(parts.query))
    if parts.username:
        props["user"] = parts.username
    if parts.password:
        props["password"] = parts.password
    host = parts.hostname or ""
    port = f":{parts.port}" if parts.port else ""
    return f"jdbc:{scheme}://{host}{port}{parts.path}", props


def read_jdbc_table(spark: SparkSession, url: str, table: str | None = None, *,
                    query: str | None = None, properties: dict | None = None,
                    partition_column: str | None = None, lower_bound=None, upper_bound=None,
                    num_partitions: int | None = None, fetchsize: int | None = None,
                    custom_schema: str | None = None, driver: str | None = None) -> DataFrame:
    """A table (or query) scan; partitioned when a numeric/date column and bounds are given.

    Rows outside the bounds are still read (first/last partitions are
    open-ended); the bounds only decide the split. Never order at the scan:
    order where a result needs it.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    r = spark.read.format("jdbc").option("url", url)
    r = r.option("dbtable", table) if table is not None else r.option("query", query)
    opts = dict(properties or {})
    if driver:
        opts["driver"] = driver
    if fetchsize is not None:
        opts["fetchsize"] = str(fetchsize)
    if custom_schema:
        opts["customSchema"] = custom_schema
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load()


def write_jdbc_table(df: DataFrame, url: str, table: str, mode: str = "append", *,
                     properties: dict | None = None, batchsize: int = 10_000,
                     isolation_level: str | None = None, truncate: bool = False,
                     num_partitions: int | None = None, driver: str | None = None) -> None:
    """Append (O8) or overwrite (O9) a table; ``truncate`` keeps the table definition.

    ``num_partitions`` caps concurrent connections (coalesce, no shuffle).
    """
    w = df.coalesce(num_partitions) if num_partitions else df
    writer = (w.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
                .option("batchsize", str(batchsize)).option("truncate", str(truncate).lower()))
    if isolation_level:
        writer = writer.option("isolationLevel", isolation_level)
    if driver:
        writer = writer.option("driver", driver)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
