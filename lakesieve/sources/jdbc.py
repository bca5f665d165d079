"""Database sources through Spark's JDBC reader."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import column

DEFAULT_PORTS = {"postgresql": 5432, "mysql": 3306}


def jdbc_url(kind: str, connection: str | Mapping[str, Any] | None) -> str:
    """A JDBC URL as given, or built from host, port and database."""
    if isinstance(connection, str) and connection:
        return connection if connection.startswith("jdbc:") else f"jdbc:{connection}"
    if not connection:
        raise ValueError("a database source needs a 'connection' option")
    host = connection.get("host", "localhost")
    port = connection.get("port", DEFAULT_PORTS.get(kind))
    return f"jdbc:{kind}://{host}:{port}/{connection.get('database')}"


def reader_options(kind: str, options: Mapping[str, Any]) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    ``partition_column`` with ``lower_bound``, ``upper_bound`` and
    ``num_partitions`` makes Spark read the table in parallel; the bounds only
    set the stride, rows outside them are read too. Parallel reading needs a
    ``dbtable``, so a query is then passed as a derived table.
    """
    connection = options.get("connection")
    found = {"url": jdbc_url(kind, connection)}
    if isinstance(connection, Mapping):
        found |= {k: str(connection[k]) for k in ("user", "password") if connection.get(k)}
    parallel = options.get("partition_column")
    if options.get("query"):
        query = str(options["query"])
        found |= {"dbtable": f"({query}) AS sub"} if parallel else {"query": query}
    elif options.get("table"):
        found["dbtable"] = str(options["table"])
    else:
        raise ValueError("a database source needs 'table' or 'query'")
    if parallel:
        found |= {
            "partitionColumn": str(parallel),
            "lowerBound": str(options["lower_bound"]),
            "upperBound": str(options["upper_bound"]),
            "numPartitions": str(options.get("num_partitions", 200)),
        }
    found["fetchsize"] = str(options.get("batch_size", 5000))
    if options.get("driver"):
        found["driver"] = str(options["driver"])
    return found


def read_jdbc(
    spark: SparkSession, kind: str, options: Mapping[str, Any], since: Any = None
) -> DataFrame:
    """A table or query; with ``since`` only rows whose incremental key is newer.

    The filter is a plain comparison, which Spark pushes into the database.
    """
    df = spark.read.format("jdbc").options(**reader_options(kind, options)).load()
    key = options.get("incremental_key")
    if since is not None and key:
        df = df.where(column(key) > F.lit(since))
    return df
