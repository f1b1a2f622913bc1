"""Warehouse (JDBC) reads.

A plain ``dbtable`` read is one partition on one executor; for big tables give
``partition_column`` (numeric, date or timestamp) with bounds and ``num_partitions`` so
Spark issues that many range queries in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 properties: Mapping[str, str] | None = None,
                 partition_column: str | None = None, lower_bound: object = None,
                 upper_bound: object = None, num_partitions: int | None = None,
                 fetch_size: int | None = None) -> dict[str, str]:
    """Options for Spark's ``jdbc`` source (validated, no connection opened)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, **{k: str(v) for k, v in (properties or {}).items()}}
    if table is not None:
        opts["dbtable"] = table
    else:
        if partition_column:
            # Spark rejects `query` together with partitionColumn; wrap it as a subquery.
            opts["dbtable"] = f"({query}) AS q"
        else:
            opts["query"] = query
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound, num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    elif num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def read_table(spark: SparkSession, url: str, table: str,
               properties: Mapping[str, str] | None = None, **partitioning) -> DataFrame:
    """Read a whole warehouse table."""
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table=table, properties=properties, **partitioning)).load()


def read_query(spark: SparkSession, url: str, query: str,
               properties: Mapping[str, str] | None = None, **partitioning) -> DataFrame:
    """Read the result of a SQL query run by the warehouse (e.g. a driving key list).

    The result stays a DataFrame; callers join with it instead of collecting it.
    """
    return spark.read.format("jdbc").options(
        **jdbc_options(url, query=query, properties=properties, **partitioning)).load()
