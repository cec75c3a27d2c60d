"""JDBC reads of a stored count table.

Filters on the result (e.g. a ``window_start`` range) are pushed into the
SQL sent to the database.  A table is read in parallel: by day of its time
column (``read_jdbc``), one query a day between the first and the last, which the
database finds with one row of pushed ``min`` and ``max``; or by ranges of a
numeric column with given bounds.  A read through one connection
happens only where it is asked for by name (``read_jdbc_whole``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from editpulse.sinks.jdbc import jdbc_options


def _options(url: str, table: str, **kwargs) -> dict[str, str]:
    opts = jdbc_options(url, table, **kwargs)
    opts.pop("batchsize", None)
    return opts


def quoted(spark: SparkSession, url: str, column: str) -> str:
    """``column`` as the database of ``url`` quotes it (Spark writes quoted names)."""
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)


def time_bounds(spark: SparkSession, url: str, table: str, column: str = "window_start", **kwargs):
    """First and last value of ``column``: one row that the database computes."""
    column = quoted(spark, url, column)
    query = f"(SELECT min({column}) AS first_value, max({column}) AS last_value FROM {table}) bounds"
    row = spark.read.format("jdbc").options(**_options(url, query, **kwargs)).load().first()
    return row[0], row[1]


def day_predicates(first: dt.datetime, last: dt.datetime, column: str = "window_start", max_partitions: int = 1000) -> list[str]:
    """Disjoint conditions that cover ``[first, last]``: one a day, or one for each run of
    as many days as keeps them at ``max_partitions``.  Each is half-open, in JDBC's
    timestamp escapes."""
    begin, n = first.date(), (last.date() - first.date()).days + 1
    step = -(-n // max_partitions)
    edges = [begin + dt.timedelta(days=i) for i in range(0, n, step)] + [begin + dt.timedelta(days=n)]
    stamp = lambda d: f"{{ts '{d.isoformat()} 00:00:00'}}"
    return [f"{column} >= {stamp(a)} AND {column} < {stamp(b)}" for a, b in zip(edges[:-1], edges[1:])]


def read_jdbc(spark: SparkSession, url: str, table: str, column: str = "window_start", max_partitions: int = 1000, **kwargs) -> DataFrame:
    """The table by day of the time column ``column``, a partition each.

    Rows without a time are a partition of their own; a table without
    rows is one empty partition."""
    first, last = time_bounds(spark, url, table, column, **kwargs)
    name = quoted(spark, url, column)
    predicates = [f"{name} IS NULL"] + (day_predicates(first, last, name, max_partitions) if first is not None else [])
    properties = {k: v for k, v in _options(url, table, **kwargs).items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, partition_column: str, lower_bound, upper_bound,
                     num_partitions: int, **kwargs) -> DataFrame:
    """The table in ``num_partitions`` ranges of a numeric or time column."""
    if lower_bound is None or upper_bound is None or not num_partitions:
        raise ValueError("a partitioned read needs bounds and num_partitions")
    return spark.read.format("jdbc").options(
        **_options(url, table, **kwargs), partitionColumn=partition_column, lowerBound=str(lower_bound),
        upperBound=str(upper_bound), numPartitions=str(int(num_partitions))).load()


def read_jdbc_whole(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """The table through one connection, in one task: for small tables."""
    return spark.read.format("jdbc").options(**_options(url, table, **kwargs)).load()
