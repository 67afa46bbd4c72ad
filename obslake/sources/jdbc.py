"""JDBC table scan, key scan and append (Spark's JDBC data source).

Credentials come from the caller (options / environment), never from code.
A key scan is a plain table read narrowed with ``select`` and ``where``:
Spark pushes both into the generated SQL (``ReadSchema``/``PushedFilters``),
so there is no hand-written sub-query.  Parallel reads need a numeric
``partition_column`` with bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reader_options(url: str, table: str, props: dict[str, str],
                   partition_column: str | None = None, lower: int | None = None,
                   upper: int | None = None, num_partitions: int | None = None,
                   fetch_size: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **props}
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(num_partitions))
    return opts


def read_table(spark: SparkSession, url: str, table: str, props: dict[str, str],
               **partitioning) -> DataFrame:
    return spark.read.format("jdbc").options(**reader_options(url, table, props, **partitioning)).load()


def read_keys(spark: SparkSession, url: str, table: str, props: dict[str, str],
              keys: Sequence[str], bound_col: str | None = None, bound=None,
              **partitioning) -> DataFrame:
    df = read_table(spark, url, table, props, **partitioning).select(*keys)
    if bound_col is not None and bound is not None:
        df = df.where(F.col(bound_col) >= F.lit(bound))
    return df


def writer_options(url: str, table: str, props: dict[str, str], batch_size: int = 1000,
                   column_types: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), **props}
    if column_types:
        opts["createTableColumnTypes"] = column_types
    return opts


def append(df: DataFrame, url: str, table: str, props: dict[str, str],
           batch_size: int = 1000, max_connections: int | None = None) -> None:
    """Append rows; ``max_connections`` caps concurrent writers by
    coalescing (no shuffle)."""
    if max_connections:
        df = df.coalesce(max_connections)
    df.write.format("jdbc").options(**writer_options(url, table, props, batch_size)) \
        .mode("append").save()
