"""JDBC reads of warehouse tables.

Connection settings (url, user, password, driver) are the caller's
``properties``; nothing is read from files or the environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    partition_column: str | None = None, lower_bound=None,
                    upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    """Whole-table read; large tables should give a numeric/date
    ``partition_column`` with bounds so the read is split over tasks."""
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column,
                               lowerBound=lower_bound, upperBound=upper_bound,
                               numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict) -> DataFrame:
    """Run ``query`` in the database; only its result crosses the wire."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for key, value in properties.items():
        reader = reader.option(key, value)
    return reader.load()


def table_exists(spark: SparkSession, url: str, properties: dict, table: str) -> bool:
    """Whether the database's catalogue lists ``table``: ``schema.table``, or a bare name of the current schema."""
    return read_jdbc_query(spark, url, listing_query(table), properties).first()["n"] > 0


def listing_query(table: str) -> str:
    schema, _, name = table.rpartition(".")
    text = lambda s: "'" + s.replace("'", "''") + "'"
    place = f"lower({text(schema)})" if schema else "lower(CURRENT_SCHEMA)"
    return ("SELECT count(*) AS n FROM information_schema.tables "
            f"WHERE lower(table_name) = lower({text(name)}) AND lower(table_schema) = {place}")


def read_max_cut(spark: SparkSession, url: str, properties: dict,
                 table: str = "cutting_dates", column: str = "cut_date") -> DataFrame:
    """One row ``cut_date``: the warehouse high-water mark, computed by the
    database (a plain table read would pull every row and aggregate in Spark).
    The column name is quoted, as Spark creates it lower-case and quoted."""
    return read_jdbc_query(
        spark, url, f'SELECT max("{column}") AS "cut_date" FROM {table}', properties)
