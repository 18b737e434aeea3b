"""JDBC writes to warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _jdbc_safe(df: DataFrame) -> DataFrame:
    """Arrays have no JDBC type in most dialects: send them as joined text."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            cols.append(F.array_join(F.col(field.name), ",").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict,
                num_partitions: int | None = None) -> None:
    """Append rows over ``num_partitions`` connections (default: one per
    partition). A shuffle deals the rows, so the stages before it keep their tasks."""
    out = _jdbc_safe(df)
    if num_partitions is not None:
        out = out.repartition(num_partitions)
    out.write.jdbc(url=url, table=table, mode="append", properties=properties)


def overwrite_jdbc(df: DataFrame, url: str, table: str, properties: dict,
                   truncate: bool = False, num_partitions: int | None = None) -> None:
    """Replace the table. By default it is dropped and re-created from the
    written columns (their shape wins, constraints are lost). With
    ``truncate`` the definition and its NOT NULL constraints stay, and the
    written columns must match it (see ``news.articles_table_rows``).
    ``num_partitions`` caps the connections, as for ``append_jdbc``."""
    props = dict(properties)
    props["truncate"] = "true" if truncate else "false"
    out = _jdbc_safe(df)
    if num_partitions is not None:
        out = out.repartition(num_partitions)
    out.write.jdbc(url=url, table=table, mode="overwrite", properties=props)


def _names(columns: list[str]) -> str:
    """Column names as Spark's JDBC writer quotes them."""
    return ", ".join('"' + c.replace('"', '""') + '"' for c in columns)


def create_like(stage: str, table: str, columns: list[str]) -> str:
    return f"CREATE TABLE {stage} AS SELECT {_names(columns)} FROM {table} WHERE 1 = 0"


def create_from(stage: str, table: str, columns: list[str]) -> str:
    return f"CREATE TABLE {table} AS SELECT {_names(columns)} FROM {stage}"


def move_rows(stage: str, table: str, columns: list[str]) -> str:
    return f"INSERT INTO {table} ({_names(columns)}) SELECT {_names(columns)} FROM {stage}"


def run_transaction(spark: SparkSession, url: str, properties: dict, statements: list[str]) -> None:
    """Runs the statements on one connection of the driver; all take effect or none."""
    jvm = spark._jvm
    if properties.get("driver"):
        jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(properties["driver"])
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
