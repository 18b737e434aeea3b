"""JSON text <-> typed columns (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_text(col: str | Column = "value") -> Column:
    """Message payload as text; works for Kafka's binary ``value`` and for text."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def parse_json(col: str | Column, schema: T.DataType) -> Column:
    """Permissive parse: a bad field gives null, a bad document an all-null
    struct, empty text a null struct; fields outside the schema are ignored."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def parse_messages(df: DataFrame, schema: T.StructType, value_col: str = "value",
                   alias: str = "data") -> DataFrame:
    """Bytes or text messages -> one typed column per schema field."""
    return df.select(parse_json(value_text(value_col), schema).alias(alias)).select(f"{alias}.*")


def parse_with_text(df: DataFrame, schema: T.StructType, value_col: str = "value",
                    broken: str = "_broken") -> DataFrame:
    """Messages -> ``value`` as text, one typed column per schema field, and ``_broken``: whether the text is null, empty or no
    JSON object, or a field of it does not fit its type (that field is null then)."""
    marked = T.StructType([*schema.fields, T.StructField(broken, T.StringType(), True)])
    data = F.from_json(value_text(value_col), marked, {"columnNameOfCorruptRecord": broken})
    rows = df.select(value_text(value_col).alias("value"), data.alias("data"))
    return rows.select("value", *[F.col("data").getField(f.name).alias(f.name) for f in schema.fields],
                       (F.coalesce(F.trim("value") == "", F.lit(True))
                        | F.col("data").getField(broken).isNotNull()).alias(broken))


def encode_rows(df: DataFrame, as_binary: bool = False) -> DataFrame:
    """Each row as one JSON object in a ``value`` column (Kafka shape)."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select((value.cast("binary") if as_binary else value).alias("value"))
