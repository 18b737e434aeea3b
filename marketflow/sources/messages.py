"""Message sources: Kafka topics, landed message files, article texts, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas
from marketflow.functions.json import parse_json, value_text


def read_kafka(spark: SparkSession, options: dict, streaming: bool = True) -> DataFrame:
    """Kafka topic as a frame with a binary ``value``.

    ``options`` holds ``kafka.bootstrap.servers``, ``subscribe`` and offsets
    settings (``startingOffsets``, ``failOnDataLoss``, ``maxOffsetsPerTrigger``);
    the connector package comes from the caller's session.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def read_message_files(spark: SparkSession, path: str, streaming: bool = False,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines message files as a ``value`` text column.

    The same frame shape as a Kafka read after ``value_text``, so one parse
    serves both; the streaming form is a file source with a commit log.
    """
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path)
    return spark.read.text(path)


def read_article_texts(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Texts that each hold a JSON array of article documents, one per line
    (``whole_file=False``) or one per file. Parsing is spread over files/lines
    instead of one literal in the plan."""
    return spark.read.text(path, wholetext=whole_file).select(F.col("value").alias("json_data"))


def flatten_envelopes(pages: DataFrame, result_type: T.StructType, text_col: str = "value",
                      stamp: Column | None = None, stamp_name: str = "date_time",
                      keep: list[str] | None = None) -> DataFrame:
    """REST page envelopes -> one row per element of ``results``.

    A page without ``results`` (or with a bad body) gives no rows. ``stamp``
    adds the request date to every row, as the producer does; ``keep`` carries
    page-level columns along.
    """
    env = parse_json(value_text(text_col), schemas.envelope(result_type))
    cols = [F.col(c) for c in (keep or [])]
    if stamp is not None:
        cols.append(stamp.alias(stamp_name))
    rows = pages.select(*cols, F.explode(env.getField("results")).alias("r"))
    out = [F.col(c) for c in (keep or [])] + [F.col("r").getField(f.name).alias(f.name)
                                              for f in result_type.fields]
    if stamp is not None:
        out.append(F.col(stamp_name))
    return rows.select(*out)
