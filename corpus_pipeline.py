"""A corpus clean-up in stages; each takes the documents its predecessor kept.

Every stage but the last returns the columns of ``documents``, extra ones too; the
last one returns the packed pieces. The stages call the operators of
``marketflow.llm``, whose docstrings define what happens to nulls, empty and
repeated rows. In short: a null text is an empty one, all empty texts are one
group of copies, a null source is a source of its own, rows without an id are
kept unless their text is a copy, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm.common import materialise, read_table
from marketflow.llm.exact_dedup import keep_first_copies
from marketflow.llm.mixing import mix
from marketflow.llm.packing import pack
from marketflow.llm.simhash import keep_one_per_group
from marketflow.llm.toxicity import score_toxicity, train_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by a model learned from ``labels`` go."""
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where(F.col("__llm_toxic") < 0.5).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return keep_first_copies(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return keep_one_per_group(docs, shingle=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take go."""
    mixed, _ = mix(docs, F.array("source"), weights=(3, 1, 2), ratio=1.5, cap=2)
    times = F.sequence(F.lit(1).cast("bigint"), F.col("__llm_copies"))
    return (mixed.where(F.col("__llm_copies") > 0).withColumn("__llm_time", F.explode(times))
            .select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's pieces in windows of 1024 ids."""
    return pack(docs, window=1024)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash", simhash),
    ("mixing", mixing),
    ("packing", packing),
]

# The toxicity stage learns a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
