"""Exact de-duplication by full content, safe for groups of any size. DataFrame operations only.

Two texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted. The combining runs in three stages:

1. every map task reduces its own rows to one row per content (Spark's partial aggregate);
2. the survivors meet by (digest, salt). The salt is 0 for all but the *hot*
   digests, whose rows are dealt over ``salts`` tasks;
3. the salt winners of hot digests are combined globally.

The grouping key is always (digest, whole normalised text), so equal digests of
different texts stay apart. A hot digest is one that holds over 1/``HOT_SHARE``
of all rows, so there are fewer than ``HOT_SHARE`` of them whatever the input:
that is the proven bound (10,000 rows of 32 bytes) behind the one broadcast.
Every other group is at most that small share of the rows.

The text crosses the network once per distinct content and map task. Documents
find their group by digest alone where a digest has one content (then every
row with that digest was compared in full by stage 1); only digests shared by
different contents, if there are any, are joined on the content as well.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialise, strip_white_space

HOT_SHARE = 10_000
SALTS = 64
# The best row of a group is the largest (code points, then smallest id), as one decimal number,
# so that the aggregate keeps a fixed-width buffer: code points * 2^65 + (2^63 - id); a null id is 0 there.
_STEP = Decimal(2 ** 65)
_TOP = Decimal(2 ** 63)


def _rank(n_chars: Column, doc_id: Column) -> Column:
    low = F.coalesce(F.lit(_TOP) - doc_id.cast("decimal(19,0)"), F.lit(Decimal(0)))
    return (n_chars.cast("decimal(12,0)") * F.lit(_STEP) + low).cast("decimal(38,0)")


def _rank_id(rank: Column) -> Column:
    low = rank % F.lit(_STEP)
    return F.when(low > 0, (F.lit(_TOP) - low).cast("bigint"))


def _rank_chars(rank: Column) -> Column:
    return ((rank - rank % F.lit(_STEP)) / F.lit(_STEP)).cast("bigint")


def sha256_digest(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def _contents(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.length(text).alias("n_chars"), strip_white_space(text).alias("content"))
    return base.withColumn("digest", digest(F.col("content")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int = SALTS, digest=sha256_digest) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points in its original text stays,
    then the smallest id; a null id loses to any other. Exactly one row of a group
    is ``kept``: of rows that share the longest text's length and the id (or have none), an
    arbitrary one. A null text is empty, and all empty texts are one group. An
    empty table gives no rows; further columns are ignored.
    """
    return _decided(docs, id_col, text_col, salts, digest)[0].select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _decided(docs: DataFrame, id_col: str, text_col: str, salts: int = SALTS, digest=sha256_digest) -> tuple[DataFrame, DataFrame | None]:
    """Every row's ``doc_id, n_chars, digest, content, keep_id, n, kept`` (``content`` only where a digest has several),
    and, if in any group several rows tie for being kept, those groups (else None)."""
    base = _contents(docs, id_col, text_col, digest)
    light = materialise(base.select("doc_id", "n_chars", "digest").withColumn("row", F.monotonically_increasing_id()), "exact-light")
    share = max(salts, -(-light.count() // HOT_SHARE))
    hot = (light.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > share)
           .select("digest", F.lit(True).alias("hot")))

    # Stages 1 and 2: local winners per map task, merged by (digest, salt, content).
    salted = (base.join(F.broadcast(hot), "digest", "left")
              .withColumn("salt", F.when(F.col("hot"), F.spark_partition_id() % salts).otherwise(0))
              .groupBy("digest", "hot", "salt", "content")
              .agg(F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("best"),
                   F.count("*").alias("n")))
    winners = materialise(salted.select("digest", "hot", "best", "n",
                                        F.when(F.col("hot"), F.col("content")).alias("content")),
                          "exact-winners")
    # Stage 3: the salt winners of hot digests, again by their whole content.
    groups = (winners.where(F.col("hot")).groupBy("digest", "content")
              .agg(F.max("best").alias("best"), F.sum("n").alias("n")).select("digest", "best", "n")
              .union(winners.where(F.col("hot").isNull()).select("digest", "best", "n")))
    groups = materialise(groups, "exact-groups")

    shared = groups.groupBy("digest").agg(F.count("*").alias("k")).where("k > 1").select("digest")
    if shared.isEmpty():
        out = light.join(groups, "digest").withColumn("content", F.lit(None).cast("string"))
    else:
        shared = materialise(shared, "exact-shared")
        rows = base.join(shared, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id())
        by_content = (rows.groupBy("digest", "content")
                      .agg(F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("best"),
                           F.count("*").alias("n")))
        columns = ["doc_id", "n_chars", "digest", "row", "best", "n", "content"]
        out = (light.join(groups.join(shared, "digest", "left_anti"), "digest").withColumn("content", F.lit(None).cast("string")).select(*columns)
               .union(rows.join(by_content, ["digest", "content"]).select(*columns)))
    keep = _rank_id(F.col("best"))
    best = F.col("doc_id").eqNullSafe(keep) & (F.col("n_chars") == _rank_chars(F.col("best")))
    out = materialise(out.select("doc_id", "n_chars", "digest", "row", "n", "content", keep.alias("keep_id"), best.alias("best")), "exact-rows")
    # Several best rows in a group share id and length: one of them stays.
    group = ["digest", "content"]
    ties = out.where("best").groupBy(*group).agg(F.count("*").alias("k"), F.min("row").alias("first")).where("k > 1").drop("k")
    if ties.isEmpty():
        return out.withColumn("kept", F.col("best")), None
    ties = materialise(ties, "exact-ties")
    other = ties.select(F.col("digest").alias("d"), F.col("content").alias("c"), "first")
    same = (F.col("digest") == F.col("d")) & F.col("content").eqNullSafe(F.col("c"))
    kept = F.col("best") & (F.col("first").isNull() | (F.col("row") == F.col("first")))
    return out.join(other, same, "left").withColumn("kept", kept), ties


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: exactly one row of each group of equal texts.

    It is the row that ``exact_groups`` keeps; of rows alike in id and length an arbitrary one.
    """
    rows, ties = _decided(docs, id_col, text_col)
    names = ["__llm_id", "__llm_chars", "__llm_sha"]
    best = rows.where("best").select(*(F.col(c).alias(n) for c, n in zip(("doc_id", "n_chars", "digest"), names))).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumns({"__llm_id": F.col(id_col).cast("bigint"), "__llm_chars": F.length(text),
                               "__llm_sha": sha256_digest(strip_white_space(text))})

    def among(found: DataFrame) -> DataFrame:
        right = found.select(*(F.col(n).alias(n + "_") for n in names))
        same = (F.col("__llm_id").eqNullSafe(F.col("__llm_id_")) & (F.col("__llm_chars") == F.col("__llm_chars_"))
                & (F.col("__llm_sha") == F.col("__llm_sha_")))
        return marked.join(right, same, "left_semi")

    if ties is None:
        return among(best).drop(*names)
    best = materialise(best, "exact-best")
    tied = ties.select(F.col("digest").alias("__llm_sha")).distinct()
    # One row of each tied group, whole; only these rows are shuffled once more.
    once = among(best.join(tied, "__llm_sha", "left_semi")).dropDuplicates(names)
    return among(best.join(tied, "__llm_sha", "left_anti")).unionByName(once).drop(*names)
