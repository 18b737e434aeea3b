"""Target-table contracts (NOT NULL and VARCHAR length) as a valid/rejected split.

A warehouse insert fails as a whole on one bad row; checking the contract in
Spark first keeps good rows flowing and reports bad ones with their reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    column: str
    not_null: bool = False
    max_length: int | None = None

    def checks(self) -> list[tuple[str, Column]]:
        """(rule name, violation predicate) pairs; predicates are never null."""
        out = []
        c = F.col(self.column)
        if self.not_null:
            out.append((f"{self.column}_null", c.isNull()))
        if self.max_length is not None:
            out.append((f"{self.column}_too_long",
                        F.coalesce(F.length(c) > self.max_length, F.lit(False))))
        return out


# The warehouse table definitions.
ARTICLES_CONTRACT = [
    Rule("article_title", not_null=True),
    Rule("publisher", not_null=True),
    Rule("publication_date", not_null=True),
    Rule("ticker", not_null=True, max_length=10),
    Rule("sentiment", not_null=True, max_length=10),
]
MARKET_DATA_CONTRACT = [
    Rule(c, max_length=255) for c in (
        "name", "market", "locale", "primary_exchange", "type", "currency_name", "cik", "ticker")
]


def _all_checks(rules: list[Rule]) -> list[tuple[str, Column]]:
    return [chk for rule in rules for chk in rule.checks()]


def with_violations(df: DataFrame, rules: list[Rule], name: str = "violations") -> DataFrame:
    """Add an array of the names of the rules each row breaks (empty = valid)."""
    checks = _all_checks(rules)
    flags = F.array(*[F.when(pred, F.lit(rule)) for rule, pred in checks]).cast("array<string>")
    return df.withColumn(name, F.filter(flags, lambda x: x.isNotNull()))


def split_by_contract(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``violations`` array)."""
    tagged = with_violations(df, rules)
    valid = tagged.where(F.size("violations") == 0).drop("violations")
    rejected = tagged.where(F.size("violations") > 0)
    return valid, rejected


def contract_report(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    """Rows ``(table_name, rule, n_rows)``: rows breaking each rule, and the
    ``valid`` count. One aggregate pass, then unpivot of the one-row result."""
    checks = _all_checks(rules)
    any_bad = F.lit(False)
    for _, pred in checks:
        any_bad = any_bad | pred
    aggs = [F.count(F.when(pred, 1)).alias(rule) for rule, pred in checks]
    aggs.append(F.count(F.when(~any_bad, 1)).alias("valid"))
    wide = df.agg(*aggs)
    names = [rule for rule, _ in checks] + ["valid"]
    long = wide.unpivot([], names, "rule", "n_rows")
    return long.select(F.lit(table).alias("table_name"), "rule", F.col("n_rows").cast("long"))
