"""Named row rules. A rule that is NULL for a row has failed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_all(df: DataFrame, rules: Rules, action: str = "drop") -> DataFrame:
    """``drop`` removes rows that fail any rule, ``fail`` raises on the first one,
    ``warn`` keeps them and lists the failed rules in ``failed_rules``."""
    if action == "drop":
        for rule in rules.values():
            df = df.where(passes(rule))
        return df
    failed = F.array_compact(
        F.array(*[F.when(~passes(rule), F.lit(name)) for name, rule in rules.items()])
    )
    if action == "warn":
        return df.withColumn("failed_rules", failed)
    if action == "fail":
        message = F.concat(F.lit("row fails: "), F.array_join(failed, ", "))
        return df.where(F.when(F.size(failed) == 0, True).otherwise(F.raise_error(message)))
    raise ValueError("action is 'drop', 'warn' or 'fail'")


def expect_all_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    return expect_all(df, rules, "drop")


def rule_counts(rules: Rules) -> list[Column]:
    """Failure counts for ``DataFrame.observe``, which also works on streams."""
    return [F.count_if(~passes(rule)).alias(name) for name, rule in rules.items()]


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Passed and failed rows per rule, all rules in one pass."""
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("rule"),
                    F.count_if(passes(rule)).alias("passed"),
                    F.count_if(~passes(rule)).alias("failed"),
                )
                for name, rule in rules.items()
            ]
        ).alias("r")
    )
    return counts.select(F.inline("r"))
