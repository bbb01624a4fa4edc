"""Declarative rules: joined records to decisions with reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A rule is data: result column, inputs, condition, reason if it fails.

    A record that lacks one of the inputs passes.  Without a condition the rule
    always passes.
    """

    name: str
    reason: str
    needs: tuple[str, ...] = ()
    passes: str | None = None

    def column(self) -> Column:
        if self.passes is None:
            return F.lit(True).alias(self.name)
        missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.needs], F.lit(False))
        return F.when(missing, F.lit(True)).otherwise(F.expr(self.passes)).alias(self.name)

    def failed(self) -> Column:
        return ~F.coalesce(F.col(self.name), F.lit(True))


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    decisions: Sequence[str],
    failed_column: str = "reglas_fallidas",
    decision_column: str = "decision_final",
    reason_column: str = "motivos_revision",
    separator: str = " | ",
) -> DataFrame:
    """Add one column per rule, the number of failed rules, the decision, the reasons.

    ``decisions[i]`` is the decision for ``i`` failed rules, the last one for any
    larger number.  Two projections, no shuffle.
    """
    judged = df.select("*", *[r.column() for r in rules])
    failed = reduce(lambda a, b: a + b, [r.failed().cast("int") for r in rules])
    position = F.least(F.col(failed_column), F.lit(len(decisions) - 1)) + 1
    reasons = [F.when(r.failed(), F.lit(r.reason)) for r in rules]
    return judged.withColumn(failed_column, failed).withColumns(
        {
            decision_column: F.element_at(F.array(*[F.lit(d) for d in decisions]), position),
            reason_column: F.concat_ws(separator, *reasons),
        }
    )
