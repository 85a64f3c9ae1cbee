"""A fitted linear model as a column expression.

The exported model is a few numbers; scoring a table of events is a plain projection, so it
needs no model object, no Python worker and no shuffle, and can be sent to another engine.

Defined cases: a null feature makes the score null; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearModel:
    """Coefficients by column name, and the intercept."""

    coefficients: dict[str, float]
    intercept: float

    def margin(self) -> Column:
        """Intercept plus coefficient times column, added up in the order of the coefficients."""
        total = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            total = total + F.lit(weight) * F.col(name).cast("double")
        return total

    def probability(self) -> Column:
        """Probability of class 1 of a logistic model."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def export_linear(model, columns: list[str]) -> LinearModel:
    """From a fitted binary logistic, linear or generalized linear model whose features were ``columns`` in this order."""
    return LinearModel({c: float(w) for c, w in zip(columns, model.coefficients.toArray(), strict=True)}, float(model.intercept))


def score_events(events: DataFrame, model: LinearModel, out: str = "p") -> DataFrame:
    """``events`` (already enriched) plus the probability of class 1."""
    return events.withColumn(out, model.probability())


def flag_below(p: str | Column, threshold: float = 0.5, low: str = "spam", high: str = "ham") -> Column:
    """``low`` where the score is under the threshold, ``high`` from it on; a null score stays null."""
    col = F.col(p) if isinstance(p, str) else p
    return F.when(col < threshold, low).when(col >= threshold, high)
