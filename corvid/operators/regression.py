"""One-feature least squares in closed form, per group.

Fit and fit quality come from ONE grouped aggregation of the ``regr_*`` sums
(partial aggregation, one scan); only residuals need the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_line(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Slope and intercept, per group or overall."""
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept")]
    return (df.groupBy(by) if by else df.groupBy()).agg(*aggs)


def residuals(df: DataFrame, coef: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Label and prediction minus label per row."""
    if by:
        scored = df.join(coef, by).withColumn("prediction", F.col("intercept") + F.col("slope") * F.col(x))
    else:
        slope, intercept = coef.select("slope").scalar(), coef.select("intercept").scalar()
        scored = df.withColumn("prediction", intercept + slope * F.col(x))
    return scored.withColumn("label", F.col(y)).withColumn("residual", F.col("prediction") - F.col(y))


def metrics(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Slope, intercept, n, MSE, RMSE and r^2 per group (r^2 null where the label is constant)."""
    cy, cx = F.col(y), F.col(x)
    sums = [F.regr_count(cy, cx).alias("n"), F.regr_slope(cy, cx).alias("slope"),
            F.regr_intercept(cy, cx).alias("intercept"), F.regr_sxx(cy, cx).alias("_sxx"),
            F.regr_syy(cy, cx).alias("_syy"), F.regr_sxy(cy, cx).alias("_sxy")]
    out = (df.groupBy(by) if by else df.groupBy()).agg(*sums)
    explained = F.coalesce(F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx")), F.lit(0.0))
    sse = F.greatest(F.col("_syy") - explained, F.lit(0.0))
    return (out.withColumn("mse", F.try_divide(sse, F.col("n"))).withColumn("rmse", F.sqrt("mse"))
            .withColumn("r2", F.try_divide(explained, F.col("_syy"))).drop("_sxx", "_syy", "_sxy"))
