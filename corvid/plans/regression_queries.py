"""Closed-form one-feature regression (M06, A14, M01 metrics, M27 residuals)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import regression as reg
from corvid.plans.registry import query
from corvid.sources.tables import load_table

_COEF = """coef AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope,
                         regr_intercept(l_extendedprice, l_quantity) AS intercept
                  FROM lineitem GROUP BY l_returnflag)"""


def _fit(spark, sf):
    li = load_table(spark, sf, "lineitem")
    return li, reg.fit_line(li, "l_quantity", "l_extendedprice", by="l_returnflag")


@query("linear_one_feature", f"""
WITH {_COEF}
SELECT l_returnflag, round(slope, 6) AS slope, round(intercept, 4) AS intercept,
       round(avg(power(l_extendedprice - (intercept + slope * l_quantity), 2)), 0) AS mse
FROM lineitem JOIN coef USING (l_returnflag) GROUP BY l_returnflag, slope, intercept""",
       ("M06", "A14", "F14"))
def q_linear_one_feature(spark, sf):
    li = load_table(spark, sf, "lineitem")
    m = reg.metrics(li, "l_quantity", "l_extendedprice", by="l_returnflag")
    return m.select("l_returnflag", F.round("slope", 6).alias("slope"),
                    F.round("intercept", 4).alias("intercept"), F.round("mse", 0).alias("mse"))


@query("regression_metrics", f"""
WITH {_COEF},
e AS (SELECT l_returnflag, l_extendedprice AS y, intercept + slope * l_quantity AS p FROM lineitem JOIN coef USING (l_returnflag))
SELECT l_returnflag, count(*) AS n, round(sqrt(avg(power(y - p, 2))), 3) AS rmse,
       round(1 - sum(power(y - p, 2)) / sum(power(y - (SELECT avg(l_extendedprice) FROM lineitem li
                                                     WHERE li.l_returnflag = e.l_returnflag), 2)), 6) AS r2
FROM e GROUP BY l_returnflag""", ("M01",))
def q_regression_metrics(spark, sf):
    li = load_table(spark, sf, "lineitem")
    m = reg.metrics(li, "l_quantity", "l_extendedprice", by="l_returnflag")
    return m.select("l_returnflag", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("residuals", f"""
WITH {_COEF}
SELECT l_orderkey, l_linenumber, l_extendedprice AS label,
       round(intercept + slope * l_quantity - l_extendedprice, 2) AS residual
FROM lineitem JOIN coef USING (l_returnflag)""", ("M27",))
def q_residuals(spark, sf):
    li, coef = _fit(spark, sf)
    r = reg.residuals(li, coef, "l_quantity", "l_extendedprice", by="l_returnflag")
    return r.select("l_orderkey", "l_linenumber", "label", F.round("residual", 2).alias("residual"))
