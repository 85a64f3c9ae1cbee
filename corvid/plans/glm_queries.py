"""Gram entries and dropped columns, and the penalty path of a gamma regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.ml import glm
from corvid.plans.registry import query
from corvid.sources.tables import load_table

COLUMNS = ["quantity", "discount", "double_quantity", "tax", "net"]


def _rows(spark, sf):
    """Line items with two columns that the others explain: twice the quantity plus one, and discount less tax."""
    li = load_table(spark, sf, "lineitem")
    return li.select(F.concat_ws("|", "l_orderkey", "l_linenumber").alias("row_key"), F.col("l_extendedprice").alias("price"),
                     F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
                     (F.col("l_quantity") * 2 + 1).alias("double_quantity"), F.col("l_tax").alias("tax"),
                     (F.col("l_discount") - F.col("l_tax")).alias("net"))


_ROWS_SQL = """
WITH r AS (SELECT l_quantity AS quantity, l_discount AS discount, l_quantity * 2 + 1 AS double_quantity, l_tax AS tax,
                  l_discount - l_tax AS net FROM lineitem)"""


@query("gram_entries", _ROWS_SQL + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(sum({a} * {b}), 2) AS product FROM r"
    for i, a in enumerate(COLUMNS) for b in COLUMNS[i:]), ("M10",))
def q_gram_entries(spark, sf):
    return glm.gram_entries(_rows(spark, sf), COLUMNS).select("a", "b", F.round("product", 2).alias("product"))


@query("collinear_columns", _ROWS_SQL + """
SELECT 'quantity' AS name, false AS dropped UNION ALL SELECT 'discount', corr(discount, quantity) ** 2 > 1 - 1e-9 FROM r
UNION ALL SELECT 'double_quantity', corr(double_quantity, quantity) ** 2 > 1 - 1e-9 FROM r
UNION ALL SELECT 'tax', corr(tax, quantity) ** 2 > 1 - 1e-9 OR corr(tax, discount) ** 2 > 1 - 1e-9 FROM r
UNION ALL SELECT 'net', max(abs(net - (discount - tax))) < 1e-9 FROM r""", ("M10",))
def q_collinear_columns(spark, sf):
    """Which columns the ones before them explain."""
    kept = glm.independent_columns(glm.gram(_rows(spark, sf), COLUMNS))
    return spark.createDataFrame([(c, c not in kept) for c in COLUMNS], "name string, dropped boolean")


@query("gamma_path", None, ("M10",))
def q_gamma_path(spark, sf):
    """Prices by quantity and discount: every penalty with its deviance on training and held-out rows, the chosen one marked."""
    best, path, dropped = glm.gamma_path(_rows(spark, sf), "price", COLUMNS, "row_key")
    rows = [(f.penalty, f.steps, f.intercept, [float(b) for b in f.coefficients], f.columns, f.deviance, f.held_out,
             f.penalty == best.penalty, dropped) for f in path]
    return spark.createDataFrame(rows, "penalty double, steps int, intercept double, coefficients array<double>, columns array<string>, "
                                       "deviance double, held_out double, chosen boolean, dropped array<string>")
