"""Group counts under a predicate and the rate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(df: DataFrame, by, cond: Column, name: str = "n", all_name: str = "n_rows") -> DataFrame:
    """Per group, the number of rows meeting ``cond`` and of all rows."""
    return df.groupBy(by).agg(F.count_if(cond).alias(name), F.count(F.lit(1)).alias(all_name))


def rate_table(df: DataFrame, type_col: str, flag: Column) -> DataFrame:
    """Per type: rate = flagged/total, flagged, total, flagged share of
    all flagged rows, flagged share of all rows, type share of all rows.

    Types without a flagged row and the null type are absent; the global
    totals count every row (null type included), as the reference does.
    Sorted by rate descending.  ("flagged to all rows" is computed as the
    evident intent, flagged / all rows; the reference divides by the type
    total there, which repeats the rate.)

    One grouped pass (map-side partial aggregation) gives the per-type counts;
    the two totals are scalar subqueries over it, whose exchange Spark reuses.
    """
    per = count_where(df, type_col, flag, "num_flagged", "num_rows")
    all_flagged = per.agg(F.sum("num_flagged").cast("double")).scalar()
    all_rows = per.agg(F.sum("num_rows").cast("double")).scalar()
    out = (per.filter((F.col("num_flagged") > 0) & F.col(type_col).isNotNull())
           .select(F.col(type_col),
                   (F.col("num_flagged") / F.col("num_rows")).alias("rate"),
                   "num_flagged", "num_rows",
                   (F.col("num_flagged") / all_flagged).alias("flagged_to_all_flagged"),
                   (F.col("num_flagged") / all_rows).alias("flagged_to_all_rows"),
                   (F.col("num_rows") / all_rows).alias("rows_to_all_rows")))
    return out.orderBy(F.col("rate").desc(), F.col(type_col))
