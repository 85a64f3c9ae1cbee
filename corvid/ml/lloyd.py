"""Lloyd steps from given centres, as plain DataFrame aggregations.

Spark's k-means chooses its own first centres; here they are stated, so a run can be
repeated and checked.  A step is one pass: each row goes to its nearest centre (ties to the
smaller number) by column expressions, the sums per centre are combined map-side, and only
the centres (``k`` rows) come back.

Defined cases: a centre without rows stays where it is; a null vector takes no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squared_distance(vector: str, centre: list[float]) -> Column:
    total = F.lit(0.0)
    for i, c in enumerate(centre):
        d = F.col(vector)[i] - F.lit(float(c))
        total = total + d * d
    return total


def assign(df: DataFrame, vector: str, centres: list[list[float]], out: str = "cluster") -> DataFrame:
    """``df`` plus the number of the nearest centre and the squared distance to it (``<out>_d2``)."""
    options = F.array(*[F.struct(squared_distance(vector, c).alias("d2"), F.lit(i).alias("number")) for i, c in enumerate(centres)])
    best = F.array_min(options)
    return df.filter(F.col(vector).isNotNull()).withColumn("__best", best).select(
        *[f"`{c}`" for c in df.columns], F.col("__best.number").alias(out), F.col("__best.d2").alias(f"{out}_d2"))


def lloyd(df: DataFrame, vector: str, centres: list[list[float]], steps: int) -> tuple[list[list[float]], list[float]]:
    """Centres after ``steps`` steps, and the within-set squared error before each step."""
    dim, errors = len(centres[0]), []
    centres = [list(map(float, c)) for c in centres]
    for _ in range(steps):
        near = assign(df, vector, centres)
        rows = near.groupBy("cluster").agg(F.sum("cluster_d2").alias("e"), *[F.avg(F.col(vector)[i]).alias(f"m{i}") for i in range(dim)]).collect()
        errors.append(sum(r["e"] for r in rows))
        for r in rows:
            centres[r["cluster"]] = [r[f"m{i}"] for i in range(dim)]
    return centres, errors
