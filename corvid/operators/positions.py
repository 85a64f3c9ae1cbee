"""Dense row positions and pairing of two collections by position.

A position comes from the row count per partition: rows are sorted by range
over all executors, numbered inside their partition, and shifted by the counts
of the partitions before.  Only one count per partition reaches the driver;
there is no window over all rows.

Defined cases: null order keys sort as Spark sorts them; rows that tie on every
order key may take each other's place, so give a key that decides; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.session import scratch_path

_ID = "__partition_row"
_PART = "__partition"
_LOCAL_BITS = 33          # fixed by monotonically_increasing_id: partition above, row number below


def with_positions(df: DataFrame, *order, col: str = "position") -> DataFrame:
    """``df`` plus a dense position from 0 in the given order (or the table's own order).

    The numbered rows are written to the shared scratch folder, so that a lost
    executor cannot number them differently.
    """
    spark = df.sparkSession
    ordered = df.orderBy(*order) if order else df
    path = scratch_path(spark, "positions")
    numbered = ordered.withColumn(_ID, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftrightunsigned(_ID, _LOCAL_BITS)
    counts = sorted((r[_PART], r["count"]) for r in rows.groupBy(part.alias(_PART)).count().collect())
    offsets, total = [], 0
    for number, count in counts:
        offsets.append((number, total))
        total += count
    starts = spark.createDataFrame(offsets, f"{_PART} long, __before long")
    # one row per partition of the sort, whatever the rows: a proven bound
    return (rows.withColumn(_PART, part).join(F.broadcast(starts), _PART)
            .withColumn(col, F.col("__before") + F.col(_ID).bitwiseAND((1 << _LOCAL_BITS) - 1))
            .select(*[f"`{c}`" for c in df.columns], col))


def pair_by_position(left: DataFrame, right: DataFrame, left_order, right_order, col: str = "position") -> DataFrame:
    """The i-th row of ``left`` beside the i-th row of ``right``; both must have as many rows.

    Column names of the two sides must differ.
    """
    a, b = with_positions(left, *left_order, col=col), with_positions(right, *right_order, col=col)
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"cannot pair {n} rows with {m} rows")
    return a.join(b, col)
