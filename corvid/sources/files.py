"""File readers S01-S13: every reader returns a lazy DataFrame.

Parsing is done with Spark column expressions (split / trim / cast /
``raise_error``), so rows are parsed in the executors, bad cells raise
(ANSI casts) and wrong cell counts raise, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The cell types a typed header may name.
HEADER_TYPES = {"string": T.StringType(), "integer": T.IntegerType(),
                "double": T.DoubleType(), "boolean": T.BooleanType()}
# Column names of the 9-field patient records.
PATIENT_COLUMNS = ("ID", "CAPSULE", "AGE", "RACE", "DPROS", "DCAPS", "PSA", "VOL", "GLEASON")

_MARK = "\u0001"


def parse_typed_header(line: str) -> T.StructType:
    """``name:type`` cells (trimmed) -> schema; unknown type raises."""
    fields = []
    for cell in line.split(","):
        parts = cell.strip().split(":")
        if len(parts) != 2 or parts[1] not in HEADER_TYPES:
            raise ValueError(f"bad typed header cell: {cell!r}")
        fields.append(T.StructField(parts[0], HEADER_TYPES[parts[1]], True))
    return T.StructType(fields)


def _raw_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Every line of the files, blank ones too, as one string column; lines equal to ``header`` are dropped."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines.filter(F.col("line") != header) if header is not None else lines


def cells(line: Column, sep: str = ",", trim: bool = True) -> Column:
    import re
    parts = F.split(line, re.escape(sep), -1)
    return F.transform(parts, lambda x: F.trim(x)) if trim else parts


def typed_cells(arr: Column, schema: T.StructType) -> list[Column]:
    """Cells -> typed columns: empty cell = null."""
    out = []
    for i, f in enumerate(schema.fields):
        cell = F.try_element_at(arr, F.lit(i + 1))
        v = cell if isinstance(f.dataType, T.StringType) else cell.cast(f.dataType)
        out.append(F.when(cell == "", F.lit(None).cast(f.dataType)).otherwise(v).alias(f.name))
    return out


def row_check(arr: Column, line: Column, schema: T.StructType) -> Column:
    """A filter condition that raises on a wrong cell count or a cell that is
    not valid text for its type.  As a filter it is evaluated for every row
    even when later steps prune the bad column -- like the reference, which
    parses the whole row when it loads it."""
    n = len(schema.fields)
    bad = F.size(arr) != n
    for i, f in enumerate(schema.fields):
        if isinstance(f.dataType, T.StringType):
            continue
        cell = F.try_element_at(arr, F.lit(i + 1))
        bad = bad | ((F.size(arr) == n) & (cell != "") & cell.try_cast(f.dataType).isNull())
    return F.when(bad, F.raise_error(F.concat(F.lit("bad typed row: "), line))).otherwise(F.lit(True))


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed-header CSV (first line ``name:type,...``)."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"empty file: {path}")
    schema = parse_typed_header(first[0])
    raw = _raw_lines(spark, path, header=first[0])
    arr = cells(F.col("line"))
    return raw.filter(row_check(arr, F.col("line"), schema)).select(*typed_cells(arr, schema))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (column ``value``)."""
    return spark.read.text(path)


def read_delimited_strings(spark: SparkSession, path: str, names, sep: str = ",") -> DataFrame:
    """Header-less delimited text -> named all-string columns
    (trailing empties kept, cells trimmed; too few cells raise)."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    raw = _raw_lines(spark, path)
    arr = cells(F.col("line"), sep)
    enough = F.when(F.size(arr) < len(names), F.raise_error(
        F.concat(F.lit("too few cells: "), F.col("line")))).otherwise(F.lit(True))
    return raw.filter(enough).select(*[F.try_element_at(arr, F.lit(i + 1)).alias(f.name) for i, f in enumerate(schema.fields)])


def read_numeric_csv(spark: SparkSession, path: str, names: str = "y x") -> DataFrame:
    """Positional numeric CSV, names from a blank-separated string."""
    return _checked(spark, path, T.StructType([T.StructField(n, T.DoubleType()) for n in names.split()]))


def _checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma-separated typed rows; a bad row raises whichever columns are read later."""
    arr = cells(F.col("line"))
    return _raw_lines(spark, path).filter(row_check(arr, F.col("line"), schema)).select(*typed_cells(arr, schema))


def _vec(arr: Column) -> Column:
    from pyspark.ml.functions import array_to_vector
    return array_to_vector(arr.cast("array<double>"))


def read_labeled_points(spark: SparkSession, path: str) -> DataFrame:
    """``label,f1 f2 ...`` lines -> (label double, features vector)."""
    raw = spark.read.text(path)
    parts = F.split("value", ",", 2)
    feats = F.split(F.trim(F.element_at(parts, 2)), " +")
    return raw.select(F.element_at(parts, 1).cast("double").alias("label"), _vec(feats).alias("features"))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM text."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def read_dense_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated dense vectors -> (features vector)."""
    raw = spark.read.text(path)
    return raw.select(_vec(F.split(F.trim("value"), " +")).alias("features"))


def read_tab_pairs(spark: SparkSession, path: str, names=("target", "text")) -> DataFrame:
    """Tab-separated (label, text); rows with an empty label dropped."""
    from corvid.functions.text import java_split
    raw = _raw_lines(spark, path)
    parts = java_split("line", "\t")  # like String.split: trailing empty cells vanish
    df = raw.select(F.element_at(parts, 1).alias(names[0]), parts.alias("_p"), "line")
    df = df.filter(F.col(names[0]) != "")
    text = F.when(F.size("_p") < 2, F.raise_error(F.concat(F.lit("no text cell: "), F.col("line")))) \
        .otherwise(F.element_at("_p", 2))
    return df.select(names[0], text.alias(names[1]))


def read_csv_drop_header(spark: SparkSession, path: str, marker: str = "category",
                         names=("category", "title")) -> DataFrame:
    """Drop lines containing ``marker`` (the header) and take the first cells."""
    from corvid.functions.text import java_split
    raw = _raw_lines(spark, path).filter(~F.col("line").contains(marker))
    parts = java_split("line", ",")  # like String.split: trailing empty cells vanish
    parts = F.when(F.size(parts) < len(names), F.raise_error(
        F.concat(F.lit("too few cells: "), F.col("line")))).otherwise(parts)
    return raw.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def read_csv_valid_rows(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """Typed CSV (quoted cells allowed) keeping only rows all of whose cells parse, whichever
    columns are read later; ``header`` drops the lines equal to the first one."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    first = spark.read.text(path).first() if header else None
    lines = _raw_lines(spark, path, first[0] if first else None).filter(F.trim("line") != "")
    n = len(schema.fields)
    # a mark as one more cell: it lands in column n exactly if the line has n cells, empty ones included
    names = ", ".join(f"c{i} string" for i in range(n + 1))
    rows = lines.select(F.from_csv(F.concat("line", F.lit(f",{_MARK}")), names).alias("r"))
    good, out = F.col(f"r.c{n}") == _MARK, []
    for i, f in enumerate(schema.fields):
        cell = F.trim(F.col(f"r.c{i}"))
        typed = cell.try_cast(f.dataType)
        good = good & (cell.isNull() | (cell == "") | typed.isNotNull())
        out.append(F.when(cell != "", typed).alias(f.name))
    return rows.filter(good).select(*out)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV (gz fine), schema inferred -- an extra pass; prefer a schema at scale."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    """9-field patient records."""
    return _checked(spark, path, T.StructType([T.StructField(n, T.DoubleType()) for n in PATIENT_COLUMNS]))


def rows_to_table(spark: SparkSession, rows, schema) -> DataFrame:
    """Small in-memory rows -> table (driver-side literal data only)."""
    return spark.createDataFrame(rows, schema)


def clean_names(df: DataFrame) -> DataFrame:
    """Trim names, blank and '+' -> '_'."""
    return df.toDF(*[c.strip().replace(" ", "_").replace("+", "_") for c in df.columns])


def drop_position(df: DataFrame, i: int) -> DataFrame:
    """Drop the column at position ``i``."""
    return df.drop(df.columns[i])
