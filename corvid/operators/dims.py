"""Keep rows whose key (or key pair) is in a dimension.

One rule whatever the number of keys: keys take the type of the column they are
compared with (a key that is no value of that type matches nothing), null keys
and null cells never match.  Keys held by the caller are literals, so Catalyst
can push the predicate into the Parquet scan; a key table is a LEFT SEMI join,
whose physical form the planner and AQE choose from byte sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _literals(values, dtype) -> list[Column]:
    return [F.lit(v).try_cast(dtype) for v in values if v is not None]


def _key_table(keys: DataFrame, df: DataFrame, names: list[str]) -> DataFrame:
    """The first columns of ``keys`` under the names and types of the columns of ``df``."""
    cols = [F.col(f"`{k}`").try_cast(df.schema[n].dataType).alias(n) for k, n in zip(keys.columns, names)]
    return keys.select(*cols).dropna()


def filter_dimension(df: DataFrame, keys, name: str) -> DataFrame:
    """One key column; ``keys`` is a list (none: no rows) or a table's first column."""
    if isinstance(keys, DataFrame):
        return df.join(_key_table(keys, df, [name]), name, "left_semi")
    return df.filter(F.col(name).isin(_literals(keys, df.schema[name].dataType)))


def filter_dimension_pairs(df: DataFrame, keys, name1: str, name2: str) -> DataFrame:
    """Membership of two columns in a list of pairs or the first two columns of a table."""
    names = [name1, name2]
    if isinstance(keys, DataFrame):
        return df.join(_key_table(keys, df, names), names, "left_semi")
    types = [df.schema[n].dataType for n in names]
    pairs = [F.struct(*[F.lit(v).try_cast(t).alias(n) for v, t, n in zip(pair, types, names)])
             for pair in keys if None not in pair]
    return df.filter(F.col(name1).isNotNull() & F.col(name2).isNotNull() & F.struct(*names).isin(pairs))


# Named presets; one key may be given without a list.
def filter_products(df: DataFrame, keys, name: str = "productKey") -> DataFrame:
    return filter_dimension(df, [keys] if isinstance(keys, (str, int)) else keys, name)


def filter_locations(df: DataFrame, keys, name: str = "locationKey") -> DataFrame:
    return filter_dimension(df, [keys] if isinstance(keys, (str, int)) else keys, name)


def filter_nodes(df: DataFrame, keys, name1: str = "nodeKey", name2: str = "nodeTypeFlag") -> DataFrame:
    return filter_dimension_pairs(df, keys, name1, name2)
