"""One regression tree per key, for all keys at once.

The reference trains a tree per artist, one after the other or in parallel
futures.  Here all trees grow together, level by level: rows carry the number of
their node (root 1, children 2n and 2n + 1), one grouped aggregation per level
gives the histogram (key, node, feature, bin) with count and sum (sums of squares
cancel in a gain), and the best split per (key, node) is found on the histogram.  Map-side partial
aggregation makes a row per (key, node, feature, bin) and task, so a key that holds
a third of all rows burdens no task; no loop runs over keys.

Bins: ``bins`` equal parts between a feature's least and greatest value of the key.
A split (feature, bin) sends rows with a bin up to its own to the left.  Of equal
gains (the fall of the summed squared error) the feature listed first wins, then the
smaller bin.

Defined cases: a null or NaN feature is in bin 0; a null label takes no part in
training; a feature with one value cannot split; a key without labels has no tree and
gets no prediction (null); an empty table gives no trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.session import scratch_path

MIN_GAIN = 1e-9


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((x - lo) / F.when(hi > lo, hi - lo) * bins).cast("int")))
    return F.when(x.isNull() | F.isnan(x) | lo.isNull() | (hi <= lo), 0).otherwise(at).cast("int")


def _value(col: str) -> Column:
    """A feature as double, NaN as null, so that least and greatest are real values."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def binned(df: DataFrame, ranges: DataFrame, key: str, features: list[str], bins: int) -> DataFrame:
    """``df`` plus ``__bins``: the bin of every feature within its key's ranges (all 0 without)."""
    lo_hi = ranges.withColumnRenamed(key, "__key")
    parts = F.array(*[_bin(_value(c), F.col("__lo")[i], F.col("__hi")[i], bins) for i, c in enumerate(features)])
    return (df.join(lo_hi, F.col(key) == F.col("__key"), "left")
            .withColumn("__bins", parts).drop("__key", "__lo", "__hi"))


def key_ranges(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    """``key, __lo, __hi``: least and greatest value of every feature."""
    return df.groupBy(key).agg(F.array(*[F.min(_value(c)) for c in features]).alias("__lo"),
                               F.array(*[F.max(_value(c)) for c in features]).alias("__hi"))


def best_splits(rows: DataFrame, key: str, features: list[str], bins: int, min_rows: int = 1) -> DataFrame:
    """The best split per (key, node): ``feature`` (number), ``bin, gain, n_left, n_right``.

    ``rows``: key, ``node``, ``__bins`` and ``label``.  The running sums go over the
    bins of one (key, node, feature): at most ``bins`` rows a window.
    """
    hist = (rows.select(key, "node", "label", F.posexplode("__bins").alias("feature", "bin"))
            .groupBy(key, "node", "feature", "bin").agg(F.count("label").alias("n"), F.sum("label").alias("s")))
    group = Window.partitionBy(key, "node", "feature")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select("*", F.sum("n").over(upto).alias("n_left"), F.sum("s").over(upto).alias("s_left"),
                       F.sum("n").over(group).alias("n_all"), F.sum("s").over(group).alias("s_all"))
    n_right, s_right = F.col("n_all") - F.col("n_left"), F.col("s_all") - F.col("s_left")
    # n_left and n_right are positive where it counts
    gain = (F.col("s_left") * F.col("s_left") / F.col("n_left")
            + F.when(n_right > 0, s_right * s_right / n_right).otherwise(0.0)
            - F.col("s_all") * F.col("s_all") / F.col("n_all"))
    cut = (sums.select(key, "node", "feature", "bin", "n_left", n_right.alias("n_right"), gain.alias("gain"))
           .filter((F.col("n_left") >= min_rows) & (F.col("n_right") >= min_rows) & (F.col("gain") > MIN_GAIN)))
    pick = F.max_by(F.struct("feature", "bin", "gain", "n_left", "n_right"), F.struct("gain", -F.col("feature"), -F.col("bin")))
    return cut.groupBy(key, "node").agg(pick.alias("p")).select(key, "node", "p.*")


def grow(df: DataFrame, key: str, label: str, features: list[str], depth: int = 5, bins: int = 32,
         min_rows: int = 1) -> DataFrame:
    """One row per key: ranges and the nodes of its tree.

    ``__lo, __hi``, ``splits`` (map node -> feature and bin) and ``means`` (map node ->
    mean label); at most 2^(depth + 1) entries a key.
    """
    rows = df.select(key, F.col(label).cast("double").alias("label"), *features).filter(F.col("label").isNotNull())
    ranges = _stored(key_ranges(rows, key, features), "tree_ranges")
    at = _stored(binned(rows, ranges, key, features, bins).select(key, "label", "__bins").withColumn("node", F.lit(1)), "tree_rows")
    splits = means = None
    for level in range(depth + 1):
        mean = _stored(at.groupBy(key, "node").agg(F.avg("label").alias("mean"), F.count("label").alias("n")), "tree_means")
        means = mean if means is None else means.unionByName(mean)
        if level == depth:
            break
        best = _stored(best_splits(at, key, features, bins, min_rows), "tree_splits")
        if best.isEmpty():
            break
        splits = best if splits is None else splits.unionByName(best)
        chosen = best.select(F.col(key).alias("__key"), F.col("node").alias("__node"), "feature", "bin")
        right = F.element_at("__bins", F.col("feature") + 1) > F.col("bin")
        # rows of a node without a split are done
        at = _stored(at.join(chosen, (F.col(key) == F.col("__key")) & (F.col("node") == F.col("__node")))
                     .select(key, "label", "__bins", (F.col("node") * 2 + right.cast("int")).alias("node")), "tree_rows")
    tree = means.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("node", "mean"))).alias("means"))
    if splits is None:
        splits = best_splits(at, key, features, bins, min_rows)
    inner = splits.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("node"), F.struct("feature", "bin")))).alias("splits"))
    return ranges.join(tree, key).join(inner, key, "left")


def predict(trees: DataFrame, df: DataFrame, key: str, features: list[str], depth: int = 5, bins: int = 32,
            out: str = "prediction") -> DataFrame:
    """``df`` plus the mean label of the leaf each row falls into (null for a key without a tree)."""
    names = df.columns
    both = binned(df, trees.select(key, "__lo", "__hi"), key, features, bins)
    both = both.join(trees.select(F.col(key).alias("__key"), "splits", "means"), F.col(key) == F.col("__key"), "left")
    leaf = F.expr(f"""aggregate(sequence(1, {depth}), 1, (node, level) ->
        case when splits[node] is null then node
             else node * 2 + cast(__bins[splits[node].feature] > splits[node].bin as int) end)""")
    return both.withColumn("__leaf", leaf).select(*[f"`{c}`" for c in names], F.expr("means[__leaf]").alias(out))
