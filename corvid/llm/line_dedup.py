"""Line dedup: a suffix array over line-id sequences (DataFrame functions only).

A repeated run is deleted where it is a later copy and holds at least ``MIN_WORDS``
words; blank lines weigh nothing, so a single long line is a run and a stack of blank
or very short lines is not.  (With ``min_run`` a run needs so many lines instead.)

1. Every line gets a 128-bit hash; lines that occur once cannot be part of a
   repeated run and drop out at once.
2. Prefix doubling: the suffixes that start at a line are ranked by their first
   1, 2, 4, ... lines.  A round pairs the rank of a suffix with that of the
   suffix ``h`` lines on (an equi-join on row and line number, so no key is hot),
   counts the distinct pairs (combined map-side), drops pairs that occur once -
   their common prefix with any other suffix ends here - and numbers the rest
   in sorted order by a range-partitioned sort of the distinct pairs.  Doubling goes
   on until no rank repeats or no run to be judged is longer.
3. A line's run is the shortest one from it, and the shortest one up to it, that is
   heavy enough (two windows over a row's own lines).  Any repeated run that is heavy
   enough is the union of such runs inside it.  Runs of 2^j to 2^(j+1) - 1 lines are
   equal if the ranks of their first and of their last 2^j lines are: the intervals
   of the suffix array whose longest common prefix covers the run.
4. Of equal runs the first by (id, row, line) stays; the lines of later copies are
   deleted, overlapping and touching ones as one maximal stretch.

Defined cases: lines end at LF; a null text counts as empty, an empty text is one
empty line; a null id sorts first; repeated rows are copies of each other; a
text lighter than the threshold loses nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvid.llm.common import RID, numbered, store

MIN_WORDS = 20
WORD = r"[^\x20\x09-\x0D]+"


def line_rows(rows: DataFrame, by_words: bool = True) -> DataFrame:
    """(``__rid``, ``__id``, ``pos``, ``k1``, ``k2``, ``weight``): the hashed lines of numbered rows."""
    lines = rows.select(RID, "__id", F.posexplode(F.split("__text", "\n")).alias("pos", "line"))
    weight = F.regexp_count("line", F.lit(WORD)) if by_words else F.lit(1)
    return lines.select(RID, "__id", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(7), "line").alias("k2"),
                        weight.cast("long").alias("weight"))


def heavy_runs(lines: DataFrame, least: int) -> DataFrame:
    """(``__rid``, ``__id``, ``pos``, ``k`` lines): from every line the shortest run of weight ``least``, and up to every line.

    Both are found by sorting a row's line bounds by the weight before them, its own bounds beside those shifted by
    ``least``: a running minimum (maximum) of the bounds passed is the other end.  A row's lines are bounded by its text.
    """
    whole = Window.partitionBy(RID).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    upto = lines.select(RID, "__id", "pos", "weight", F.sum("weight").over(whole).alias("after"))
    bounds = upto.select(RID, "__id", "pos", (F.col("after") - F.col("weight")).alias("before"))
    ends = upto.groupBy(RID).agg(F.first("__id").alias("__id"), (F.max("pos") + 1).alias("pos"), F.max("after").alias("before"))
    bounds = bounds.unionByName(ends)
    nothing = F.lit(None).cast("int")

    def other_end(shift: int, order, pick):
        asked = bounds.select(RID, "__id", (F.col("before") + shift).alias("at"), nothing.alias("bound"), F.col("pos").alias("own"))
        given = bounds.select(RID, "__id", F.col("before").alias("at"), F.col("pos").alias("bound"), nothing.alias("own"))
        passed = Window.partitionBy(RID).orderBy(order("at"), F.asc_nulls_first("own")).rowsBetween(Window.unboundedPreceding, 0)
        found = given.unionByName(asked).withColumn("other", pick("bound").over(passed))
        return found.filter("own is not null and other is not null")

    heads = other_end(least, F.desc, F.min).select(RID, "__id", F.col("own").alias("pos"), (F.col("other") - F.col("own")).alias("k"))
    tails = other_end(-least, F.asc, F.max).select(RID, "__id", F.col("other").alias("pos"), (F.col("own") - F.col("other")).alias("k"))
    return heads.unionByName(tails).distinct()


def ranked(suffixes: DataFrame) -> DataFrame:
    """Suffixes whose key (``k1``, ``k2``) occurs again, with ``rank`` in key order and the ``first`` holder of the key."""
    keys = (suffixes.groupBy("k1", "k2")
            .agg(F.count("*").alias("n"), F.min(F.struct("__id", RID, "pos")).alias("first")).filter("n > 1"))
    keys = (keys.orderBy("k1", "k2")
            .select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "first",
                    F.monotonically_increasing_id().alias("rank")))
    keys = store(keys, "line_ranks")
    return (suffixes.join(keys, (F.col("k1") == F.col("__k1")) & (F.col("k2") == F.col("__k2")))
            .select(RID, "__id", "pos", "rank", "first"))


def later_copies(rows: DataFrame, least: int, by_words: bool = True) -> DataFrame:
    """(``__rid``, ``pos``, ``k``) of the heavy runs that are copies of an earlier one."""
    lines = store(line_rows(rows, by_words), "lines")
    runs = store(heavy_runs(lines, least), "line_heavy")
    longest = runs.agg(F.max("k")).first()[0]
    suffixes, h, out = store(ranked(lines.drop("weight")), "suffixes"), 1, None
    while longest is not None and h <= longest and not suffixes.isEmpty():
        # runs of h to 2h - 1 lines: their first h and their last h lines
        some = runs.filter((F.col("k") >= h) & (F.col("k") < 2 * h))
        first = suffixes.select(F.col(RID).alias("__r"), F.col("pos").alias("__p"), F.col("rank").alias("r1"))
        last = suffixes.select(F.col(RID).alias("__r2"), F.col("pos").alias("__p2"), F.col("rank").alias("r2"))
        known = (some.join(first, (F.col(RID) == F.col("__r")) & (F.col("pos") == F.col("__p")))
                 .join(last, (F.col(RID) == F.col("__r2")) & (F.col("pos") + F.col("k") - h == F.col("__p2")))
                 .select(RID, "__id", "pos", "k", "r1", "r2"))
        known = store(known, "line_runs")
        owner = (known.groupBy("k", "r1", "r2").agg(F.count("*").alias("n"), F.min(F.struct("__id", RID, "pos")).alias("first"))
                 .filter("n > 1").select(F.col("k").alias("__k"), F.col("r1").alias("__r1"), F.col("r2").alias("__r2"), "first"))
        later = (known.join(owner, (F.col("k") == F.col("__k")) & (F.col("r1") == F.col("__r1")) & (F.col("r2") == F.col("__r2")))
                 .filter(F.col("first") != F.struct("__id", RID, "pos")).select(RID, "pos", "k"))
        later = store(later, "line_later")
        out = later if out is None else out.unionByName(later)
        h *= 2
        if h > longest:
            break
        ahead = suffixes.select(F.col(RID).alias("__r"), (F.col("pos") - h // 2).alias("__p"), F.col("rank").alias("k2"))
        pairs = (suffixes.join(ahead, (F.col(RID) == F.col("__r")) & (F.col("pos") == F.col("__p")))
                 .select(RID, "__id", "pos", F.col("rank").alias("k1"), "k2"))
        suffixes = store(ranked(store(pairs, "line_pairs")), "suffixes")
    return out if out is not None else runs.select(RID, "pos", "k").limit(0)


def stretches(copies: DataFrame) -> DataFrame:
    """Maximal stretches of lines in later copies: ``__rid``, ``runs`` (sorted array of ``start``, ``stop``)."""
    by_row = Window.partitionBy(RID).orderBy("pos", "k")      # a row's own lines: bounded by its text
    before = by_row.rowsBetween(Window.unboundedPreceding, -1)
    ends = copies.withColumn("stop", F.col("pos") + F.col("k"))
    opens = F.coalesce(F.col("pos") > F.max("stop").over(before), F.lit(True))
    runs = (ends.withColumn("__opens", opens.cast("int")).withColumn("__run", F.sum("__opens").over(by_row))
            .groupBy(RID, "__run").agg(F.min("pos").alias("start"), F.max("stop").alias("stop")))
    return runs.groupBy(RID).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def drop_later_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    min_run: int | None = None) -> DataFrame:
    """``id_col, n_lines, n_removed, n_runs, kept_text`` per row; ``min_run`` asks for so many lines in place of words."""
    rows = numbered(df, id_col, text_col)
    copies = later_copies(rows, min_words) if min_run is None else later_copies(rows, min_run, by_words=False)
    runs = store(stretches(copies), "line_stretches")
    joined = (rows.join(runs.withColumnRenamed(RID, "__r"), F.col(RID) == F.col("__r"), "left")
              .withColumn("lines", F.split("__text", "\n"))
              .withColumn("runs", F.coalesce("runs", F.array().cast(runs.schema["runs"].dataType))))
    n = F.size("lines")
    # the lines between removed runs: from the end of one run (or 0) to the start of the next (or the end)
    starts = F.concat(F.transform("runs", lambda r: r["start"]), F.array(n))
    stops = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["stop"]))
    kept = F.flatten(F.transform(F.arrays_zip(stops.alias("a"), starts.alias("b")),
                                 lambda g: F.slice("lines", g["a"] + 1, g["b"] - g["a"])))
    removed = F.aggregate("runs", F.lit(0), lambda t, r: t + r["stop"] - r["start"])
    return joined.select(F.col("__id").alias(id_col), n.cast("long").alias("n_lines"),
                         removed.cast("long").alias("n_removed"), F.size("runs").cast("long").alias("n_runs"),
                         F.when(F.size("runs") == 0, F.col("__text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))
