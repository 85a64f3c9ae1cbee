"""Daily activity per artist (music-activity family).

Input layout follows the reference data model: *songs* (song_id, artist_id,
publish_time yyyyMMdd, song_init_plays, Language, Gender — all text) and
*actions* (user_id, song_id, gmt_create, action_type, Ds yyyyMMdd — all
text).  Action type 1 = play, 2 = download, 3 = favour.

Plan shape (A08): one scan of the actions, one equi-join with the songs on
``song_id`` and ONE aggregation on (artist_id, Ds) with conditional counts.
The aggregation has a map-side partial step, so only one row per
(artist, day, task) crosses the shuffle even if one artist owns a third of
all actions.  Song attributes are parsed once per song, before the join;
whether the songs are broadcast is left to the planner and AQE, which also
splits a hot song's partition of a shuffled join.  ``Ds`` may be a date column
too: days are then grouped as dates and only the result is formatted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.dates import add_days_ymd, age_bucket, days_since, reformat_ymd, ymd_to_date

# The reference's action codes.
PLAY, DOWNLOAD, FAVOUR = "1", "2", "3"
# Fixed value: the test-day rule of the forecast split.
TEST_DAYS = "day_num >= 150 or (day_num < 150 and day_num % 2 = 0)"


def _num(c: str):
    """Numeric view of a text column; bad text raises under ANSI (cast)."""
    return F.col(c).cast("double")


def _is_date(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.simpleString() == "date"


def _joined(songs: DataFrame, actions: DataFrame, types, published_only: bool = False) -> DataFrame:
    s = songs.select("song_id", "artist_id", "publish_time", "song_init_plays",
                     "Language", "Gender")
    a = actions.select("song_id", "action_type", "Ds", "gmt_create") \
        .filter(F.col("action_type").isin(*types))
    # Inner equi-join on the song id.
    j = a.join(s, "song_id", "inner")
    if published_only:
        # The reference's (disabled) time-order predicate, as an option
        j = j.filter(F.col("publish_time") >= F.col("Ds"))
    return j


def daily_activity(songs: DataFrame, actions: DataFrame, origin: str = "2015-03-01",
                   require_plays: bool = True, published_only: bool = False) -> DataFrame:
    """A08 in one pass: plays / downloads / favours per (artist, day).

    Play-side aggregates (init_count, pub_date, lang, gender, p_span) are
    taken over play rows only, as in the reference; a day without a download
    or favour gets 0 (P14); days without plays are dropped when
    ``require_plays`` (the plays side drives the reference's left joins).
    """
    s = songs.select("song_id", "artist_id", ymd_to_date("publish_time").alias("_pub"),
                     _num("song_init_plays").alias("_init"), _num("Language").alias("_lang"),
                     _num("Gender").alias("_gender"))
    a = actions.select("song_id", "action_type", "Ds", "gmt_create") \
        .filter(F.col("action_type").isin(PLAY, DOWNLOAD, FAVOUR))
    j = a.join(s, "song_id", "inner")
    dates = _is_date(actions, "Ds")
    if published_only:
        j = j.filter(F.col("_pub") >= (F.col("Ds") if dates else ymd_to_date("Ds")))
    is_play = F.col("action_type") == PLAY
    on_play = lambda c: F.when(is_play, c)
    out = (j.groupBy("artist_id", "Ds")
           .agg(F.count_if(is_play).alias("plays"),
                F.count_if(F.col("action_type") == DOWNLOAD).alias("downloads"),
                F.count_if(F.col("action_type") == FAVOUR).alias("favors"),
                F.sum(on_play(F.col("_init"))).alias("init_count"),
                F.max(on_play(F.col("_pub"))).alias("_pub"),
                F.avg(on_play(F.col("_lang"))).alias("lang"),
                F.avg(on_play(F.col("_gender"))).alias("gender"),
                F.sum(on_play(_num("gmt_create"))).alias("p_span")))
    if require_plays:
        out = out.filter(F.col("plays") > 0)
    ds = F.date_format("Ds", "yyyyMMdd") if dates else F.col("Ds")
    return out.select("artist_id", ds.alias("ds"), "plays", "downloads", "favors", "init_count",
                      F.date_format("_pub", "yyyyMMdd").alias("pub_date"), "lang", "gender", "p_span",
                      days_since("Ds", origin, None if dates else "yyyyMMdd").alias("day_num"))


def daily_activity_joined(songs: DataFrame, actions: DataFrame, origin: str = "2015-03-01",
                          require_downloads: bool = False) -> DataFrame:
    """The reference's three filtered aggregates glued by joins.

    plays LEFT JOIN downloads LEFT JOIN favours on (artist, day); with
    ``require_downloads`` the downloads join is INNER (J03 variant).  Same
    rows as :func:`daily_activity` when ``require_downloads`` is False, but
    three scans of the actions; kept for equivalence checks.
    """
    def per_type(code, extra=()):
        j = _joined(songs, actions, (code,))
        return j.groupBy("artist_id", "Ds").agg(F.count("action_type").alias("n"), *extra)

    plays = per_type(PLAY, (F.sum(_num("song_init_plays")).alias("init_count"),
                            F.date_format(F.max(F.to_date("publish_time", "yyyyMMdd")),
                                          "yyyyMMdd").alias("pub_date"),
                            F.avg(_num("Language")).alias("lang"),
                            F.avg(_num("Gender")).alias("gender"),
                            F.sum(_num("gmt_create")).alias("p_span"))) \
        .withColumnRenamed("n", "plays")
    downloads = per_type(DOWNLOAD).withColumnRenamed("n", "downloads")
    favors = per_type(FAVOUR).withColumnRenamed("n", "favors")
    keys = ["artist_id", "Ds"]
    out = (plays.join(downloads, keys, "inner" if require_downloads else "left")
           .join(favors, keys, "left"))
    return out.select(F.col("artist_id"), F.col("Ds").alias("ds"), "plays",
                      F.coalesce("downloads", F.lit(0)).alias("downloads"),
                      F.coalesce("favors", F.lit(0)).alias("favors"),
                      "init_count", "pub_date", "lang", "gender", "p_span",
                      days_since("Ds", origin).alias("day_num"))


def daily_report(songs: DataFrame, actions: DataFrame) -> DataFrame:
    """Plays per (artist, day) with day and publish date as yyyy/MM/dd.

    ``max_init_plays`` is the max of the *text* column, so it is
    lexicographic ("9953" > "98427"), exactly like the reference (A05).
    """
    j = _joined(songs, actions, (PLAY,))
    agg = (j.groupBy("artist_id", "Ds")
           .agg(F.count("action_type").alias("plays"),
                F.max("song_init_plays").alias("max_init_plays"),
                F.max("publish_time").alias("pub_date")))
    return agg.select("artist_id", "plays", reformat_ymd("Ds").alias("day"),
                      "max_init_plays", reformat_ymd("pub_date").alias("pub_day"))


def forecast_features(activity: DataFrame, pub_reference: str = "2017-01-01") -> DataFrame:
    """The 7 model features and the label (plays) per (artist, day).

    Features: downloads, favors, day_num, init_count, publish-age bucket
    (F12, 90-day buckets to ``pub_reference``), lang, gender.
    """
    return activity.select(
        "artist_id", "ds",
        F.col("plays").cast("double").alias("label"),
        F.col("downloads").cast("double").alias("downloads"),
        F.col("favors").cast("double").alias("favors"),
        F.col("day_num").cast("double").alias("day_num"),
        F.col("init_count").cast("double").alias("init_count"),
        age_bucket("pub_date", pub_reference).cast("double").alias("pub_bucket"),
        F.col("lang").cast("double").alias("lang"),
        F.col("gender").cast("double").alias("gender"))


FEATURE_COLS = ["downloads", "favors", "day_num", "init_count", "pub_bucket", "lang", "gender"]


def renumber_days(df: DataFrame, day_col: str = "day_num", by: str = "artist_id",
                  keep: str = TEST_DAYS,
                  base: int = 180) -> DataFrame:
    """W01 + P04: keep the test days, then day = base + position by day desc.

    The window is partitioned by artist: one partition holds the days of one
    artist, which is bounded by the calendar, not by the action volume.
    """
    w = Window.partitionBy(by).orderBy(F.col(day_col).desc())
    return df.filter(keep).withColumn("new_day", (F.lit(base) + F.row_number().over(w)).cast("long"))


def train_test_days(features: DataFrame, train_below: float = 200,
                    keep: str = TEST_DAYS,
                    base: int = 180) -> tuple[DataFrame, DataFrame]:
    """Training rows (day < ``train_below``) and renumbered test rows."""
    train = features.filter(F.col("day_num") < train_below)
    test = renumber_days(features, keep=keep, base=base) \
        .withColumn("day_num", F.col("new_day").cast("double")).drop("new_day")
    return train, test


def forecast_dates(pred: DataFrame, start: str, horizon: int = 60, by: str = "artist_id",
                   order_col: str = "day_num", value: str = "prediction") -> DataFrame:
    """W02 + F13 + F14 (K03 layout): first ``horizon`` predictions per artist
    get consecutive dates from ``start``; value floored to int."""
    w = Window.partitionBy(by).orderBy(F.col(order_col))
    rn = F.row_number().over(w)
    return (pred.withColumn("_rn", rn).filter(F.col("_rn") <= horizon)
            .select(F.col(by).alias("artist_id"),
                    F.floor(F.col(value)).cast("int").alias("plays"),
                    add_days_ymd(start, F.col("_rn") - 1).alias("ds")))


def trend_forecast(activity: DataFrame, train_below: float, start: str, horizon: int = 60,
                   keep: str = TEST_DAYS,
                   base: int = 180, by: str = "artist_id") -> DataFrame:
    """W01 + W02 + M06 in one pass over the activity table.

    Per artist: a closed-form trend fitted on days < ``train_below``, test
    days renumbered (W01), predictions for the renumbered days, the first
    ``horizon`` of them dated from ``start`` (K03 layout).  Every window is
    partitioned by artist, so the activity table is shuffled ONCE; an
    artist's partition holds its days (bounded by the calendar), not its
    actions.
    """
    w_all = Window.partitionBy(by)
    train = F.col("day_num") < train_below
    y, x = F.when(train, F.col("plays").cast("double")), F.when(train, F.col("day_num").cast("double"))
    fitted = activity.select(by, "day_num",
                             F.regr_slope(y, x).over(w_all).alias("slope"),
                             F.regr_intercept(y, x).over(w_all).alias("intercept"),
                             F.count(x).over(w_all).alias("_n_train"))
    test = fitted.filter(keep).withColumn(
        "new_day", F.lit(base) + F.row_number().over(Window.partitionBy(by).orderBy(F.col("day_num").desc())))
    # artists without a training day get no forecast (no fitted trend)
    pred = test.filter(F.col("_n_train") > 0).withColumn(
        "prediction", F.round(F.round("intercept", 6) + F.round("slope", 6) * F.col("new_day"), 6))
    return forecast_dates(pred, start, horizon, by=by, order_col="new_day")
