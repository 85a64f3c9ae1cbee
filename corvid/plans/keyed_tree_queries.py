"""A regression tree per artist, all artists at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.ml import keyed_trees as kt
from corvid.operators import activity as act
from corvid.plans.activity_queries import DAILY_ACTIVITY_SQL, _activity_out, _inputs
from corvid.plans.registry import query
from corvid.plans.standins import ORIGIN

TREE_FEATURES = ["downloads", "favors", "day_num", "init_count", "lang", "gender"]
BINS = 16
DEPTH = 4
_TRAIN_BELOW = 1800
_FORECAST_START = "2001-12-01"

_ROOT_SQL = f"""
WITH act AS ({DAILY_ACTIVITY_SQL}),
f AS (SELECT artist_id, CAST(plays AS DOUBLE) AS y, unnest(range({len(TREE_FEATURES)})) AS feature,
             unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in TREE_FEATURES)}]) AS x FROM act WHERE day_num < {_TRAIN_BELOW}),
r AS (SELECT *, min(x) OVER k AS lo, max(x) OVER k AS hi FROM f WINDOW k AS (PARTITION BY artist_id, feature)),
b AS (SELECT artist_id, feature, y, CASE WHEN hi <= lo THEN 0
             ELSE least({BINS - 1}, CAST(floor((x - lo) / (hi - lo) * {BINS}) AS INTEGER)) END AS bin FROM r),
h AS (SELECT artist_id, feature, bin, count(*) AS n, sum(y) AS s FROM b GROUP BY ALL),
c AS (SELECT artist_id, feature, bin, sum(n) OVER u AS nl, sum(s) OVER u AS sl, sum(n) OVER a AS na, sum(s) OVER a AS sa
      FROM h WINDOW u AS (PARTITION BY artist_id, feature ORDER BY bin), a AS (PARTITION BY artist_id, feature)),
g AS (SELECT *, sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na AS gain FROM c WHERE na > nl)
SELECT artist_id, CAST(feature AS INTEGER) AS feature, bin, round(gain, 6) AS gain,
       CAST(nl AS BIGINT) AS n_left, CAST(na - nl AS BIGINT) AS n_right
FROM g WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY gain DESC, feature, bin) = 1"""


def _activity(spark, sf):
    songs, actions = _inputs(spark, sf, text_days=False)
    daily = _activity_out(act.daily_activity(songs, actions, origin=ORIGIN))
    return daily.select("artist_id", "ds", F.col("plays").cast("double").alias("label"),
                        *[F.col(c).cast("double").alias(c) for c in TREE_FEATURES])


@query("artist_root_split", _ROOT_SQL, ("M25", "M03"))
def q_artist_root_split(spark, sf):
    """The first split of every artist's tree."""
    train = _activity(spark, sf).filter(F.col("day_num") < _TRAIN_BELOW)
    ranges = kt.key_ranges(train, "artist_id", TREE_FEATURES)
    rows = kt.binned(train, ranges, "artist_id", TREE_FEATURES, BINS).withColumn("node", F.lit(1))
    best = kt.best_splits(rows, "artist_id", TREE_FEATURES, BINS)
    return best.select("artist_id", "feature", "bin", F.round("gain", 6).alias("gain"), "n_left", "n_right")


@query("artist_tree_forecast", None, ("M25", "M23", "M24", "K03", "W02"))
def q_artist_tree_forecast(spark, sf):
    """A tree per artist grown on the training days, its forecast for the renumbered test days."""
    train, test = act.train_test_days(_activity(spark, sf), train_below=_TRAIN_BELOW)
    trees = kt.grow(train, "artist_id", "label", TREE_FEATURES, depth=DEPTH, bins=BINS)
    pred = kt.predict(trees, test, "artist_id", TREE_FEATURES, depth=DEPTH, bins=BINS)
    return act.forecast_dates(pred.filter("prediction is not null"), _FORECAST_START, 60)
