"""Music-activity family over the stand-in views (lineitem, part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import activity as act
from corvid.plans.registry import query
from corvid.plans.standins import ACTIONS_SQL, ORIGIN, SONGS_SQL, actions_view, songs_view
from corvid.session import scratch_path
from corvid.sinks.files import forecast_lines, write_text
from corvid.sources.files import read_text_lines
from corvid.sources.tables import load_table


def _inputs(spark, sf, text_days: bool = True):
    return (songs_view(load_table(spark, sf, "part")),
            actions_view(load_table(spark, sf, "lineitem"), text_days))


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


_ACTIVITY_COLS = ["artist_id", "ds", "plays", "downloads", "favors"]


def _activity_out(df):
    return df.select(*_ACTIVITY_COLS, _r("init_count"), "pub_date", _r("lang"), _r("gender"),
                     _r("p_span"), "day_num")


_WITH = f"WITH songs AS ({SONGS_SQL}), actions AS ({ACTIONS_SQL})"

DAILY_ACTIVITY_SQL = _WITH + f""",
j AS (SELECT a.action_type, a.Ds, a.gmt_create, s.* FROM actions a JOIN songs s USING (song_id)
      WHERE a.action_type IN ('1', '2', '3'))
SELECT artist_id, Ds AS ds,
       count(*) FILTER (WHERE action_type = '1') AS plays,
       count(*) FILTER (WHERE action_type = '2') AS downloads,
       count(*) FILTER (WHERE action_type = '3') AS favors,
       round(sum(CAST(song_init_plays AS DOUBLE)) FILTER (WHERE action_type = '1'), 6) AS init_count,
       max(publish_time) FILTER (WHERE action_type = '1') AS pub_date,
       round(avg(CAST(Language AS DOUBLE)) FILTER (WHERE action_type = '1'), 6) AS lang,
       round(avg(CAST(Gender AS DOUBLE)) FILTER (WHERE action_type = '1'), 6) AS gender,
       round(sum(CAST(gmt_create AS DOUBLE)) FILTER (WHERE action_type = '1'), 6) AS p_span,
       CAST(date_diff('day', DATE '{ORIGIN}', strptime(Ds, '%Y%m%d')::DATE) AS INTEGER) AS day_num
FROM j GROUP BY artist_id, Ds
HAVING count(*) FILTER (WHERE action_type = '1') > 0"""


@query("daily_activity", DAILY_ACTIVITY_SQL, ("J01", "A03", "A08", "P14", "F11"))
def q_daily_activity(spark, sf):
    songs, actions = _inputs(spark, sf, text_days=False)
    return _activity_out(act.daily_activity(songs, actions, origin=ORIGIN))


@query("daily_activity_joined", DAILY_ACTIVITY_SQL, ("J02", "P11", "A03"))
def q_daily_activity_joined(spark, sf):
    songs, actions = _inputs(spark, sf)
    return _activity_out(act.daily_activity_joined(songs, actions, origin=ORIGIN))


DAILY_INNER_SQL = _WITH + f""",
j AS (SELECT a.action_type, a.Ds, a.gmt_create, s.* FROM actions a JOIN songs s USING (song_id)),
p AS (SELECT artist_id, Ds, count(*) AS plays,
             sum(CAST(song_init_plays AS DOUBLE)) AS init_count, max(publish_time) AS pub_date,
             avg(CAST(Language AS DOUBLE)) AS lang, avg(CAST(Gender AS DOUBLE)) AS gender,
             sum(CAST(gmt_create AS DOUBLE)) AS p_span
      FROM j WHERE action_type = '1' GROUP BY artist_id, Ds),
d AS (SELECT artist_id, Ds, count(*) AS downloads FROM j WHERE action_type = '2' GROUP BY artist_id, Ds),
f AS (SELECT artist_id, Ds, count(*) AS favors FROM j WHERE action_type = '3' GROUP BY artist_id, Ds)
SELECT p.artist_id, p.Ds AS ds, plays, downloads, coalesce(favors, 0) AS favors,
       round(init_count, 6) AS init_count, pub_date, round(lang, 6) AS lang,
       round(gender, 6) AS gender, round(p_span, 6) AS p_span,
       CAST(date_diff('day', DATE '{ORIGIN}', strptime(p.Ds, '%Y%m%d')::DATE) AS INTEGER) AS day_num
FROM p JOIN d USING (artist_id, Ds) LEFT JOIN f USING (artist_id, Ds)"""


@query("daily_activity_inner", DAILY_INNER_SQL, ("J03",))
def q_daily_activity_inner(spark, sf):
    songs, actions = _inputs(spark, sf)
    return _activity_out(act.daily_activity_joined(songs, actions, origin=ORIGIN,
                                                   require_downloads=True))


# ---- report, renumbering and forecast dates -----------------------------------
_ACT_CTE = _WITH + f""",
act AS (SELECT artist_id, Ds AS ds, count(*) FILTER (WHERE action_type = '1') AS plays,
               CAST(date_diff('day', DATE '{ORIGIN}', strptime(Ds, '%Y%m%d')::DATE) AS INTEGER) AS day_num
        FROM actions JOIN songs USING (song_id) WHERE action_type IN ('1', '2', '3')
        GROUP BY artist_id, Ds HAVING count(*) FILTER (WHERE action_type = '1') > 0)"""


@query("daily_report", _WITH + """
SELECT artist_id, count(*) AS plays, strftime(strptime(Ds, '%Y%m%d'), '%Y/%m/%d') AS day,
       max(song_init_plays) AS max_init_plays,
       strftime(strptime(max(publish_time), '%Y%m%d'), '%Y/%m/%d') AS pub_day
FROM actions JOIN songs USING (song_id) WHERE action_type = '1' GROUP BY artist_id, Ds""",
       ("M26", "A05", "F10", "K02"))
def q_daily_report(spark, sf):
    songs, actions = _inputs(spark, sf)
    return act.daily_report(songs, actions)


_KEEP = act.TEST_DAYS


@query("renumber_days", _ACT_CTE + """
SELECT artist_id, ds, day_num,
       CAST(180 + row_number() OVER (PARTITION BY artist_id ORDER BY day_num DESC) AS BIGINT) AS new_day
FROM act WHERE day_num >= 150 OR (day_num < 150 AND day_num % 2 = 0)""", ("W01", "P04", "M24"))
def q_renumber_days(spark, sf):
    songs, actions = _inputs(spark, sf, text_days=False)
    a = act.daily_activity(songs, actions, origin=ORIGIN)
    return act.renumber_days(a, keep=_KEEP).select("artist_id", "ds", "day_num", "new_day")


# Stand-in training cut (the reference's "< 200" leaks its test days; ours
# trains on the first 1800 days and forecasts the renumbered test days).
_TRAIN_BELOW = 1800
_FORECAST_START = "2001-12-01"


@query("forecast_dates", _ACT_CTE + f""",
coef AS (SELECT artist_id, regr_slope(plays, day_num) AS s, regr_intercept(plays, day_num) AS i
         FROM act WHERE day_num < {_TRAIN_BELOW} GROUP BY artist_id),
test AS (SELECT artist_id, 180 + row_number() OVER (PARTITION BY artist_id ORDER BY day_num DESC) AS new_day
         FROM act WHERE day_num >= 150 OR (day_num < 150 AND day_num % 2 = 0)),
pred AS (SELECT t.artist_id, t.new_day, round(round(c.i, 6) + round(c.s, 6) * t.new_day, 6) AS prediction,
                row_number() OVER (PARTITION BY t.artist_id ORDER BY t.new_day) AS rn
         FROM test t JOIN coef c USING (artist_id))
SELECT artist_id, CAST(floor(prediction) AS INTEGER) AS plays,
       strftime(DATE '{_FORECAST_START}' + CAST(rn - 1 AS INTEGER), '%Y%m%d') AS ds
FROM pred WHERE rn <= 60""", ("W02", "F13", "F14", "M06"))
def q_forecast_dates(spark, sf):
    songs, actions = _inputs(spark, sf, text_days=False)
    a = act.daily_activity(songs, actions, origin=ORIGIN)
    return act.trend_forecast(a, _TRAIN_BELOW, _FORECAST_START, 60, keep=_KEEP)


@query("published_activity", _WITH + f""",
j AS (SELECT a.action_type, a.Ds, s.artist_id FROM actions a JOIN songs s USING (song_id)
      WHERE strftime(strptime(s.publish_time, '%Y%m%d') + INTERVAL 1500 DAY, '%Y%m%d') >= a.Ds)
SELECT artist_id, Ds AS ds, count(*) FILTER (WHERE action_type = '1') AS plays,
       count(*) FILTER (WHERE action_type = '2') AS downloads,
       count(*) FILTER (WHERE action_type = '3') AS favors
FROM j GROUP BY artist_id, Ds HAVING count(*) FILTER (WHERE action_type = '1') > 0""", ("P17",))
def q_published_activity(spark, sf):
    songs, actions = _inputs(spark, sf, text_days=False)
    later = F.date_add(F.to_date("publish_time", "yyyyMMdd"), 1500)     # into the time of the actions
    songs = songs.withColumn("publish_time", F.date_format(later, "yyyyMMdd"))
    return act.daily_activity(songs, actions, origin=ORIGIN, published_only=True).select(*_ACTIVITY_COLS)


@query("forecast_file", _ACT_CTE + f""",
coef AS (SELECT artist_id, regr_slope(plays, day_num) AS s, regr_intercept(plays, day_num) AS i
         FROM act WHERE day_num < {_TRAIN_BELOW} GROUP BY artist_id),
test AS (SELECT artist_id, 180 + row_number() OVER (PARTITION BY artist_id ORDER BY day_num DESC) AS new_day
         FROM act WHERE {_KEEP}),
pred AS (SELECT t.artist_id, round(round(c.i, 6) + round(c.s, 6) * t.new_day, 6) AS prediction,
                row_number() OVER (PARTITION BY t.artist_id ORDER BY t.new_day) AS rn
         FROM test t JOIN coef c USING (artist_id))
SELECT artist_id || ',' || CAST(floor(prediction) AS INTEGER) || ','
       || strftime(DATE '{_FORECAST_START}' + CAST(rn - 1 AS INTEGER), '%Y%m%d') AS line
FROM pred WHERE rn <= 60""", ("K03", "K01", "F13"))
def q_forecast_file(spark, sf):
    """The forecast written as text lines artist,plays,day and read back."""
    songs, actions = _inputs(spark, sf, text_days=False)
    activity = act.daily_activity(songs, actions, origin=ORIGIN)
    path = scratch_path(spark, "forecast")
    write_text(forecast_lines(act.trend_forecast(activity, _TRAIN_BELOW, _FORECAST_START, 60)), path)
    return read_text_lines(spark, path).withColumnRenamed("value", "line")
