from pyspark.sql import functions as F

from corvid.operators import activity as act

SONGS = [("s1", "a1", "20160314", "771", "1", "2"),
         ("s2", "a1", "20150101", "6420", "3", "1"),
         ("s3", "a2", "20140101", "100", "2", "2")]
ACTIONS = [("u1", "s1", "10", "1", "20150301"), ("u2", "s2", "20", "1", "20150301"),
           ("u3", "s1", "30", "2", "20150301"),
           ("u4", "s1", "40", "1", "20150302"),                      # plays, no download
           ("u5", "s2", "50", "2", "20150303"),                      # download, no play
           ("u6", "s3", "60", "3", "20150301"), ("u7", "s3", "70", "1", "20150301")]


def _inputs(spark):
    s = spark.createDataFrame(SONGS, "song_id string, artist_id string, publish_time string, "
                                     "song_init_plays string, Language string, Gender string")
    a = spark.createDataFrame(ACTIONS, "user_id string, song_id string, gmt_create string, "
                                       "action_type string, Ds string")
    return s, a


def test_daily_activity_single_pass(spark):
    s, a = _inputs(spark)
    rows = {(r.artist_id, r.ds): r for r in act.daily_activity(s, a).collect()}
    assert set(rows) == {("a1", "20150301"), ("a1", "20150302"), ("a2", "20150301")}
    r = rows[("a1", "20150301")]
    assert (r.plays, r.downloads, r.favors) == (2, 1, 0)
    assert r.init_count == 771 + 6420 and r.pub_date == "20160314"
    assert r.lang == 2.0 and r.p_span == 30.0 and r.day_num == 0
    assert rows[("a1", "20150302")].downloads == 0
    assert rows[("a2", "20150301")].favors == 1


def test_joined_variant_matches(spark):
    s, a = _inputs(spark)
    one = sorted(tuple(r) for r in act.daily_activity(s, a).collect())
    three = sorted(tuple(r) for r in act.daily_activity_joined(s, a).collect())
    assert one == three
    inner = act.daily_activity_joined(s, a, require_downloads=True).collect()
    assert [(r.artist_id, r.ds) for r in inner] == [("a1", "20150301")]


def test_report_string_max(spark):
    s, a = _inputs(spark)
    r = {(x.artist_id, x.day): x for x in act.daily_report(s, a).collect()}
    # lexicographic: "771" > "6420"
    assert r[("a1", "2015/03/01")].max_init_plays == "771"
    assert r[("a1", "2015/03/01")].pub_day == "2016/03/14"


def test_renumber_and_forecast_dates(spark):
    rows = [("a", d, float(d)) for d in (148, 149, 150, 151)]
    df = spark.createDataFrame(rows, "artist_id string, day_num int, prediction double")
    ren = {r.day_num: r.new_day for r in act.renumber_days(df).collect()}
    assert ren == {151: 181, 150: 182, 148: 183}
    out = act.forecast_dates(df, "2015-09-01", 3).orderBy("ds").collect()
    assert [(r.plays, r.ds) for r in out] == [(148, "20150901"), (149, "20150902"), (150, "20150903")]


def test_features_and_buckets(spark):
    s, a = _inputs(spark)
    f = act.forecast_features(act.daily_activity(s, a)).filter(F.col("artist_id") == "a2").first()
    # 2014-01-01 .. 2017-01-01 = 1096 days -> bucket 12
    assert f.pub_bucket == 12.0 and f.label == 1.0


def test_null_attributes_are_left_out_of_averages(spark):
    s, a = _inputs(spark)
    s = s.withColumn("Language", F.when(F.col("song_id") != "s2", F.col("Language")))
    s = s.withColumn("Gender", F.when(F.col("song_id") != "s1", F.col("Gender")))
    one = sorted((tuple(r) for r in act.daily_activity(s, a).collect()), key=repr)
    three = sorted((tuple(r) for r in act.daily_activity_joined(s, a).collect()), key=repr)
    assert one == three
    assert {r[7] for r in one if r[:2] == ("a1", "20150301")} == {1.0}


def test_days_as_dates_give_the_same(spark):
    s, a = _inputs(spark)
    dated = a.withColumn("Ds", F.to_date("Ds", "yyyyMMdd"))
    assert sorted(tuple(r) for r in act.daily_activity(s, a).collect()) == sorted(
        tuple(r) for r in act.daily_activity(s, dated).collect())
    for frame in (a, dated):
        got = act.daily_activity(s, frame, published_only=True).collect()
        assert [(r.artist_id, r.ds, r.plays) for r in got] == [("a1", "20150301", 0)] or all(r.plays > 0 for r in got)


def test_bad_numeric_text_raises(spark):
    import pytest
    s, a = _inputs(spark)
    bad = s.withColumn("song_init_plays", F.lit("x771"))
    with pytest.raises(Exception):
        act.daily_activity(bad, a).collect()


def test_cli_lists_queries(capsys):
    from corvid.__main__ import main
    assert main(["list"]) == 0
    assert "daily_activity" in capsys.readouterr().out
