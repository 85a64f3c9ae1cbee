import os

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from py4j.protocol import Py4JJavaError

from corvid.sources import files as src


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_typed_header_csv(spark, tmp_dir):
    p = _write(tmp_dir, "attr.txt", "pKey:string, lKey:string, val1:double, val2:integer, ok:boolean\n"
                                    "k7, loc12, 4.25, 0, true\n"
                                    "k8, , 0.5, , false\n")
    df = src.read_typed_csv(spark, p)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string", "double", "int", "boolean"]
    rows = df.orderBy("pKey").collect()
    assert tuple(rows[0]) == ("k7", "loc12", 4.25, 0, True)
    assert rows[1].lKey is None and rows[1].val2 is None


@pytest.mark.parametrize("line", ["s1, a, 1.0, 2\n", "s1, a, 1.0, 2, true, extra\n", "s1, a, x, 2, true\n"])
def test_typed_header_bad_rows_raise(spark, tmp_dir, line):
    p = _write(tmp_dir, "bad.txt", "pKey:string, lKey:string, val1:double, val2:integer, ok:boolean\n" + line)
    with pytest.raises((PySparkException, Py4JJavaError), match="bad typed row"):
        src.read_typed_csv(spark, p).select("pKey").collect()


def test_unknown_header_type_raises():
    with pytest.raises(ValueError):
        src.parse_typed_header("a:string, b:date")


def test_delimited_strings_keep_trailing_empties(spark, tmp_dir):
    p = _write(tmp_dir, "songs.csv", "s1, a1, 20140611, 731, 4, 1\ns2,a2,20140612,8260,,\n")
    df = src.read_delimited_strings(spark, p, ["song_id", "artist_id", "publish_time", "plays", "Language", "Gender"])
    rows = df.orderBy("song_id").collect()
    assert rows[0].song_id == "s1" and rows[0].plays == "731"
    assert rows[1].Language == "" and rows[1].Gender == ""


def test_labeled_points_and_dense_vectors(spark, tmp_dir):
    p = _write(tmp_dir, "lp.data", "1.0,1.0\n2.0,2.0 3.0\n")
    rows = src.read_labeled_points(spark, p).select("label", vector_to_array("features").alias("f")).collect()
    assert [(r.label, r.f) for r in rows] == [(1.0, [1.0]), (2.0, [2.0, 3.0])]
    p2 = _write(tmp_dir, "vectors.txt", "1.0 2.0 3.0\n7.5 7.0 6.5\n")
    assert src.read_dense_vectors(spark, p2).count() == 2


def test_tab_pairs_and_header_by_content(spark, tmp_dir):
    p = _write(tmp_dir, "sms.txt", "ham\thello there\n\tno label\nspam\twin now\n")
    assert src.read_tab_pairs(spark, p).count() == 2
    p2 = _write(tmp_dir, "jobs.csv", "category,jobtitle\neducation,teacher\nlabor,mover\n")
    assert [r.category for r in src.read_csv_drop_header(spark, p2).collect()] == ["education", "labor"]


def test_numeric_csv_and_clean_names(spark, tmp_dir):
    p = _write(tmp_dir, "yx.csv", "1.0,2.0\n3.0,4.0\n")
    assert src.read_numeric_csv(spark, p).columns == ["y", "x"]
    df = spark.createDataFrame([(1, 2, 3)], "` a b` int, `c+d` int, e int")
    assert src.clean_names(df).columns == ["a_b", "c_d", "e"]
    assert src.drop_position(df, 1).columns == [" a b", "e"]


def test_jdbc_options():
    from corvid.sources.jdbc import jdbc_options
    o = jdbc_options("jdbc:x", table="t", user="u", partitionColumn="id", numPartitions=4)
    assert o == {"url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "id", "numPartitions": "4"}


def test_valid_rows_and_inferred_csv(spark, tmp_dir):
    p = _write(tmp_dir, "w.csv", "year,temp\n2015,1.5\nbad,x\n2016,2.5\n")
    df = src.read_csv_valid_rows(spark, p, "year int, temp double")
    assert sorted(r.year for r in df.collect()) == [2015, 2016]
    inf = src.read_csv_inferred(spark, p)
    assert inf.columns == ["year", "temp"]


def test_patients_reader(spark, tmp_dir):
    p = _write(tmp_dir, "pat.csv", "1,0,65,1,2,1,1.4,0.0,6\n")
    df = src.read_patients(spark, p)
    assert df.columns[1] == "CAPSULE" and df.first().AGE == 65.0


def test_header_by_content_short_line_raises(spark, tmp_dir):
    p = _write(tmp_dir, "jobs2.csv", "category,jobtitle\neducation,\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="too few cells"):
        src.read_csv_drop_header(spark, p).collect()


@pytest.mark.parametrize("line", ["", "1.0", "1.0,2.0,3.0", "1.0,x"])
def test_strict_readers_raise_whatever_is_selected(spark, tmp_dir, line):
    p = _write(tmp_dir, "strict.csv", f"1.0,2.0\n{line}\n3.0,4.0\n")
    for act in (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("y").collect()):
        with pytest.raises((PySparkException, Py4JJavaError), match="bad typed row"):
            act(src.read_numeric_csv(spark, p))


def test_blank_lines_raise(spark, tmp_dir):
    p = _write(tmp_dir, "blank.txt", "a:string, b:integer\nx, 1\n\ny, 2\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="bad typed row"):
        src.read_typed_csv(spark, p).count()
    p = _write(tmp_dir, "blank2.txt", "x,1\n\ny,2\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="too few cells"):
        src.read_delimited_strings(spark, p, ["a", "b"]).count()


def test_valid_rows_are_the_same_whatever_is_selected(spark, tmp_dir):
    p = _write(tmp_dir, "valid.csv", "year,temp,name\n2015,1.5,\"a, b\"\nbad,x,c\n2016,,d\n2017\n2018,2,e,f\n\n2019,3,\n")
    df = src.read_csv_valid_rows(spark, p, "year int, temp double, name string")
    rows = sorted(tuple(r) for r in df.collect())
    assert [r[0] for r in rows] == [2015, 2016, 2019] and rows[0][2] == "a, b"
    assert df.count() == 3 and sorted(r.year for r in df.select("year").collect()) == [2015, 2016, 2019]
