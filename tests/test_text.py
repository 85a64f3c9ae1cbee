from pyspark.sql import functions as F

from corvid.functions.text import java_split, message_words, split_keep, text_lines, title_words
from corvid.operators import text


def _split(spark, values, sep):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(java_split("s", sep)).collect()]


def test_java_split_blank_lines(spark):
    # String.split(" "): trailing empties vanish, interior/leading kept,
    # an empty line is one empty word, a blanks-only line has no word.
    got = _split(spark, ["a b", "a  b", "a b  ", "", "   ", "  a"], " ")
    assert got == [["a", "b"], ["a", "", "b"], ["a", "b"], [""], [], ["", "", "a"]]


def test_java_split_non_word(spark):
    got = _split(spark, ["Hello, world!!", "...", "x"], r"\W+")
    assert got == [["Hello", "world"], [], ["x"]]


def test_split_keep_trims_and_keeps_trailing(spark):
    df = spark.createDataFrame([(" a , b ,",)], "s string")
    assert df.select(split_keep("s", ",")).first()[0] == ["a", "b", ""]


def test_text_lines(spark):
    df = spark.createDataFrame([("a\nb\n",), ("a\n\nb",), ("",)], "s string")
    assert [r[0] for r in df.select(text_lines("s")).collect()] == [["a", "b"], ["a", "", "b"], [""]]


def test_title_words(spark):
    df = spark.createDataFrame([("The Senior Java-Developer 2x in NYC, and more",)], "s string")
    assert df.select(title_words("s")).first()[0] == ["senior", "java", "developer", "nyc", "more"]


def test_message_words(spark):
    df = spark.createDataFrame([("Call me NOW!! now: free-prize (free) at 10am",)], "s string")
    # lower, punctuation and 0/1 -> blank, drop short/ignored words, distinct in order
    assert df.select(message_words("s")).first()[0] == ["call", "now", "free", "prize"]


def test_rare_word_removal_is_a_join(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta"), (3, "beta delta")],
                               "doc_id long, text string")
    got = {r.doc_id: r.tokens for r in text.title_tokens(df).collect()}
    assert got == {1: ["alpha", "beta"], 2: ["alpha", "beta"], 3: ["beta"]}
    rare = {r.word for r in text.rare_words(df, "doc_id", "text").collect()}
    assert rare == {"gamma", "delta"}


def test_word_count_comma_cells_not_trimmed(spark):
    df = spark.createDataFrame([("a, b,a\nb,,",)], "text string")
    got = {r.word: r.n for r in text.word_count(df).collect()}
    assert got == {"a": 2, " b": 1, "b": 1}


def test_stop_list_filter_keeps_duplicates(spark):
    words = spark.createDataFrame([("ok",), ("fail",), ("ok",), ("sad",)], "word string")
    assert sorted(r.word for r in text.stop_list_filter(words, ["fail", "sad"]).collect()) == ["ok", "ok"]
    stop = spark.createDataFrame([("ok",)], "w string")
    assert sorted(r.word for r in text.stop_list_filter(words, stop).collect()) == ["fail", "sad"]


def test_lower_unicode(spark):
    df = spark.createDataFrame([("ÄBC",)], "s string")
    assert df.select(F.lower("s")).first()[0] == "äbc"


def test_uri_component(spark):
    from corvid.functions.strings import uri_component
    df = spark.createDataFrame([("a b*!'()~é/?",)], "s string")
    assert df.select(uri_component("s")).first()[0] == "a%20b*!'()~%C3%A9%2F%3F"


def test_predicates(spark):
    from corvid.functions.strings import eq_number, eq_optional, text_is_true
    df = spark.createDataFrame([("1", "true", "x"), ("01", "TRUE ", None), ("2", "false", "x")],
                               "t string, b string, o string")
    assert df.filter(eq_number("t", 1)).count() == 2
    assert df.filter(text_is_true("b")).count() == 2
    assert df.filter(eq_optional("o", "x")).count() == 2
    assert df.filter(eq_optional("o", None)).count() == 0


def test_java_split_long_separator_run_is_linear(spark):
    import time
    df = spark.createDataFrame([("#" * 200_000 + "a" + " " * 100_000 + "b  ",)], "s string")
    t0 = time.time()
    w = df.select(java_split("s", r"\W+")).first()[0]
    b = df.select(java_split("s", " ")).first()[0]
    assert w == ["", "a", "b"] and b[-1] == "b" and len(b) == 100_000 + 1
    assert time.time() - t0 < 30


def test_text_lines_all_line_breaks(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n",), ("x\r\n",)], "s string")
    assert [r[0] for r in df.select(text_lines("s")).collect()] == [["a", "b", "c"], ["x"]]


def test_message_word_length_counts_utf16_units(spark):
    from corvid.functions.text import jvm_length
    df = spark.createDataFrame([("ab", ), ("a\U0001F600",), ("\U0001F600\U0001F600 xy",)], "s string")
    assert [r[0] for r in df.select(jvm_length("s")).collect()] == [2, 3, 7]
    assert df.select(message_words("s")).collect()[2][0] == ["\U0001F600\U0001F600"]
