"""Text queries over documents, conversations and benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.text import (MESSAGE_IGNORED_CHARS, MESSAGE_IGNORED_WORDS, STREAM_STOP_LIST,
                                   TITLE_STOPWORDS)
from corvid.operators import text
from corvid.plans.registry import query
from corvid.plans.sqltext import jsplit, lines, str_list
from corvid.sources.tables import load_table

_W = jsplit("text", r"\W+", r"\W+$")
_RAW = f"""raw AS (SELECT doc_id, lower(unnest({_W})) AS word, generate_subscripts({_W}, 1) AS pos FROM documents),
nd AS (SELECT * FROM raw WHERE regexp_full_match(word, '[^0-9]*'))"""
_TITLE_CTE = f"""{_RAW},
cnt AS (SELECT word, count(*) AS n FROM nd GROUP BY word),
kept AS (SELECT doc_id, word, pos FROM nd JOIN cnt USING (word)
         WHERE n >= 2 AND length(word) >= 2 AND NOT list_contains({str_list(sorted(set(TITLE_STOPWORDS)))}, word))"""


def _docs(spark, sf):
    return load_table(spark, sf, "documents")


@query("word_count", f"""
WITH l AS (SELECT unnest({lines('text')}) AS line FROM documents),
w AS (SELECT unnest({jsplit('line', ',', ',+$')}) AS word FROM l)
SELECT word, count(*) AS n FROM w GROUP BY word""", ("A06", "S02"))
def q_word_count(spark, sf):
    return text.word_count(_docs(spark, sf), "text", ",")


@query("rare_words", f"""WITH {_RAW}
SELECT word, count(*) AS n FROM nd GROUP BY word HAVING count(*) < 2""", ("A12", "F04", "F05"))
def q_rare_words(spark, sf):
    return text.rare_words(_docs(spark, sf), "doc_id", "text")


@query("distinct_tokens", f"""WITH {_TITLE_CTE}
SELECT count(DISTINCT word) AS n_distinct FROM kept""", ("A11",))
def q_distinct_tokens(spark, sf):
    return text.distinct_tokens(_docs(spark, sf))


@query("token_chain_titles", f"""WITH {_TITLE_CTE}
SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS tokens, CAST(count(*) AS INTEGER) AS n_tokens
FROM kept GROUP BY doc_id""", ("M21", "F03", "F06", "F07"))
def q_token_chain_titles(spark, sf):
    t = text.title_tokens(_docs(spark, sf))
    return t.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"), "n_tokens")


_CHARS = "".join(MESSAGE_IGNORED_CHARS).replace("'", "''")


@query("token_chain_messages", f"""
WITH m AS (SELECT conv_id, turn,
                  {jsplit(f"translate(lower(text), '{_CHARS}', '{' ' * len(MESSAGE_IGNORED_CHARS)}')", ' ', ' +$')} AS arr
           FROM conversations),
f AS (SELECT conv_id, turn, list_filter(arr, lambda x: NOT list_contains({str_list(MESSAGE_IGNORED_WORDS)}, x)
                                                   AND length(x) + length(regexp_replace(x, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) >= 3) AS arr FROM m),
d AS (SELECT conv_id, turn, list_filter(arr, lambda x, i: list_position(arr, x) = i) AS arr FROM f)
SELECT conv_id, turn, array_to_string(arr, ' ') AS tokens, CAST(len(arr) AS INTEGER) AS n_tokens FROM d""",
       ("M22", "F08", "F09", "F02"))
def q_token_chain_messages(spark, sf):
    c = load_table(spark, sf, "conversations")
    t = text.message_tokens(c, "text", keep=("conv_id", "turn"))
    return t.select("conv_id", "turn", F.concat_ws(" ", "tokens").alias("tokens"),
                    F.size("tokens").alias("n_tokens"))


_SPACE_WORDS = jsplit("line", " ", " +$")


@query("stop_list_batch", f"""
WITH dl AS (SELECT unnest({lines('text')}) AS line FROM documents),
dw AS (SELECT unnest({_SPACE_WORDS}) AS word FROM dl),
bl AS (SELECT unnest({lines('text')}) AS line FROM benchmark),
bw AS (SELECT DISTINCT unnest({_SPACE_WORDS}) AS word FROM bl)
SELECT word, count(*) AS n FROM dw WHERE NOT EXISTS (SELECT 1 FROM bw WHERE bw.word = dw.word)
GROUP BY word""", ("J09",))
def q_stop_list_batch(spark, sf):
    words = text.line_words(_docs(spark, sf), "text", " ")
    stop = text.line_words(load_table(spark, sf, "benchmark"), "text", " ")
    return text.stop_list_filter(words, stop).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("stop_list_fixed", f"""
WITH dl AS (SELECT unnest({lines('text')}) AS line FROM documents),
dw AS (SELECT unnest({_SPACE_WORDS}) AS word FROM dl)
SELECT word, count(*) AS n FROM dw WHERE word NOT IN ({', '.join("'" + w + "'" for w in STREAM_STOP_LIST)})
GROUP BY word""", ("J09",))
def q_stop_list_fixed(spark, sf):
    words = text.line_words(_docs(spark, sf), "text", " ")
    return text.stop_list_filter(words, STREAM_STOP_LIST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
