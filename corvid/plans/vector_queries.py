"""Mean word vectors and nearest words over a vector table derived from ``embeddings``.

The i-th most frequent word of the messages gets vector i; components are floor(256 x),
so that sums are exact on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators.positions import with_positions
from corvid.operators.vectors import mean_vectors, nearest_words
from corvid.plans.registry import query
from corvid.sources.tables import load_table

DIM = 64
ASKED = [0, 7, 50, 111, 199, -1]

_VECTORS = """v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector FROM embeddings)"""


def _vectors(spark, sf):
    e = load_table(spark, sf, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("vector"))


def _words(spark, sf):
    conv = load_table(spark, sf, "conversations")
    return conv.select("conv_id", "turn", F.filter(F.split("text", " "), lambda w: w != "").alias("words"))


@query("message_mean_vector", f"""
WITH {_VECTORS},
m AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda w: w <> '') AS words FROM conversations),
t AS (SELECT conv_id, turn, unnest(words) AS word FROM m),
f AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS vec_id FROM t GROUP BY word),
k AS (SELECT t.conv_id, t.turn, v.vector FROM t JOIN f USING (word) JOIN v USING (vec_id)),
s AS (SELECT conv_id, turn, count(*) AS n_known, {', '.join(f'sum(vector[{i + 1}]) AS s{i}' for i in range(DIM))}
      FROM k GROUP BY conv_id, turn),
u AS (SELECT m.conv_id, m.turn, len(m.words) AS n_words, coalesce(n_known, 0) AS n_known,
             unnest(range({DIM})) AS i, unnest([{', '.join(f'coalesce(s{i}, 0)' for i in range(DIM))}]) AS total
      FROM m LEFT JOIN s USING (conv_id, turn))
SELECT conv_id, turn, CAST(n_words AS BIGINT) AS n_words, CAST(n_known AS BIGINT) AS n_known, CAST(i AS INTEGER) AS i,
       round(CASE WHEN n_words > 0 THEN total / n_words ELSE 0 END, 6) AS mean FROM u""", ("A13", "M20"))
def q_message_mean_vector(spark, sf):
    words = _words(spark, sf)
    counted = words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    numbered = with_positions(counted, F.desc("n"), "word", col="vec_id")
    table = numbered.join(_vectors(spark, sf), "vec_id").select("word", "vector")
    means = mean_vectors(words, ["conv_id", "turn"], "words", table, DIM)
    return (means.select("conv_id", "turn", "n_words", "n_known", F.posexplode("mean").alias("i", "mean"))
            .withColumn("mean", F.round("mean", 6)))


@query("nearest_vectors", f"""
WITH {_VECTORS},
n AS (SELECT vec_id, vector, sqrt(list_dot_product(vector, vector)) AS norm FROM v),
p AS (SELECT a.vec_id AS asked, b.vec_id AS word,
             list_dot_product(b.vector, a.vector) / (b.norm * a.norm) AS cosine
      FROM n a JOIN n b ON a.vec_id <> b.vec_id WHERE a.vec_id IN ({', '.join(map(str, ASKED))}))
SELECT asked, CAST(row_number() OVER (PARTITION BY asked ORDER BY cosine DESC, word) AS INTEGER) AS rank, word,
       round(cosine, 9) AS cosine FROM p QUALIFY rank <= 5""", ("M19",))
def q_nearest_vectors(spark, sf):
    """The five nearest of stated entries; the last one asked for is not in the table."""
    found = nearest_words(_vectors(spark, sf), ASKED, 5, word="vec_id")
    return found.select("asked", "rank", "word", F.round("cosine", 9).alias("cosine"))
