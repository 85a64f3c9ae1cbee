"""Query op11: the strongest collocations of each language."""

from pyspark.sql import DataFrame, SparkSession

from corvid.llm.collocations import collocations, ranked
from corvid.llm.common import table
from corvid.llm.registry import query

SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d),
s AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(ws) >= k),
c AS (SELECT lang, k AS size, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE size = 1 GROUP BY lang),
p AS (SELECT *, string_split(phrase, ' ') AS ws FROM c WHERE f >= 100),
inside AS (SELECT lang, size, f, ws, unnest(range(1, size)) AS k FROM p WHERE size > 2),
sub AS (SELECT lang, f, array_to_string(ws[j:j + k - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, size - k + 2)) AS j FROM inside WHERE k >= 2)),
gone AS (SELECT DISTINCT p.lang, p.phrase FROM p JOIN sub ON p.lang = sub.lang AND p.phrase = sub.phrase
         WHERE 100 * sub.f >= 100 * p.f),
cuts AS (SELECT p.lang, p.phrase, p.f AS a, p.ws, p.size, unnest(range(1, p.size)) AS k
         FROM p WHERE size > 1 AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.lang = p.lang AND g.phrase = p.phrase)),
v AS (SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, n.n, k,
             ((1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
      FROM cuts JOIN n ON n.lang = cuts.lang
      JOIN p x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.ws[1:k], ' ')
      JOIN p y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.ws[k + 1:], ' ')),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000
"""


@query("op11_phrase_collocations", SQL)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(collocations(table(spark, sf_dir, "documents")))
