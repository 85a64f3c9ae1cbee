"""Query op1: later copies of repeated line runs removed from every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.line_dedup import drop_later_runs
from corvid.llm.registry import query

SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
w AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
p AS (SELECT doc_id, pos, coalesce(sum(words) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT doc_id, pos, words FROM w UNION ALL SELECT doc_id, count(*), 0 FROM w GROUP BY doc_id)),
r AS (SELECT a.doc_id, a.pos AS s, min(e.pos) AS e FROM p a JOIN p e ON a.doc_id = e.doc_id AND e.before >= a.before + 20 GROUP BY a.doc_id, a.pos
      UNION
      SELECT e.doc_id, max(a.pos) AS s, e.pos AS e FROM p a JOIN p e ON a.doc_id = e.doc_id AND e.before >= a.before + 20 GROUP BY e.doc_id, e.pos),
c AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY e - s, array_to_string(ls[s + 1:e], chr(10)) ORDER BY doc_id, s) > 1 AS later
      FROM r JOIN d USING (doc_id)),
g AS (SELECT DISTINCT doc_id, unnest(range(s, e)) AS pos FROM c WHERE later),
m AS (SELECT w.*, g.pos IS NOT NULL AS gone FROM w LEFT JOIN g ON g.doc_id = w.doc_id AND g.pos = w.pos),
o AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM m)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM o GROUP BY doc_id
"""


@query("op1_line_dedup", SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_later_runs(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))
