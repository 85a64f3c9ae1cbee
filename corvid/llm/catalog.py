"""All queries of this subpackage.  Importing this module fills the registry."""

from corvid.llm import (q_collocations, q_conversations, q_exact, q_lines, q_near, q_ngram_join,  # noqa: F401
                        q_packing, q_pii, q_sentencepiece, q_substring, q_suffix, q_topk, q_toxicity)
from corvid.llm.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
