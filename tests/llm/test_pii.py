"""Personal data: base spans equal the plain patterns, EM and the classifier, masking."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvid.llm.pii import (BASE_KINDS, KINDS, accepted, candidates, find_pii, luhn, mask, pack, redact, reliabilities,
                            span_classifier, unpack)
from llm_fixtures import docs, package  # noqa: F401

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def base(text):
    return [(KINDS[k], s, e) for k, s, e, passed, _ in candidates(text) if passed]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+- ()4%é\n5", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert base(text) == plain(text)


def test_base_spans_on_real_shapes():
    for text in ("x@y.com@z.org a.b+c@d-e.co.uk, 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111-1111 1111 +1 (212) 555-0100",
                 "+12++4915112345678 4111111111111112 5500000000000004 007.0.0.1 @a.b a@b a@b.", "٣.٣.٣.٣ é@x.de"):
        assert base(text) == plain(text)


def test_long_runs_stay_linear():
    assert base("a" * 300_000 + "1" * 300_000 + "@" * 1000 + "." * 1000) == []


def test_votes_round_trip():
    for vote in ((1, -1, 0, 1, -1, 0), (-1,) * 6, (1,) * 6):
        assert unpack(pack(vote, 301)) == (list(vote), 301)


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6, 0.5])
    votes = np.where(rng.random((20_000, 6)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    table, post = reliabilities(votes, np.ones(20_000))
    assert np.abs(table[1, :, 2] - right).max() < 0.05
    assert ((post > 0.5) == truth).mean() > 0.95


def test_classifier_follows_soft_labels():
    feature = np.array([4 | 8 | 16, 4, 5, 5 | 32])
    chance = span_classifier(feature, np.array([0.95, 0.1, 0.05, 0.9]), np.array([100.0, 100, 50, 50]))
    assert chance[4 | 8 | 16] > 0.5 > chance[4] and chance[5] < 0.5


def test_find_and_mask(spark, docs):
    rows = [(i, f"words here password=ab12cd34ef56{i} and more text") for i in range(30)]
    rows += [(100 + i, f"ratio = abcdef, x: nothing{i}el") for i in range(5)]
    rows += [(200, "mail bob@example.com now"), (201, None), (202, ""), (202, ""), (None, "ip 10.0.0.1")]
    df = docs(rows).withColumn("__spans", F.lit("mine"))
    found = find_pii(df).collect()
    assert len(found) == len(rows)
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["base"]) for s in r["spans"]] for r in found}
    assert spans[200] == [("email", 5, 20, True)] and spans[None] == [("ip", 3, 11, True)]
    assert spans[201] == spans[202] == []
    assert spans[3] == [("secret", 20, 33, False)]
    out = redact(df.drop("__spans"))
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == [c for c in df.columns if c != "__spans"]
    assert texts[200] == "mail [EMAIL] now" and texts[None] == "ip [IP]" and texts[201] is None and texts[202] == ""
    assert texts[3] == "words here password=[SECRET] and more text"
    assert find_pii(docs([])).count() == 0 and redact(docs([])).count() == 0


def test_mask_joins_overlaps():
    assert mask("abcdefgh", [("card", 1, 4), ("phone", 3, 6), ("ip", 7, 8)]) == "a[CARD]g[IP]"
    assert BASE_KINDS == ("email", "ip", "card", "phone")


def test_long_values_are_masked_whole(docs):
    long = "ab12cd34" * 40
    rows = [(i, f"words here password=ab12cd34ef56{i} and more text") for i in range(30)]
    rows += [(100, f"token={long} end"), (101, f"token={long}4111111111111111{long} end")]
    texts = {r["doc_id"]: r["text"] for r in redact(docs(rows)).collect()}
    assert texts[100] == "token=[SECRET] end" and texts[101] == "token=[SECRET] end"


def test_overlaps_are_settled_among_accepted_candidates():
    names = ("kind", "start", "end", "base", "code")
    spans = [dict(zip(names, c)) for c in candidates("ref: DE89370400440532013000 end")]
    assert [(KINDS[s["kind"]], s["start"], s["end"]) for s in spans] == [
        ("secret", 5, 27), ("code", 5, 27), ("number", 7, 27)]
    chance = np.zeros(512)
    assert accepted(spans, chance) == []
    chance[spans[1]["code"] % 512] = 0.9           # the code alone
    assert accepted(spans, chance) == [("code", 5, 27, False)]
    chance[spans[0]["code"] % 512] = 0.9
    assert len(accepted(spans, chance)) == 1
