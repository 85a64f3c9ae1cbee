"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

1. One pass per whole text finds candidate spans: the base kinds (e-mail, IP
   address, card number, phone number, by fixed patterns and checks) and wider
   ones (values assigned to a keyword, long codes, dashed numbers, base matches
   that fail their check).  Labelers - pattern, checksum, gazetteer of keywords,
   gazetteer of known beginnings and endings, context, make-up - each vote +1,
   -1 or 0.  Votes and a few span features are packed into one number.
2. Candidates are counted per distinct pattern of votes and features.  Both are
   built from a fixed number of small fields, so however large the input there
   are at most 3^6 * 512 patterns; the counts, not the candidates, reach the driver.
3. Expectation-maximisation over the vote patterns estimates each labeler's
   reliability and each pattern's probability; a logistic span classifier is
   trained on the features with those probabilities as soft labels.
4. A second pass adds the spans the classifier accepts.  Base spans always stay.

All steps see every row; spans are code-point offsets, end exclusive.

Defined cases: a null or empty text has no spans; null ids and repeated rows are
kept, one result row each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import store

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "code", "number")
LABELERS = 6
CLEAR = 128      # leading characters of an assigned value that must hold no base span

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGNED = re.compile(r"[=:]\x20?\"?([^\s\"=:,;]{6,}+)")
CODE = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[A-Z0-9]{13,32}(?![0-9A-Za-z])")
DASHED = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# fixed values: keywords that announce personal data or secrets, and usual endings of host names
KEYWORDS = {"password", "passwd", "pwd", "pass", "secret", "token", "key", "apikey", "api_key", "auth",
            "mail", "email", "e-mail", "contact", "tel", "phone", "call", "fax", "mobile", "ip", "host", "addr",
            "card", "visa", "credit", "account", "iban", "ssn", "passport", "id"}
SECRET_WORDS = {"password", "passwd", "pwd", "pass", "secret", "token", "key", "apikey", "api_key", "auth"}
HOST_ENDINGS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info", "example"}
CODE_STARTS = ("AKIA", "ASIA", "DE", "FR", "ES", "GB", "NL", "IT")


# --- base spans -----------------------------------------------------------------

def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Leftmost non-overlapping matches; found from each @, so that long runs stay linear."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL))
        low = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end(), True
            low = m.end()
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in reversed(digits)]
    return sum(values[::2] + [2 * v - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        yield m.start(), m.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 9:
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) >= 9:
                yield m.start(), m.end(), 13 <= len(digits) <= 19 and luhn(digits)


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            yield m.start(), m.end(), 9 <= sum(map(str.isdigit, m[0])) <= 15


BASE = (emails, ips, cards, phones)


# --- candidates, votes, features ------------------------------------------------

def _word_before(text: str, start: int) -> str:
    left = text[max(0, start - 32):start].rstrip(" \"'=:(\t")
    cut = re.search(r"[A-Za-z_-]+$", left)
    return cut[0].lower() if cut else ""


def _context(text: str, start: int, end: int) -> int:
    """+1 between ordinary words or at a text end, -1 among digits or cell separators."""
    left, right = text[max(0, start - 2):start].strip(), text[end:end + 2].strip()
    if (left[-1:].isdigit() or right[:1].isdigit() or "|" in left + right):
        return -1
    return 1 if text[max(0, start - 1):start].strip(" \n\t\"=:") == "" else 0


def _make_up(span: str) -> int:
    """+1 for varied characters, -1 for a few repeated ones."""
    variety = len(set(span)) / min(len(span), 16)
    return 1 if variety >= 0.5 else -1 if variety < 0.25 else 0


def votes(text: str, kind: int, start: int, end: int, passed: bool) -> tuple[int, ...]:
    """One vote of -1, 0 or +1 per labeler."""
    span, name, word = text[start:end], KINDS[kind], _word_before(text, start)
    digits = sum(map(str.isdigit, span))
    if kind < len(BASE_KINDS):
        pattern = 1 if passed else -1
    else:
        pattern = 1 if name == "secret" and word in SECRET_WORDS else 0 if name != "number" else -1
    if name in ("card", "number"):
        checksum = 1 if passed else -1
    elif name in ("ip", "phone"):
        checksum = 1 if passed else -1
    else:
        checksum = 0
    keyword = 1 if word in KEYWORDS else 0 if kind < len(BASE_KINDS) else -1
    if name == "email":
        ending = span.rpartition(".")[2].lower()
        known = 1 if ending in HOST_ENDINGS else 0
    elif name == "card":
        known = 1 if span[0] in "3456" else -1
    elif name == "code":
        known = 1 if span.startswith(CODE_STARTS) and digits >= 2 else -1
    elif name == "secret":
        known = 1 if 4 <= digits < len(span) else -1 if digits == 0 else 0
    else:
        known = 0
    return pattern, checksum, keyword, known, _context(text, start, end), _make_up(span)


def features(text: str, kind: int, start: int, end: int, passed: bool) -> int:
    """Span features in 9 bits: kind (3), check passed, keyword before, mixed letters and digits, length, context."""
    span = text[start:end]
    digits = any(map(str.isdigit, span))
    letters = any(map(str.isalpha, span))
    bits = [passed, _word_before(text, start) in KEYWORDS, digits and letters, len(span) >= 16,
            _context(text, start, end) > 0, _make_up(span) > 0]
    return kind | sum(int(b) << (3 + i) for i, b in enumerate(bits))


def pack(vote: tuple[int, ...], feature: int) -> int:
    code = 0
    for v in vote:
        code = 3 * code + v + 1
    return code * 512 + feature


def unpack(code: int) -> tuple[list[int], int]:
    feature, code, vote = code % 512, code // 512, []
    for _ in range(LABELERS):
        vote.append(code % 3 - 1)
        code //= 3
    return vote[::-1], feature


def candidates(text: str) -> list[tuple[int, int, int, bool, int]]:
    """(kind, start, end, is base span, packed votes and features), by kind, then start."""
    found = []
    for kind, find in enumerate(BASE):
        for start, end, passed in find(text):
            found.append((kind if passed else KINDS.index("number"), start, end, passed))
    wide = []
    if "=" in text or ":" in text:
        for m in ASSIGNED.finditer(text):
            if _word_before(text, m.start()):
                wide.append((KINDS.index("secret"), m.start(1), m.end(1)))
    wide += [(KINDS.index("code"), m.start(), m.end()) for m in CODE.finditer(text)]
    wide += [(KINDS.index("number"), m.start(), m.end()) for m in DASHED.finditer(text)]
    if not wide and not found:
        return []
    base = sorted((s, e) for _, s, e, passed in found if passed)
    taken = [(kind, s, e, passed) for kind, s, e, passed in found if passed]
    others = sorted({(s, -e, kind) for kind, s, e in wide}
                    | {(s, -e, kind) for kind, s, e, passed in found if not passed})
    i = 0
    for s, minus_e, kind in others:      # clear of base spans; overlaps are settled among the accepted ones
        e = -minus_e
        while i < len(base) and base[i][1] <= s:
            i += 1
        # base spans far inside a long value do not keep the rest of it from being judged
        near = min(e, s + CLEAR) if kind == KINDS.index("secret") else e
        if not any(b < near and s < f for b, f in base[max(0, i - 8):i + 8]):
            taken.append((kind, s, e, False))
    taken.sort()
    return [(k, s, e, p, pack(votes(text, k, s, e, p), features(text, k, s, e, p))) for k, s, e, p in taken]


SPAN = T.StructType([T.StructField("kind", T.ByteType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
                     T.StructField("code", T.IntegerType())])
ARROW_SPAN = pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32()),
                        ("base", pa.bool_()), ("code", pa.int32())])


def with_candidates(df: DataFrame, text_col: str = "text", out_col: str = "__spans", keep_text: bool = True) -> DataFrame:
    """``df`` plus an array of candidate spans (the text itself only if ``keep_text``)."""
    at = df.columns.index(text_col)

    def find(batches):
        for batch in batches:
            rows = [[dict(zip(SPAN.names, c)) for c in candidates(t)] if t else []
                    for t in batch.column(at).to_pylist()]
            cols, names = list(batch.columns), list(batch.schema.names)
            if not keep_text:
                cols.pop(at)
                names.pop(at)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(rows, pa.list_(ARROW_SPAN))], names=[*names, out_col])

    fields = [f for f in df.schema if keep_text or f.name != text_col]
    return df.mapInArrow(find, T.StructType([*fields, T.StructField(out_col, T.ArrayType(SPAN))]))


# --- reliabilities and the classifier -------------------------------------------

def reliabilities(vote: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM for conditionally independent labelers: P(vote | class) [2, labelers, 3] and P(class 1 | pattern)."""
    total = vote.sum(axis=1)
    post = 1 / (1 + np.exp(-total.astype(float)))
    seen = vote + 1
    table = np.full((2, vote.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        prior = np.clip((post * weight).sum() / max(weight.sum(), 1e-9), 0.01, 0.99)
        for c, p in enumerate((1 - post, post)):
            for j in range(vote.shape[1]):
                n = np.bincount(seen[:, j], weights=p * weight, minlength=3) + 1.0
                table[c, j] = n / n.sum()
        logs = [np.log(table[c][np.arange(vote.shape[1]), seen]).sum(axis=1) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(logs[0] + np.log(1 - prior) - logs[1] - np.log(prior), -50, 50)))
        if np.abs(new - post).max(initial=0) < 1e-6:
            return table, new
        post = new
    return table, post


def _design(feature: np.ndarray) -> np.ndarray:
    """Kind one-hot, bits, and each bit within the assigned-value and code kinds."""
    kind = (feature[:, None] & 7) == np.arange(8)
    bits = (feature[:, None] >> np.arange(3, 9)) & 1
    inside = [bits * kind[:, [k]] for k in (KINDS.index("secret"), KINDS.index("code"))]
    return np.hstack([np.ones((len(feature), 1)), kind, bits, *inside]).astype(float)


def span_classifier(feature: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression on soft labels (Newton steps, ridge); P(personal) for each feature value 0..511."""
    x = _design(feature)
    w = np.zeros(x.shape[1])
    scale = weight / max(weight.sum(), 1e-9) * 1000
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (scale * (p - label)) + 0.1 * w
        hess = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(_design(np.arange(512)) @ w, -30, 30)))


def train(spans: DataFrame, spans_col: str = "__spans") -> np.ndarray:
    """Acceptance probability per feature value, from the counted patterns of all candidates."""
    counts = (spans.select(F.explode(spans_col).alias("s")).groupBy(F.col("s")["code"].alias("code"))
              .agg(F.count("*").alias("n")).toArrow())
    if counts.num_rows == 0:
        return np.zeros(512)
    order = np.argsort(np.asarray(counts["code"]))
    codes, n = np.asarray(counts["code"])[order], np.asarray(counts["n"])[order].astype(float)
    parts = [unpack(int(c)) for c in codes]
    vote, feature = np.array([v for v, _ in parts]), np.array([f for _, f in parts])
    _, post = reliabilities(vote, n)
    return span_classifier(feature, post, n)


def accepted(spans: list[dict], chance: np.ndarray) -> list[tuple[str, int, int, bool]]:
    """Base spans and, leftmost longest, the candidates the classifier accepts: (kind, start, end, base)."""
    out, last = [s for s in spans if s["base"]], -1
    for s in sorted((s for s in spans if not s["base"] and chance[s["code"] % 512] >= 0.5),
                    key=lambda s: (s["start"], -s["end"], s["kind"])):
        if s["start"] >= last:
            out.append(s)
            last = s["end"]
    out.sort(key=lambda s: (s["kind"], s["start"], s["end"]))
    return [(KINDS[s["kind"]], s["start"], s["end"], s["base"]) for s in out]


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans`` (array of kind, start, end, base) per row."""
    found = store(with_candidates(df.select(id_col, text_col), text_col, keep_text=False), "pii")
    chance = df.sparkSession.sparkContext.broadcast(train(found))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def decide(batches):
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in accepted(r, chance.value)]
                    for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=[id_col, "spans"])

    return found.select(id_col, "__spans").mapInArrow(decide, T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])))]))


def mask(text: str, spans: list[tuple]) -> str:
    """The text with each maximal covered stretch replaced by ``[KIND]`` of its first span."""
    out, last = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with accepted spans of ``text_col`` masked; null texts stay null, other columns unchanged."""
    found = store(with_candidates(df, text_col), "pii_rows")
    chance = df.sparkSession.sparkContext.broadcast(train(found))
    at = df.columns.index(text_col)

    def apply(batches):
        for batch in batches:
            texts = [mask(t, accepted(s, chance.value)) if t and s else t
                     for t, s in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            cols = list(batch.columns[:-1])
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return found.mapInArrow(apply, df.schema)


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
