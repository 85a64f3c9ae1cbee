"""Text helpers: JVM-style splitting and the two tokenizer chains.

``java_split`` reproduces ``String.split(regex)`` (limit 0): trailing empty
pieces vanish, an empty text gives one empty piece and a text made only of
separators gives no piece.  Spark's ``split`` keeps trailing empties, so the
trailing separator run is stripped first (``\\z`` = absolute end of text).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words of the job-title tokenizer (M21), as listed by the reference.
TITLE_STOPWORDS = (
    "ax", "i", "you", "edu", "s", "t", "m", "subject", "can", "lines", "re", "what",
    "there", "all", "we", "one", "the", "a", "an", "of", "or", "in", "for", "by", "on",
    "but", "is", "in", "a", "not", "with", "as", "was", "if", "they", "are", "this", "and", "it", "have",
    "from", "at", "my", "be", "by", "not", "that", "to", "from", "com", "org", "like", "likes", "so",
)
# Ignored words and characters of the message tokenizer.
MESSAGE_IGNORED_WORDS = ("the", "a", "", "in", "on", "at", "as", "not", "for")
MESSAGE_IGNORED_CHARS = (",", ":", ";", "/", "<", ">", '"', ".", "(", ")", "?", "-", "'", "!", "0", "1")
# The stop list of the stream filter.
STREAM_STOP_LIST = ("fail", "sad")

WORD_SPLIT = r"\W+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _tail_regex(sep_regex: str) -> str:
    # A run of separators at the very end; avoid nested quantifiers.
    return (sep_regex if sep_regex.endswith("+") else f"(?:{sep_regex})+") + r"\z"


_LITERAL = re.compile(r"^\\?([^\w\\.*+?^$|()\[\]{}])$")      # one plain character, escaped or not
_ONE_CHAR = re.compile(r"^(?:\\.|\\[A-Za-z]|[^\\\[\](){}.*+?^$|])\+?$")


def _strip_trailing(col: Column, sep_regex: str) -> Column:
    r"""Remove the trailing separator run in linear time.

    A plain ``sep+\z`` is retried at every position of a long separator run
    in the middle of a text (quadratic on junk).  For one-character
    separators (``\W+``, a blank, a comma) the match may only start where a
    run starts (negative look-behind) and takes the run possessively, so
    every run is scanned once.  One plain character needs no regex at all."""
    literal = _LITERAL.match(sep_regex)
    if literal:
        return F.rtrim(col, F.lit(literal.group(1)))
    if _ONE_CHAR.match(sep_regex):
        unit = sep_regex[:-1] if sep_regex.endswith("+") else sep_regex
        return F.regexp_replace(col, f"(?<!{unit})(?:{unit})++\\z", "")
    return F.regexp_replace(col, _tail_regex(sep_regex), "")


def java_split(c, sep_regex: str) -> Column:
    """``String.split(sep_regex)`` semantics on a string column."""
    col = _c(c)
    stripped = _strip_trailing(col, sep_regex)
    return (F.when(col == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, sep_regex, -1)))


def split_keep(c, delim: str, trim: bool = True) -> Column:
    """split by a literal, keep trailing empties, optionally trim cells."""
    parts = F.split(_c(c), re.escape(delim), -1)
    return F.transform(parts, lambda x: F.trim(x)) if trim else parts


def text_lines(c) -> Column:
    r"""Lines of a text as a line reader yields them: ``\r\n``, ``\r`` or
    ``\n`` ends a line, and a final line break does not open an extra empty
    line."""
    col = _c(c)
    # CR LF and lone CR become LF first (only texts that hold a CR pay for the
    # regex); the split on a single LF then takes the JVM's fast path.
    col = F.when(col.contains("\r"), F.regexp_replace(col, "\r\n?", "\n")).otherwise(col)
    parts = F.split(col, "\n", -1)
    n = F.size(parts)
    return F.when((n > 1) & (F.element_at(parts, -1) == ""), F.slice(parts, 1, n - 1)).otherwise(parts)


def no_digit(x: Column) -> Column:
    """the whole word matches ``[^0-9]*``, i.e. it holds no digit."""
    return ~x.rlike("[0-9]")


def raw_title_words(c) -> Column:
    """F04 + F03 + F05: split on non-word runs, lower-case, drop words with digits."""
    words = F.transform(java_split(c, WORD_SPLIT), lambda x: F.lower(x))
    return F.filter(words, no_digit)


def title_words(c, stopwords=TITLE_STOPWORDS, min_len: int = 2) -> Column:
    """M21 without the rare-word step: + stop words (F06) + length >= 2."""
    stop = F.array(*[F.lit(w) for w in sorted(set(stopwords))])
    return F.filter(raw_title_words(c),
                    lambda x: (~F.array_contains(stop, x)) & (F.length(x) >= min_len))


def jvm_length(x: Column) -> Column:
    """Length in UTF-16 code units, like ``String.length`` on the JVM (a
    character outside the Basic Multilingual Plane counts twice)."""
    return (F.octet_length(F.encode(x, "UTF-16BE")) / 2).cast("int")


def message_words(c, ignored_words=MESSAGE_IGNORED_WORDS, ignored_chars=MESSAGE_IGNORED_CHARS,
                  min_len: int = 3) -> Column:
    """Lower (F03), listed chars -> blank (F08), split on blank (F02),
    drop ignored words and words of length <= 2 (F06, F07), distinct in
    first-seen order (F09)."""
    chars = "".join(ignored_chars)
    text = F.translate(F.lower(_c(c)), chars, " " * len(chars))
    ign = F.array(*[F.lit(w) for w in ignored_words])
    words = F.filter(java_split(text, " "),
                     lambda x: (~F.array_contains(ign, x)) & (jvm_length(x) >= min_len))
    return F.array_distinct(words)
