"""String and predicate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# After form-encoding, these escapes are turned back so the
# result matches a URI-component encoding (space as %20; ! ' ( ) ~ kept).
URI_COMPONENT_FIXUPS = (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"),
                        ("%7E", "~"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uri_component(c) -> Column:
    """UTF-8 form encoding (``url_encode``) with the fix-ups above."""
    out = F.url_encode(_c(c))
    for a, b in URI_COMPONENT_FIXUPS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def eq_number(c, n) -> Column:
    """Text column compared with a number (numeric compare; bad text
    raises under ANSI, as a cast does)."""
    return _c(c).cast("double") == F.lit(n).cast("double")


def eq_optional(c, value) -> Column:
    """Equality with an optional value; a null value or cell never matches."""
    return F.lit(False) if value is None else F.coalesce(_c(c) == F.lit(value), F.lit(False))


def text_is_true(c) -> Column:
    """Boolean stored as text (``'true'``, any case) -> boolean predicate."""
    return F.coalesce(F.lower(F.trim(_c(c))) == F.lit("true"), F.lit(False))
