"""DuckDB text fragments that mirror the Spark text helpers (oracle side only)."""

from __future__ import annotations


def jsplit(expr: str, sep: str, tail: str) -> str:
    """``String.split`` semantics in DuckDB SQL (RE2 ``$`` = end of text)."""
    stripped = f"regexp_replace({expr}, '{tail}', '')"
    return (f"(CASE WHEN {expr} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({stripped}, '{sep}') END)")


def lines(expr: str) -> str:
    l = f"regexp_split_to_array({expr}, '\r\n|\r|\n')"
    return f"(CASE WHEN len({l}) > 1 AND {l}[-1] = '' THEN {l}[1:-2] ELSE {l} END)"


def str_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
