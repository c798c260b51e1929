"""Arithmetic and casts, as SQL text, that give NULL where the ANSI forms would raise."""

from __future__ import annotations


def ratio(numerator: str, denominator: str) -> str:
    """Double division; NULL for a zero or NULL denominator."""
    return f"try_divide({numerator}, {denominator})"


def pct_change(new: str, old: str) -> str:
    """Change from old to new in percent points."""
    return f"{ratio(f'{new} - {old}', old)} * 100"


def growth(new: str, old: str) -> str:
    """Change from old to new as a fraction."""
    return f"{ratio(new, old)} - 1"


def to_double(text: str) -> str:
    return f"try_cast({text} AS double)"


def to_day(text: str) -> str:
    return f"try_cast({text} AS date)"


def to_long(text: str) -> str:
    """Whole part of a plain decimal; NULL for any other text.

    ``'123.7'`` gives 123 (cut, not rounded) and ``'1e3'`` gives NULL. A plain
    ``try_cast`` to bigint would give NULL for every text with a point.
    """
    plain = r"r'^[\x00-\x20]*([+-]?[0-9]*)([.]?)[0-9]*[\x00-\x20]*$'"
    whole, point = f"regexp_extract({text}, {plain}, 1)", f"regexp_extract({text}, {plain}, 2)"
    return f"CASE WHEN {whole} RLIKE '[0-9]' THEN try_cast({whole} AS bigint) WHEN {point} <> '' THEN 0L END"
