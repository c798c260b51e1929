"""Text labels derived from comparisons, as SQL text."""

from __future__ import annotations

SPIKE_FACTOR = "1.5D"


def compared(value: str, other: str, above: str, below: str, rest: str) -> str:
    """Label a comparison; equal values and NULLs both take ``rest``."""
    return f"CASE WHEN {value} > {other} THEN '{above}' WHEN {value} < {other} THEN '{below}' ELSE '{rest}' END"


def signed(value: str, above: str, below: str, zero: str) -> str:
    """Label the sign of a value; NULL stays NULL."""
    return f"CASE WHEN {value} IS NOT NULL THEN {compared(value, '0D', above, below, zero)} END"


def spike(value: str, usual: str) -> str:
    """SPIKE above 1.5 times the usual level, else NORMAL; NULL without a usable level."""
    label = f"if({value} > {SPIKE_FACTOR} * {usual}, 'SPIKE', 'NORMAL')"
    return f"CASE WHEN {value} IS NOT NULL AND {usual} <> 0 THEN {label} END"
