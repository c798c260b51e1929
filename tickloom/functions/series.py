"""Row frames over one ordered series of bars, as SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Append new columns, given as name -> SQL expression over the columns already there.

    One call per step: the expressions reach the JVM as text, so a plan with
    dozens of columns is built in a fraction of a second.
    """
    return df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in columns.items()])


@dataclass(frozen=True)
class Series:
    """Which rows form one series and how they are ordered.

    Frames count rows, never calendar days, and a trailing frame leaves the
    current row out. A frame that reaches past the first row is cut short.
    """

    keys: tuple[str, ...] = ("SYMBOL",)
    order: tuple[str, ...] = ("DATE",)

    def by(self, *extra: str) -> Series:
        """The series split further by more key columns."""
        return replace(self, keys=self.keys + extra)

    def _over(self, call: str, frame: str = "") -> str:
        return f"{call} OVER (PARTITION BY {', '.join(self.keys)} ORDER BY {', '.join(self.order)}{frame})"

    def _trailing(self, call: str, rows: int) -> str:
        return self._over(call, f" ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING")

    def before(self, column: str, rows: int = 1) -> str:
        return self._over(f"lag({column}, {rows})")

    def after(self, column: str) -> str:
        return self._over(f"lead({column})")

    def mean(self, column: str, rows: int) -> str:
        return self._trailing(f"avg({column})", rows)

    def total(self, column: str, rows: int) -> str:
        return self._trailing(f"sum({column})", rows)

    def known(self, column: str, rows: int) -> str:
        return self._trailing(f"count({column})", rows)

    def highest(self, column: str, rows: int) -> str:
        return self._trailing(f"max({column})", rows)

    def lowest(self, column: str, rows: int) -> str:
        return self._trailing(f"min({column})", rows)


BY_SYMBOL = Series()
