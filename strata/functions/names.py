"""Column-name helpers. They look at ``df.columns`` only and never scan data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def clashes(names: Iterable[str]) -> list[str]:
    """Names, lower-cased, that two or more of ``names`` have in common."""
    seen: set[str] = set()
    twice: set[str] = set()
    for n in map(str.lower, names):
        (twice if n in seen else seen).add(n)
    return sorted(twice)


def require_distinct(names: Iterable[str], what: str) -> None:
    """Raise unless all names differ when letter case is ignored."""
    if twice := clashes(names):
        raise ValueError(f"{what}: ambiguous column names {', '.join(twice)}")


def lowercase_columns(df: DataFrame) -> DataFrame:
    """All columns under lower-case names, in their order.

    The names are compared as strings first: Spark resolves names without
    regard to case, so ``VendorID`` beside ``vendorid`` would be ambiguous.
    """
    require_distinct(df.columns, "cannot lower-case")
    return df.toDF(*map(str.lower, df.columns))


def missing_columns(required: Iterable[str], actual: Iterable[str]) -> list[str]:
    """Sorted required names that are absent (exact, case-sensitive match)."""
    return sorted(set(required) - set(actual))


def require_text(value: str, what: str) -> str:
    """``value`` if it has a visible character, else ``ValueError``."""
    if not (value or "").strip():
        raise ValueError(f"{what} needs a value")
    return value
