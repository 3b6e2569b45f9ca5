"""Aggregate building blocks for the marts.

Sums of doubles are exact: each value is taken apart into whole numbers (its
whole part and three runs of ``BITS`` binary digits behind the point), which are
added as whole numbers, and the total is turned into a double once. So a sum
does not depend on the order or the number of partitions, nothing is rounded
before it is added, and averages are one division of the sum. A value that has
digits beyond those (smaller than about 1e-11 and not zero), is 2**62 or more,
or is no number, raises, as does a total of 2**63. With ``endless``, NaN and
infinite values do not raise: the sum is theirs, as Spark's ``sum`` gives it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, DIGITS = 30, 3
_UNIT = float(1 << BITS)
_LARGEST = float(1 << 62)


def count_flag(col: str) -> Column:
    """``sum(case when flag then 1 else 0 end)``: NULL flags count as 0."""
    return F.count_if(F.coalesce(F.col(col), F.lit(False)))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _combined(total: Column, parts: list[Column]) -> tuple[Column, Column]:
    """(a sum that is not negative as a double, whether the opposite sum is negative or 0)."""
    first, second, third = parts
    second = second + F.shiftright(third, BITS)
    first = first + F.shiftright(second, BITS)
    high = F.try_add(total, F.shiftright(first, BITS))
    mask = F.lit((1 << BITS) - 1)
    low = first.bitwiseAND(mask) * F.lit(1 << BITS) + second.bitwiseAND(mask)
    below = low.cast("double") + third.bitwiseAND(mask).cast("double") / F.lit(_UNIT)
    zero = (high == 0) & (low == 0) & (third.bitwiseAND(mask) == 0)
    return high.cast("double") + below / F.lit(_UNIT * _UNIT), (high < 0) | zero


def _whole(x: Column) -> Column:
    # toward zero, so that what is left is exact and has the sign of x
    return F.when(F.abs(x) < _LARGEST, x.cast("bigint"))


def _total(parts: list[Column], misfits: Column, values: Column) -> Column:
    """The double of an exact sum from the sums of its parts."""
    total, *digits = parts
    up, _ = _combined(total, digits)
    down, positive = _combined(-total, [-p for p in digits])
    # a negative sum is that of the opposite values, so that nothing cancels
    done = F.when(positive, up).otherwise(-down)
    failed = F.raise_error(F.lit("a value or a group is too large or too fine to be added exactly")).cast("double")
    return F.when((misfits > 0) | ((values > 0) & done.isNull()), failed).otherwise(done)


def with_parts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the whole-number parts of double columns, for ``exact_sum(..., ready=True)``.

    Taken apart in steps before an aggregate of many rows, each part is worked
    out once a row.
    """
    df = df.withColumns({f"_{c}_0": _whole(F.col(c)) for c in columns})
    df = df.withColumns({f"_{c}_r": F.col(c) - F.col(f"_{c}_0") for c in columns})
    for i in range(1, DIGITS + 1):
        df = df.withColumns({f"_{c}_r": F.col(f"_{c}_r") * F.lit(_UNIT) for c in columns})
        df = df.withColumns({f"_{c}_{i}": F.col(f"_{c}_r").cast("bigint") for c in columns})
        df = df.withColumns({f"_{c}_r": F.col(f"_{c}_r") - F.col(f"_{c}_{i}") for c in columns})
    return df


def exact_sum(value: Column | str, ready: bool = False, endless: bool = False) -> Column:
    """The sum of a double column, exact and then turned into a double; NULL without values.

    ``ready``: the parts of the named column are there (``with_parts``);
    ``endless``: NaN and infinite values make the sum instead of raising.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    if ready:
        digits = [F.col(f"_{value}_{i}") for i in range(DIGITS + 1)]
        rest = F.col(f"_{value}_r")
    else:
        digits = [_whole(x)]
        rest = x - digits[0]
        for _ in range(DIGITS):
            shifted = rest * F.lit(_UNIT)
            digits.append(shifted.cast("bigint"))
            rest = shifted - digits[-1]
    fits = x.isNotNull()
    if endless:
        fits = F.abs(x) < float("inf")  # NaN is above infinity
    misfits = F.count_if(fits & (digits[0].isNull() | (rest != 0)))
    # NULL where a sum leaves the long range: a total of 2**63, or 2**33 rows of a group
    total = _total([F.try_sum(d) for d in digits], misfits, F.count(x))
    return F.coalesce(F.sum(F.when(~fits, x)), total) if endless else total


def exact_average(value: Column | str, ready: bool = False, endless: bool = False) -> Column:
    """The exact sum divided once by the number of values; NULL without values."""
    x = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(x) > 0, exact_sum(value, ready, endless) / F.count(x).cast("double"))
