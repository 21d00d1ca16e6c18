"""Numeric helpers: exact money sums, guarded division, SQL-style rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimal places that money sums add exactly (a parameter of the helpers below).
MONEY_SCALE = 6
#: Digits of one exact amount; larger amounts are summed as doubles.
MONEY_DIGITS = 18


def to_double(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(T.DoubleType())


def _exact_below(scale: int) -> float:
    return float(10 ** (MONEY_DIGITS - scale - 1))


def exact_part(amount: Column, scale: int = MONEY_SCALE) -> Column:
    """The amount as a decimal of ``scale`` places; NULL where it is too large for that."""
    return F.when(F.abs(amount) < F.lit(_exact_below(scale)), amount.cast(T.DecimalType(MONEY_DIGITS, scale)))


def large_part(amount: Column, scale: int = MONEY_SCALE) -> Column:
    """What ``exact_part`` leaves of the amount, as a double: all of one that is too
    large for it, else the digits beyond its last place (zero for most amounts)."""
    exact = exact_part(amount, scale)
    return F.when(F.abs(amount) >= F.lit(_exact_below(scale)), amount).otherwise(amount - to_double(exact))


class Money:
    """A sum of amounts held in two columns, ``<name>_d`` and ``<name>_b``.

    The decimal column adds exactly and independently of the order of rows;
    the double column takes amounts beyond its range, so that no finite amount
    can overflow, and digits beyond its places, so that no small amount is cut.
    Every linear operation works on both.
    """

    def __init__(self, exact: Column, large: Column) -> None:
        self.exact, self.large = exact, large

    @classmethod
    def named(cls, name: str) -> "Money":
        return cls(F.col(f"{name}_d"), F.col(f"{name}_b"))

    @classmethod
    def of(cls, amount: Column, scale: int = MONEY_SCALE) -> "Money":
        return cls(exact_part(amount, scale), large_part(amount, scale))

    def when(self, condition: Column) -> "Money":
        return Money(F.when(condition, self.exact), F.when(condition, self.large))

    def sum(self) -> "Money":
        return Money(F.sum(self.exact), F.sum(self.large))

    def over(self, window) -> "Money":
        return Money(self.exact.over(window), self.large.over(window))

    def lag(self, window) -> "Money":
        """The previous row's sum: zero parts where a part is NULL, NULL where there is no row."""
        whole = self.filled()
        return Money(F.lag(whole.exact).over(window), F.lag(whole.large).over(window))

    def filled(self) -> "Money":
        zero = F.lit(0).cast(T.DecimalType(38, MONEY_SCALE))
        return Money(F.coalesce(self.exact, zero), F.coalesce(self.large, F.lit(0.0)))

    def minus(self, other: "Money") -> "Money":
        """The difference; NULL where ``other`` has no row."""
        whole = self.filled()
        return Money(whole.exact - other.exact, whole.large - other.large)

    def value(self) -> Column:
        """The sum as a double; NULL where both parts are."""
        both = F.coalesce(to_double(self.exact), F.lit(0.0)) + F.coalesce(self.large, F.lit(0.0))
        return F.when(self.exact.isNotNull() | self.large.isNotNull(), both)

    def columns(self, name: str) -> list[Column]:
        return [self.exact.alias(f"{name}_d"), self.large.alias(f"{name}_b")]


#: From here on a double has no fraction left to round.
_WHOLE = float(2 ** 52)


def round_half_away(col: Column | str, places: int = 2) -> Column:
    """Round a DOUBLE half away from zero, as SQL ``round(x, n)`` does.

    Spark's own ``round`` goes through BigDecimal and disagrees with the
    usual double rounding on near-ties; this form scales, floors and scales
    back, which matches it. A value too large to have a fraction at that
    scale (or one that is not finite) is returned as it is.
    """
    c = to_double(col)
    scale = float(10 ** places)
    rounded = F.signum(c) * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(c) * F.lit(scale) < F.lit(_WHOLE), rounded).otherwise(c)


def safe_div(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)`` in double arithmetic (NULL instead of an error)."""
    return to_double(num) / F.nullif(to_double(den), F.lit(0.0))
