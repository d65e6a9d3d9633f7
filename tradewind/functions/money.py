"""Exact money arithmetic on whole cents.

Money rests as DOUBLE with two digits.  One multiplication and ``rint`` turn it
into a BIGINT number of cents, so products stay primitive inside code
generation, and no sum depends on the order of its rows.

The helpers return SQL text, to be used in ``selectExpr`` and ``expr``: one
text costs one call into the JVM, however long the formula.
"""

from __future__ import annotations


def cents(name: str) -> str:
    return f"cast(rint({name} * 100D) as bigint)"


# price * (1 - discount) in units of 1e-4, and with (1 + tax) in units of 1e-6
REVENUE = f"({cents('l_extendedprice')} * (100 - {cents('l_discount')}))"
CHARGE = f"({REVENUE} * (100 + {cents('l_tax')}))"


def exact_sum(units: str) -> str:
    """Sum BIGINT units without overflow, as DECIMAL(38,0).

    The value is split into a high and a low limb with one BIGINT buffer each:
    more than 10^12 rows of 10^12 units fit, while a DECIMAL buffer would box
    every row.  The arithmetic shift keeps this right for negative units.
    """
    return (f"cast(cast(sum(shiftright({units}, 20)) as decimal(28,0)) * 1048576BD"
            f" + cast(sum(({units}) & 1048575) as decimal(20,0)) as decimal(38,0))")


def money(units: str, digits: int) -> str:
    """Exact units to a DOUBLE amount, rounded once."""
    return f"cast(cast({units} as decimal(38,0)) * 1e-{digits}BD as double)"


def ratio(numerator: str, denominator: str, factor: int = 1) -> str:
    """Quotient of two sums to six digits; null when the denominator is zero."""
    return (f"round(try_divide(cast({numerator} as double) * {factor}D,"
            f" cast({denominator} as double)), 6)")


def micros(name: str) -> str:
    """A duration in seconds as whole microseconds, so that sums stay exact."""
    return f"cast(rint({name} * 1000000D) as bigint)"
