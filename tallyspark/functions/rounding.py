"""Exact, engine-independent rounding.

Money is summed as DECIMAL (exact, order-independent) and rounded at the
end. Averages and ratios are rounded from exact integers with the rule
"half away from zero":

    R = sign(a*b) * ((2*|a| + |b|) div (2*|b|))

where ``a / b`` is the scaled value. Floating averages would round
differently in different engines (and differently for different partition
orders), so every rounded average goes through ``round_ratio``. Each helper
has a DuckDB text twin (``sql_*``) so oracles apply the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"
_INT = "decimal(38,0)"


def _as_int(c: Column, scale: int) -> Column:
    """Exact integer from a decimal that carries at most ``scale`` digits."""
    if scale:
        c = c * F.lit(10**scale)
    return c.cast(_INT)


def round_ratio(
    num: Column,
    den: Column,
    digits: int,
    num_scale: int = 0,
    den_scale: int = 0,
    mult: int = 1,
) -> Column:
    """round(mult * (num / den), digits) as DOUBLE, exact; NULL when den = 0.

    ``num``/``den`` are decimals or integers with at most ``num_scale`` /
    ``den_scale`` fractional digits.
    """
    a = _as_int(num, num_scale) * F.lit(mult * 10 ** (den_scale + digits))
    b = _as_int(den, den_scale) * F.lit(10**num_scale)
    q = F.call_function("div", F.abs(a) * F.lit(2) + F.abs(b), F.nullif(F.abs(b), F.lit(0)) * F.lit(2))
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    return signed.cast("double") / F.lit(float(10**digits)) + F.lit(0.0)


def round_money(c: Column, digits: int = 2) -> Column:
    """Round an exact decimal (sum, min, max) and hand it out as DOUBLE."""
    return F.round(c, digits).cast("double") + F.lit(0.0)


def avg_round(c: Column, digits: int, scale: int) -> Column:
    """round(avg(c), digits) exactly, for a decimal/integer column with ``scale`` digits."""
    return round_ratio(F.sum(c), F.count(c), digits, num_scale=scale)


# ---------------------------------------------------------------- DuckDB twins


def sql_round_ratio(num: str, den: str, digits: int, num_scale: int = 0, den_scale: int = 0, mult: int = 1) -> str:
    a = f"(CAST(({num}) * {10**num_scale} AS HUGEINT) * {mult * 10 ** (den_scale + digits)})"
    b = f"(CAST(({den}) * {10**den_scale} AS HUGEINT) * {10**num_scale})"
    q = f"((2 * abs({a}) + abs({b})) // (2 * nullif(abs({b}), 0)))"
    signed = f"(CASE WHEN ({a} < 0) <> ({b} < 0) THEN -{q} ELSE {q} END)"
    return f"(CAST({signed} AS DOUBLE) / {float(10**digits)!r} + 0.0)"


def sql_round_money(expr: str, digits: int = 2) -> str:
    return f"(CAST(ROUND({expr}, {digits}) AS DOUBLE) + 0.0)"


def sql_avg_round(col: str, digits: int, scale: int) -> str:
    return sql_round_ratio(f"SUM({col})", f"COUNT({col})", digits, num_scale=scale)
