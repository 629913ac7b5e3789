"""Sums of money amounts that neither depend on the order of rows nor cut an amount.

A sum of doubles depends on the order in which partitions are merged, so a
retried task or another cluster size changes the last digits. Here each amount
takes the cheapest exact way:

* a DECIMAL column is summed as DECIMAL;
* an amount of at most four decimals (the common case) becomes integer units in
  two 64-bit halves, inside whole-stage code generation;
* any other amount below 1e14 is summed as a decimal of twelve places, taken
  from its shortest decimal form;
* what no decimal holds (NaN, Infinity, larger amounts) is summed as a double
  and added on, so that no row is lost and none ends the job.

Only the last kind depends on the order of rows. Amounts are rounded to twelve
places; the low half keeps 20 bits and overflows beyond 2^43 rows in one group.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALE = 4
LOW_BITS = 20
UNITS_BELOW = 9e11  # units of larger amounts are no exact doubles
DECIMAL_BELOW = 1e14
DECIMAL_TYPE = "decimal(28,12)"


def _sum_sql(amount: str) -> str:
    x = f"cast(({amount}) as double)"
    units = f"rint({x} * 1{'0' * SCALE})"
    plain = f"coalesce(abs({x}) < {UNITS_BELOW:.0f}D and {units} / 1{'0' * SCALE} = {x}, false)"
    decimal = f"coalesce(abs({x}) < {DECIMAL_BELOW:.0f}D, false)"
    whole = f"case when {plain} then cast({units} as bigint) end"
    high = f"coalesce(cast(sum(shiftright({whole}, {LOW_BITS})) as decimal(20,0)), 0BD)"
    low = f"coalesce(cast(sum({whole} & {2**LOW_BITS - 1}) as decimal(20,0)), 0BD)"
    fine = f"coalesce(sum(case when not {plain} and {decimal} then cast({x} as {DECIMAL_TYPE}) end), 0BD)"
    rest = f"coalesce(sum(case when not {plain} and not {decimal} then {x} end), 0D)"
    exact = f"cast(({high} * {2**LOW_BITS} + {low}) * {10**-SCALE:.{SCALE}f} + {fine} as double)"
    doubles = f"case when count({amount}) > 0 then {exact} + {rest} end"
    # The type is a constant, so only one of the two sums is planned, and no maximum.
    return f"case when typeof(max({amount})) like 'decimal%' then cast(sum({amount}) as double) else {doubles} end"


def exact_sum(amount: str) -> Column:
    """Sum of an amount, a column or SQL expression; null when all are null."""
    return F.expr(_sum_sql(amount))


def exact_avg(amount: str) -> Column:
    """Mean of the non-null amounts; null when there are none."""
    return F.expr(f"try_divide({_sum_sql(amount)}, count({amount}))")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part / whole * 100`` as a double; null when ``whole`` is zero."""
    return F.try_divide(_col(part) * F.lit(100.0), _col(whole))


def percent_rounded(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """Percentage of two counts rounded half up, computed on decimals."""
    ratio = F.try_divide(_col(part).cast("decimal(20,0)") * F.lit(100), _col(whole).cast("decimal(20,0)"))
    return F.round(ratio, digits).cast("double")
