"""Rounding, exact averages, missing values and unit conversions as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Binary grid of exact sums: whole multiples of 2**e for each e, then what is below the last one.
# Each part of a value is under 2**22, so sums of 10**12 rows fit a bigint.
_GRID = (28, 6, -16, -38, -60)
_LARGEST = 2.0**50


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    """Round a double to `digits`, ties to even (Spark's `round` sends ties away from zero)."""
    if digits == 0:
        return F.rint(_col(c))
    scale = 10.0**digits
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column, other columns are untouched."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[nan_to_null(c).alias(c) if c in floating else F.col(c) for c in df.columns])


def _parts(c: Column | str) -> list[Column]:
    """A double as whole numbers of each grid step and the rest; every step is exact in doubles.

    The value is rounded to each step of the grid, and a part is what a step adds to the one before.
    Values beyond the grid (2**50 and more, infinities) are the rest as a whole.
    """
    value = nan_to_null(c)
    within = F.abs(value) < F.lit(_LARGEST)
    held = F.when(within, value).otherwise(F.when(value.isNotNull(), F.lit(0.0)))
    steps = [F.rint(held / F.lit(2.0**e)) * F.lit(2.0**e) for e in _GRID]
    parts = [((step - before) / F.lit(2.0**e)).cast("bigint") for e, step, before in zip(_GRID, steps, [F.lit(0.0), *steps])]
    return [*parts, F.when(within, value - steps[-1]).otherwise(value)]


def _mean(parts: list[Column], rest: Column, n: Column) -> Column:
    """The parts are carried upwards, so that all but the first are small, and added from the smallest."""
    carried = []
    above = parts[-1]
    for part in reversed(parts[:-1]):
        step = F.lit(2**22).cast("bigint")
        carry = F.shiftright(above, 22)
        carried.append(above - carry * step)
        above = part + carry
    carried.append(above)
    total = rest
    for e, part in zip(reversed(_GRID), carried):
        total = total + part.cast("double") * F.lit(2.0**e)
    return total / n


# What `exact_sums` adds to a name, with the types, for stored sums.
SUM_PARTS = (*((str(k), T.LongType()) for k in range(len(_GRID))), ("rest", T.DoubleType()), ("n", T.LongType()))


def exact_sums(c: Column | str, name: str) -> list[Column]:
    """The sums behind `exact_avg`, to be aggregated once more by `avg_of_sums`."""
    *parts, rest = _parts(c)
    sums = [F.sum(p).alias(f"{name}_{k}") for k, p in enumerate(parts)]
    return [*sums, F.sum(rest).alias(f"{name}_rest"), F.count(nan_to_null(c)).alias(f"{name}_n")]


def avg_of_sums(name: str) -> Column:
    """Average over groups whose `exact_sums` were taken under this name."""
    return _mean([F.sum(f"{name}_{k}") for k in range(len(_GRID))], F.sum(f"{name}_rest"), F.sum(f"{name}_n"))


def exact_avg(c: Column | str) -> Column:
    """Average that does not depend on the order rows arrive in, and cuts nothing off.

    Values are split on a fixed binary grid into five whole numbers, summed as bigints, so partial sums
    from any number of tasks add up to the same total and a rounding tie cannot flip between runs. What the
    grid does not hold (parts below 2**-60, values from 2**50 on, infinities) is summed as doubles. All
    sums stay in the primitive hash-aggregate path. NaN counts as missing.
    """
    *parts, rest = _parts(c)
    return _mean([F.sum(p) for p in parts], F.sum(rest), F.count(nan_to_null(c)))


def rounded_avg(c: Column | str, digits: int) -> Column:
    return round_half_even(exact_avg(c), digits)


def fahrenheit_to_celsius(c: Column | str) -> Column:
    return round_half_even((_col(c) - F.lit(32.0)) * F.lit(5 / 9), 0)


def inch_to_cm(c: Column | str) -> Column:
    return round_half_even(_col(c) * F.lit(2.54), 0)


def inch_to_mm(c: Column | str) -> Column:
    return round_half_even(_col(c) * F.lit(25.4), 2)


def mph_to_kph(c: Column | str) -> Column:
    return round_half_even(_col(c) * F.lit(1.60934), 1)


def mj_to_kwh_per_m2(c: Column | str) -> Column:
    return round_half_even(_col(c) * F.lit(0.2778), 3)
