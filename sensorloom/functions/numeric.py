"""Exact-decimal helpers: rounding, means and correlation of the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_numeric(value: Column) -> Column:
    """Double to decimal through its 15 significant digits.

    A float8 is turned to numeric in this way in the SQL dialect of the models,
    so float noise such as 6.964999999999999 does not decide a rounding tie. NaN,
    infinities and numbers from 1e20 on do not fit the decimal and become NULL.
    """
    return F.when(value.isNotNull(), _digits(value).try_cast("decimal(38,18)"))


def _digits(value: Column) -> Column:
    return F.format_string("%.14e", value.cast("double"))


def round_numeric(value: Column, places: int) -> Column:
    """``ROUND(value::numeric, places)`` of a double, half away from zero, as ``decimal(38,places)``.

    From 1e20 on the 15 digits have no fraction and are taken as they are. NaN and
    infinities become NULL, which the raw suite's NaN checks report; a finite number
    that does not fit raises an error.
    """
    kind, number = f"decimal(38,{places})", value.cast("double")
    fits = F.coalesce(F.round(to_numeric(value), places).cast(kind), _digits(value).try_cast(kind))
    finite = ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    too_large = F.raise_error(F.concat(F.lit("no decimal holds "), number.cast("string"))).cast(kind)
    return F.when(value.isNotNull(), F.coalesce(fits, F.when(finite, too_large)))


def exact_mean(column: str, scale: int = 0) -> Column:
    """Mean of an integer or ``decimal(_, scale)`` column, never through a double."""
    total = F.sum(column).cast(f"decimal({22 + scale},{scale})")
    return F.try_divide(total, F.count(column).cast("decimal(14,0)"))


def pearson(x: str, y: str) -> Column:
    """Pearson correlation of two columns as an aggregate.

    Pairs with a NULL side are ignored. NULL below two pairs or when either side
    is constant, which is tested on min and max: merged partial variances of a
    constant are not always exactly zero.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs = F.when(both, F.col(x).cast("double"))
    ys = F.when(both, F.col(y).cast("double"))
    varies = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.when(varies, F.try_divide(F.covar_pop(xs, ys), spread))
