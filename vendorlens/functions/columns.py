"""Column expressions shared by the operators. All are built-in Spark SQL
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_days(start, end) -> Column:
    """Whole elapsed 24 h periods from ``start`` to ``end`` (floor, so one
    hour backwards is -1): the calendar-day difference, less one when the
    time of day went backwards. Dates and time-of-day intervals of
    timestamp_ntz values involve no time zone, so a daylight-saving change
    in the session zone cannot shift a day; all arithmetic stays on longs
    (microseconds), exact to the microsecond."""
    s, e = col(start), col(end)

    def time_of_day(t):
        return t - F.to_date(t).cast("timestamp_ntz")

    back = F.when(time_of_day(e) < time_of_day(s), F.lit(1)).otherwise(F.lit(0))
    return (F.datediff(F.to_date(e), F.to_date(s)) - back).cast("int")


def week_sunday(d) -> Column:
    """Week of year, weeks starting on Sunday, 0..53; days before the first
    Sunday of the year are week 0."""
    d = col(d)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("int")


def safe_ratio(num, den) -> Column:
    """num / den as double; null when the denominator is 0 or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def mean_of(total, n) -> Column:
    """Mean from a sum and a count, as double (null on an empty group)."""
    return F.try_divide(col(total).cast("double"), col(n).cast("double"))


def _exact(c) -> Column:
    return col(c).cast("decimal(38,0)")


def var_numerator(n, s, ss) -> Column:
    """n*sum(x^2) - sum(x)^2 computed exactly on integers (decimal(38,0)),
    returned as double. The only rounding is the final conversion, so the
    value does not depend on how rows were split across tasks."""
    return (_exact(n) * _exact(ss) - _exact(s) * _exact(s)).cast("double")


def sample_std(n, s, ss) -> Column:
    """Sample standard deviation of integers from n, sum, sum of squares;
    null when n < 2."""
    den = (_exact(n) * (_exact(n) - F.lit(1))).cast("double")
    return F.when(col(n) >= 2, F.sqrt(var_numerator(n, s, ss) / den))


def pop_std(n, s, ss) -> Column:
    """Population standard deviation of integers; null when n = 0."""
    den = (_exact(n) * _exact(n)).cast("double")
    return F.when(col(n) >= 1, F.sqrt(var_numerator(n, s, ss) / den))


def minmax(x, lo, hi, eps: float = 1e-9) -> Column:
    """(x - lo) / (hi - lo + eps)."""
    return (col(x) - col(lo)) / (col(hi) - col(lo) + F.lit(eps))


def risk_band(score) -> Column:
    s = col(score)
    return (
        F.when(s < 0.25, "Low")
        .when(s < 0.50, "Medium")
        .when(s < 0.75, "High")
        .otherwise("Critical")
    )


def concentration_band(hhi) -> Column:
    h = col(hhi)
    return (
        F.when(h >= 0.75, "Critical")
        .when(h >= 0.50, "High")
        .when(h >= 0.25, "Medium")
        .otherwise("Low")
    )


def _hex_word(h: Column, start: int) -> Column:
    return F.conv(F.substring(h, start, 8), 16, 10).cast("long").cast("double")


def counter_hash(seed, key, i) -> Column:
    """md5 of ``seed|key|i`` - a counter-based source of random bits, so a
    draw depends only on its coordinates, never on partitioning or order.
    MD5 serves as a mixing function here, nothing else."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), col(key).cast("string"), col(i).cast("string")))


def uniform_open(h: Column) -> Column:
    """Uniform in (0, 1] from the first 32 bits of a hex hash."""
    return (_hex_word(h, 1) + F.lit(1.0)) / F.lit(4294967297.0)


def uniform_closed_open(h: Column, start: int = 9) -> Column:
    """Uniform in [0, 1) from 32 bits of a hex hash."""
    return _hex_word(h, start) / F.lit(4294967296.0)


def standard_normal(seed, key, i) -> Column:
    """Box-Muller standard normal from the counter hash."""
    h = counter_hash(seed, key, i)
    u1 = uniform_open(h)
    u2 = uniform_closed_open(h, 9)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def round_float(x, digits: int) -> Column:
    """Round half away from zero on x * 10^digits, for doubles. Written out
    (rather than ``round``) so the rounding rule is explicit: engines differ
    in how they round binary fractions such as 2.675."""
    p = float(10 ** digits)
    x = col(x)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def round_ratio(num_sql: str, den_sql: str, digits: int) -> Column:
    """Exact half-away-from-zero rounding of num/den for integers, as a
    double: sign(num den) * ((2 |num| 10^d + |den|) div 2 |den|) / 10^d, in
    decimal(38,0) arithmetic. This is how an exact decimal AVG of integers
    rounds; a double mean would round 2.675 down. Null when den is 0."""
    p = 10 ** digits
    n = f"cast(({num_sql}) as decimal(38,0))"
    d = f"cast(({den_sql}) as decimal(38,0))"
    return F.expr(
        f"case when ({den_sql}) <> 0 then signum({n}) * signum({d}) * "
        f"((2 * abs({n}) * {p} + abs({d})) div (2 * abs({d}))) / {float(p)} end"
    )
