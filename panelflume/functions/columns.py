"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from panelflume import fixed_values as fv


def clip(c: Column, low: float, high: float) -> Column:
    """Clamp to [low, high], keeping NULL (greatest/least alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def cyclic_sin(c: Column, period: int) -> Column:
    return F.sin(F.lit(2 * math.pi) * c / F.lit(period))


def cyclic_cos(c: Column, period: int) -> Column:
    return F.cos(F.lit(2 * math.pi) * c / F.lit(period))


def growth(c: Column, base: Column) -> Column:
    """Relative change against base+1, so that a zero base is defined."""
    return c / (base + F.lit(1)) - F.lit(1)


def half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def whole(c: Column) -> Column:
    """Cut the fraction off, toward zero."""
    return c.cast("long")


def half_up_integer(c: Column) -> Column:
    """Nearest integer, halves toward plus infinity."""
    return F.floor(c + F.lit(0.5)).cast("long")


def or_default(c: Column, default) -> Column:
    """NULL and zero both count as missing."""
    return F.coalesce(F.nullif(c, F.lit(0).cast("double")), F.lit(default).cast("double"))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def unit_root_p(tau: Column) -> Column:
    """Piecewise-linear p-value of a unit-root statistic, from the segment table."""
    p = F.when(tau <= F.lit(fv.UNIT_ROOT_SEGMENTS[0][0]), F.lit(fv.UNIT_ROOT_P_LOW))
    for left, right, p_left, p_right in fv.UNIT_ROOT_SEGMENTS:
        slope = (tau - F.lit(left)) / F.lit(right - left)
        p = p.when(tau <= F.lit(right), F.lit(p_left) + slope * F.lit(p_right - p_left))
    return F.when(tau.isNotNull(), clip(p.otherwise(F.lit(fv.UNIT_ROOT_P_HIGH)), 0.001, 0.999))


def trend_index(date: Column, start: str, growth_pa: Column) -> Column:
    """Compound growth since start, in years of 365.25 days."""
    years = F.datediff(date, F.lit(start).cast("date")) / F.lit(365.25)
    return F.pow(F.lit(1.0) + growth_pa, years)


def seasonal_index(week: Column, harmonics=None, period: int = fv.SEASON_WEEKS) -> Column:
    """One plus the sum of sine and cosine harmonics of the week of year."""
    total = F.lit(1.0)
    for k, sin_amp, cos_amp in harmonics or fv.SEASONAL_HARMONICS:
        angle = F.lit(2 * math.pi * k) * week / F.lit(period)
        total = total + F.lit(sin_amp) * F.sin(angle) + F.lit(cos_amp) * F.cos(angle)
    return total


def expected_demand(base: Column, trend: Column, seasonal: Column, school: Column, public: Column, event: Column,
                    shock: Column, rate: Column, fuel: Column, business_mix: Column) -> Column:
    """Deterministic demand level of an entity on a date."""
    school_effect = F.lit(1.0) + school * F.lit(fv.SCHOOL_EFFECT) * (F.lit(1.0) - business_mix)
    public_effect = F.lit(1.0) + public * F.lit(fv.PUBLIC_HOLIDAY_EFFECT)
    rate_effect = F.lit(1.0) - (rate - F.lit(fv.NEUTRAL_RATE)) * business_mix * F.lit(fv.RATE_EFFECT)
    fuel_effect = F.lit(1.0) - _fuel_excess(fuel) * F.lit(fv.FUEL_DEMAND_EFFECT)
    return base * trend * seasonal * school_effect * public_effect * event * shock * rate_effect * fuel_effect


def expected_yield(avg_yield: Column, cpi_index: Column, pax: Column, base: Column, trend: Column, seasonal: Column,
                   fuel: Column, competition: Column) -> Column:
    """Deterministic average fare, with its floor and two decimals."""
    pressure = pax / (base * trend * seasonal + F.lit(1.0)) - F.lit(1.0)
    value = (avg_yield * cpi_index * (F.lit(1.0) + pressure * F.lit(fv.LOAD_YIELD_EFFECT))
             * (F.lit(1.0) + _fuel_excess(fuel) * F.lit(fv.FUEL_YIELD_EFFECT))
             * (F.lit(1.0) - competition * F.lit(fv.COMPETITION_YIELD_EFFECT)))
    return F.greatest(F.lit(fv.MIN_YIELD), half_even(value, 2))


def expected_load_factor(avg_load_factor: Column, shock: Column) -> Column:
    return clip(clip(avg_load_factor, *fv.LOAD_FACTOR_BOUNDS) * shock, *fv.SHOCKED_LOAD_FACTOR_BOUNDS)


def _fuel_excess(fuel: Column) -> Column:
    return F.greatest(F.lit(0.0), (fuel - F.lit(100.0)) / F.lit(100.0))
