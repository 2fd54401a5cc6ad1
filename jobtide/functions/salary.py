"""Pay-period repair and annual salary estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pay periods per year, and the band an annual estimate must lie in.
PERIODS_PER_YEAR = {"HOURLY": 2080, "WEEKLY": 52, "BIWEEKLY": 26, "MONTHLY": 12, "YEARLY": 1}
LOWEST_ANNUAL = 15000
HIGHEST_ANNUAL = 1000000


def correct_period(observed: Column, period: Column) -> Column:
    """Pay period implied by the size of the amount; the stated one decides only where it is plausible.

    The bands are half-open from above, so each amount falls in exactly one of them.
    """

    def keep(plausible: Column, otherwise: str) -> Column:
        return F.when(plausible, period).otherwise(F.lit(otherwise))

    yearly_or_monthly = keep((period == "MONTHLY") & (observed <= 50000), "YEARLY")
    monthly_or_shorter = keep(period.isin("MONTHLY", "BIWEEKLY", "WEEKLY"), "MONTHLY")
    weekly_or_longer = keep(
        period.isin("BIWEEKLY", "WEEKLY") | ((period == "MONTHLY") & (observed >= 2500)), "WEEKLY"
    )
    hourly_or_weekly = keep((period == "WEEKLY") & (observed >= 200), "HOURLY")
    return (
        F.when(observed >= 250000, F.lit("YEARLY"))
        .when(observed >= 15000, yearly_or_monthly)
        .when(observed >= 4000, monthly_or_shorter)
        .when(observed >= 1000, weekly_or_longer)
        .when(observed < 1000, hourly_or_weekly)
        .otherwise(period)
    )


def per_year(period: Column) -> Column:
    """How many pay periods a year holds; NULL for an unknown period."""
    factors = F.create_map(*[F.lit(x) for pair in PERIODS_PER_YEAR.items() for x in pair])
    return F.try_element_at(factors, period)


def annualise(amount: Column, period: Column) -> Column:
    return amount * per_year(period)


def best_estimate(low: Column, mid: Column, high: Column, period: Column) -> Column:
    """Best single annual figure: the middle amount, else the mean of low and high, else the one there is.

    All three cases are the mean of two amounts (equal ones where only one counts), which keeps
    the period out of four separate branches and the generated code small.
    """
    first, second = F.coalesce(mid, low, high), F.coalesce(mid, high, low)
    return (annualise(first, period) + annualise(second, period)) / 2.0


def in_dollars(currency: Column) -> Column:
    return F.upper(currency) == "USD"


def credible(annual: Column) -> Column:
    return annual.between(LOWEST_ANNUAL, HIGHEST_ANNUAL)


def salary_estimate(low: Column, mid: Column, high: Column, period: Column, currency: Column) -> Column:
    """Annual dollar estimate, NULL outside the credible band or in other currencies."""
    best = best_estimate(low, mid, high, period)
    return F.when(credible(best) & in_dollars(currency), best)
