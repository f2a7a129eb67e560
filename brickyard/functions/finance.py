"""Finance expressions (F1, F2, P18, P19, X11-X13, X17) as native Column expressions.

Amounts are integer cents and rates integer tenths of a percent, so every
branch that the reference rounds is an exact HALF_UP quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import half_up

TERM_YEARS = 25
RUNNING_COST_SHARE = 0.25  # fixed value: 25 % of rent goes to costs


def loan_cents(asking_pounds: Column, deposit_pct: Column) -> Column:
    """Loan = price · (1 − deposit/100), in cents."""
    return (asking_pounds * (100 - deposit_pct)).cast("long")


def monthly_payment(principal_cents: Column, rate_tenths: Column, mortgage_type: Column,
                    term_years: int = TERM_YEARS, rounded: bool = True) -> Column:
    """calculate_monthly_payment: 0 for no principal; interest-only P·r/100/12;
    repayment annuity P·r(1+r)^n/((1+r)^n−1) or P/n at 0 %; 2 dp when ``rounded``."""
    n = term_years * 12
    p = principal_cents.cast("double") / 100.0
    rate = rate_tenths.cast("double") / 10.0
    r = rate_tenths.cast("double") / 12000.0
    f = F.pow(1.0 + r, float(n))
    annuity = p * r * f / (f - 1.0)
    if rounded:
        io = half_up(principal_cents * rate_tenths, F.lit(1200000), 2)
        flat = half_up(principal_cents, F.lit(100 * n), 2)
        annuity = F.round(annuity, 2)
    else:
        io = F.round(p * rate / 100.0 / 12.0, 6)
        flat = F.round(p / float(n), 6)
        annuity = F.round(annuity, 6)
    return (F.when(principal_cents == 0, F.lit(0.0))
             .when(mortgage_type == "INTEREST_ONLY", io)
             .when(rate_tenths == 0, flat)
             .otherwise(annuity))


def gross_yield_pct(rent_cents: Column, asking_pounds: Column) -> Column:
    return half_up(rent_cents * 12, asking_pounds, 6)


def net_yield_pct(rent_cents: Column, asking_pounds: Column) -> Column:
    return half_up(rent_cents * 9, asking_pounds, 6)


def js_round(x: Column) -> Column:
    """JavaScript Math.round: floor(x + 0.5) (−2.5 → −2)."""
    return F.floor(x + 0.5).cast("long")
