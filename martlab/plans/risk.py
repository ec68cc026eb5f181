"""Term credit risk formulas; every coefficient is an argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_column


def projected_dscr(dscr: str | Column, noi_original: str | Column, noi_projected: str | Column,
                   payment_original: str | Column, payment_projected: str | Column) -> Column:
    d, n0, n1, p0, p1 = map(as_column, (dscr, noi_original, noi_projected, payment_original, payment_projected))
    return F.try_divide(n1, n0) * F.try_divide(p0, p1) * d


def projected_ltv(ltv: str | Column, price_original: str | Column, price_projected: str | Column,
                  balance_original: str | Column, balance_projected: str | Column) -> Column:
    v, i0, i1, b0, b1 = map(as_column, (ltv, price_original, price_projected, balance_original, balance_projected))
    return F.try_divide(i0, i1) * F.try_divide(b1, b0) * v


def z_dscr(dscr: str | Column, sigma_noi: float | Column) -> Column:
    d = as_column(dscr)
    return F.try_divide(d - 1, d * sigma_noi)


def z_ltv(ltv: str | Column, sigma_value: float | Column) -> Column:
    return F.try_divide(1 - as_column(ltv), sigma_value if isinstance(sigma_value, Column) else F.lit(sigma_value))


def z_weighted(z_from_dscr: Column, z_from_ltv: Column, weight_noi: float | Column) -> Column:
    return z_from_dscr * weight_noi + z_from_ltv * (1 - weight_noi)


def term_cdr(z_from_dscr: Column, z_from_ltv: Column, other: Column, coefficients: Sequence[float]) -> Column:
    """Logistic conditional default rate with coefficients for the two distances and the other factors."""
    a1, a2, a3 = coefficients
    score = z_from_dscr * a1 + z_from_ltv * a2 + other * a3
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def multiplier_cdr(baseline: str | Column, multiplier: str | Column) -> Column:
    return as_column(baseline) * as_column(multiplier)


def survival_curve(df: DataFrame, loan: str, period: str, *, cpdr: str = "cpdr", cpr: str = "cpr", cdr: str = "cdr") -> DataFrame:
    """Survival at the end of every period and at its start, 1 before the first.

    The running product follows one loan, which has one row per period of its term.
    """
    kept = 1 - F.col(cpdr) - F.col(cpr) - F.col(cdr)
    order = Window.partitionBy(loan).orderBy(period)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns(
        {
            "survival": F.product(kept).over(so_far),
            "survival_before": F.coalesce(F.product(kept).over(before), F.lit(1.0)),
        }
    )


def expected_loss(curve: DataFrame, *, cdr: str = "cdr", lgd: str = "lgd") -> DataFrame:
    """Unconditional default probability and expected loss of every period."""
    return curve.withColumn("pd", F.col("survival_before") * F.col(cdr)).withColumn("el", F.col("pd") * F.col(lgd))


def total_risk(df: DataFrame) -> DataFrame:
    """Term plus refinance figures: total_pd, total_lgd, total_el."""
    return df.withColumns({f"total_{m}": F.col(f"term_{m}") + F.col(f"refi_{m}") for m in ("pd", "lgd", "el")})
