"""Flow and return formulas as Spark columns, and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from navrecon.schemas import MONEY, RATE

Name = Column | str


def as_col(value: Name) -> Column:
    return F.col(value) if isinstance(value, str) else value


def or_zero(value: Name) -> Column:
    """Null counts as zero; the column keeps its own numeric type."""
    return F.coalesce(as_col(value), F.lit(0))


def net_flow(contributions: Name, distributions: Name) -> Column:
    """Money in less money out, in exact decimals."""
    return (or_zero(contributions) - or_zero(distributions)).cast(MONEY)


def flow_adjusted_base(begin: Name, flow: Name) -> Column:
    """Opening value with half of the period's flow added (mid-period flow)."""
    return as_col(begin).cast("double") + or_zero(flow).cast("double") / F.lit(2)


def period_return(begin: Name, end: Name, flow: Name, strict: bool = False) -> Column:
    """Single-period time-weighted return, DECIMAL(12,8).

    Null unless the adjusted base is positive. strict=True is the database
    variant: the opening value itself must be positive and the base nonzero.
    A ratio that does not fit the type gives null, it does not stop the job.
    """
    base = flow_adjusted_base(begin, flow)
    usable = (as_col(begin) > 0) & (base != 0) if strict else base > 0
    ratio = F.when(usable, (as_col(end).cast("double") - base) / base)
    return ratio.try_cast(RATE)


def growth_factor(period: Name) -> Column:
    """1 + r as a double; a missing return leaves the balance unchanged."""
    return F.coalesce(as_col(period).cast("double"), F.lit(0.0)) + F.lit(1.0)


def annualize(period: Name, periods_per_year: int) -> Column:
    return F.pow(F.lit(1.0) + as_col(period).cast("double"), F.lit(periods_per_year)) - F.lit(1.0)


def expected_ending_value(
    begin: Name, flow: Name, income: Name, appreciation: Name, fees: Name, other: Name | None = None
) -> Column:
    """Closing value implied by its parts; `other` adjustments are optional."""
    total = as_col(begin) + or_zero(flow) + or_zero(income) + or_zero(appreciation) - or_zero(fees)
    return total if other is None else total + or_zero(other)


def register_sql_functions(spark: SparkSession) -> None:
    """The same two formulas for SQL users; Catalyst inlines them."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION
          calculate_net_flow(contributions DECIMAL(18,2), distributions DECIMAL(18,2))
        RETURNS DECIMAL(18,2)
        RETURN CAST(coalesce(contributions, 0) - coalesce(distributions, 0) AS DECIMAL(18,2))
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION
          calculate_twrr_single_period(begin_value DECIMAL(18,2), end_value DECIMAL(18,2), flow DECIMAL(18,2))
        RETURNS DECIMAL(12,8)
        RETURN CASE WHEN begin_value > 0 THEN
          try_cast(try_divide(
            CAST(end_value AS DOUBLE) - (CAST(begin_value AS DOUBLE) + CAST(coalesce(flow, 0) AS DOUBLE) / 2),
            CAST(begin_value AS DOUBLE) + CAST(coalesce(flow, 0) AS DOUBLE) / 2) AS DECIMAL(12,8)) END
    """)
