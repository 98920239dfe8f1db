"""Tolerance checks in exact decimals; null means not comparable."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from navrecon.functions.finance import Name, as_col, expected_ending_value, net_flow, or_zero
from navrecon.schemas import CHECK, FLOW_TOLERANCE, RATE, TWRR_TOLERANCE, VALUE_TOLERANCE


def limit(value: Decimal) -> Column:
    return F.lit(value).cast(CHECK)


def gap(left: Name, right: Name) -> Column:
    """Absolute difference; null when either side is missing."""
    return F.abs(as_col(left).cast(CHECK) - as_col(right).cast(CHECK))


def twrr_variance(calculated: Name, vendor: Name) -> Column:
    return gap(calculated, vendor).try_cast(RATE)


def twrr_within(calculated: Name, vendor: Name, tolerance: Decimal = TWRR_TOLERANCE) -> Column:
    """True, false, or null when there is nothing to compare."""
    return gap(calculated, vendor) <= limit(tolerance)


def twrr_within_null_as_zero(
    calculated: Name, vendor: Name, tolerance: Decimal = TWRR_TOLERANCE
) -> Column:
    """Two-valued variant: a missing return is compared as zero."""
    return gap(or_zero(calculated), or_zero(vendor)) <= limit(tolerance)


def value_equation_gap(with_other: bool = True) -> Column:
    """Distance of the reported closing value from the one its parts imply."""
    return gap(
        "ending_market_value",
        expected_ending_value(
            "beginning_market_value", "net_flow", "income", "appreciation", "fees",
            "other_adjustments" if with_other else None,
        ),
    )


def value_equation_holds(with_other: bool = True, tolerance: Decimal = VALUE_TOLERANCE) -> Column:
    return value_equation_gap(with_other) <= limit(tolerance)


def _outcome(
    field: str, calculated: Column, vendor: Column, tolerance: Decimal, missing_note: str | None = None
) -> Column:
    variance = gap(calculated, vendor)
    note = F.when(variance.isNull(), F.lit(missing_note)).otherwise(F.lit("")) if missing_note else F.lit("")
    return F.struct(
        F.lit(field).alias("field_name"),
        calculated.cast(CHECK).alias("calculated_value"),
        vendor.cast(CHECK).alias("vendor_value"),
        variance.alias("variance"),
        limit(tolerance).alias("tolerance_threshold"),
        (variance <= limit(tolerance)).alias("within_tolerance"),
        note.alias("notes"),
    )


def value_outcome(tolerance: Decimal = VALUE_TOLERANCE) -> Column:
    """Market value check; every missing part counts as zero."""
    return _outcome(
        "ending_market_value",
        expected_ending_value(
            or_zero("beginning_market_value"), "net_flow", "income", "appreciation", "fees",
            "other_adjustments",
        ),
        or_zero("ending_market_value"),
        tolerance,
    )


def twrr_outcome(tolerance: Decimal = TWRR_TOLERANCE) -> Column:
    """Return check; a missing side gives no verdict and a note."""
    return _outcome("twrr", F.col("calculated_twrr"), F.col("vendor_twrr"), tolerance, "Missing TWRR values")


def flow_outcome(tolerance: Decimal = FLOW_TOLERANCE) -> Column:
    """Net flow check of the stored value against its two parts."""
    return _outcome("net_flow", net_flow("contributions", "distributions"), or_zero("net_flow"), tolerance)
