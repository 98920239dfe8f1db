from decimal import Decimal

import pytest
from navrecon.functions import checks, finance, text
from navrecon.schemas import CHECK
from pyspark.sql import functions as F


def dec(value):
    return Decimal(value)


def test_net_flow(one):
    assert one(finance.net_flow("c", "d"), c=dec("5000"), d=dec("2000")) == dec("3000.00")
    assert one(finance.net_flow(F.lit(None).cast("decimal(18,2)"), "d"), d=dec("2")) == dec("-2.00")


@pytest.mark.parametrize("begin, end, flow, expected", [
    ("100000", "105000", "3000", "0.03448276"),
    ("200000", "198000", "-5000", "0.00253165"),
    ("100", "50", "-200", None),
    ("100", "50", "-300", None),
])
def test_period_return(one, begin, end, flow, expected):
    got = one(finance.period_return("b", "e", "f"), b=dec(begin), e=dec(end), f=dec(flow))
    assert got == (dec(expected) if expected else None)


def test_strict_return_guards_the_opening_value(one):
    inputs = {"b": dec("-100"), "e": dec("50"), "f": dec("400")}
    assert one(finance.period_return("b", "e", "f"), **inputs) == dec("-0.50000000")
    assert one(finance.period_return("b", "e", "f", strict=True), **inputs) is None
    assert one(finance.period_return("b", "e", "f", strict=True), b=dec("100"), e=dec("5"), f=dec("-200")) is None
    assert one(finance.period_return("b", "e", "f", strict=True), b=dec("100"), e=dec("5"), f=dec("-400")) == dec("-1.05")


def test_return_too_large_for_its_type_is_null(one):
    assert one(finance.period_return("b", "e", "f"), b=dec("0.01"), e=dec("999999999"), f=dec("0")) is None


def test_annualize(one):
    assert one(finance.annualize("r", 4), r=dec("0.02")) == pytest.approx(0.08243216)


def test_expected_ending_value(one):
    parts = {"b": dec("100000"), "f": dec("3000"), "i": dec("1200"), "a": dec("800"), "x": dec("300"), "o": dec("300")}
    assert one(finance.expected_ending_value("b", "f", "i", "a", "x", "o"), **parts) == dec("105000")
    assert one(finance.expected_ending_value("b", "f", "i", "a", "x"), **parts) == dec("104700")


@pytest.mark.parametrize("ours, theirs, ok", [
    ("0.0234", "0.0235", True), ("0.0234", "0.0244", False), ("0.0101", "0.0102", True),
])
def test_tolerance_is_exact_at_the_edge(one, ours, theirs, ok):
    assert one(checks.twrr_within("a", "b"), a=dec(ours), b=dec(theirs)) is ok


def test_tolerance_with_a_missing_side(one):
    missing = F.lit(None).cast("decimal(12,8)")
    assert one(checks.twrr_within(missing, "b"), b=dec("0.5")) is None
    assert one(checks.twrr_within_null_as_zero(missing, "b"), b=dec("0.5")) is False
    assert one(checks.twrr_within_null_as_zero(missing, "b"), b=dec("0.0001")) is True


def test_check_values_hold_large_money(one):
    assert one(checks.gap("a", "b"), a=dec("9999999999999999.99"), b=dec("0.01")) == dec("9999999999999999.98")
    assert CHECK.precision - CHECK.scale >= 16


def test_sql_functions_agree(spark):
    finance.register_sql_functions(spark)
    row = spark.sql("""SELECT calculate_net_flow(5000, NULL) AS nf,
        calculate_twrr_single_period(100000, 105000, 3000) AS r, calculate_twrr_single_period(0, 1, 1) AS none""").first()
    assert (row.nf, row.r, row.none) == (dec("5000.00"), dec("0.03448276"), None)


def test_display(one):
    assert one(text.currency("x"), x=dec("123456.789")) == "$123,456.79"
    assert one(text.percent("x"), x=dec("0.0234")) == "2.34%"
    assert one(text.basis_points("x"), x=dec("0.0234")) == "234.0 bps"
    assert one(text.field_label("x"), x="net_flow") == "NET FLOW"
    assert [one(text.rate_tier("x"), x=v) for v in (98.0, 97.9, 94.9)] == ["green", "amber", "red"]


@pytest.mark.parametrize("given, expected", [
    ("2024-01-31", "2024-01-31"), ("01/31/2024", "2024-01-31"), ("31/01/2024", "2024-01-31"),
    ("2024/01/31", "2024-01-31"), ("03/04/2024", "2024-03-04"), ("nonsense", "None"), ("2024-13-01", "None"),
])
def test_dates_in_listed_order(one, given, expected):
    assert str(one(text.parse_date("x"), x=given)) == expected


def test_search(one):
    assert one(text.contains_text("x", "endor a"), x="Vendor A") is True
    assert one(text.contains_text("x", ""), x="Vendor A") is True
    assert one(text.contains_text("x", "%"), x="Vendor A") is False
    assert one(text.ilike_text("x", "cc0"), x="ACC001") is True
