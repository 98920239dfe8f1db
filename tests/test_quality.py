import pytest
from navrecon.operators import quality
from navrecon.schemas import NUMERIC_FIELDS, STANDARD_FIELDS

GOOD = {
    **{name: "10.00" for name in NUMERIC_FIELDS}, "account_id": "A", "account_name": "n", "portfolio_id": "P",
    "as_of_date": "2024-01-31", "vendor_twrr": "0.01", "benchmark_return": "0.01",
}


@pytest.fixture
def raw(spark):
    def build(*changes):
        schema = ", ".join(f"{n} string" for n in STANDARD_FIELDS) + ", created_at timestamp_ntz"
        return spark.createDataFrame(
            [tuple({**GOOD, **c}.get(n) for n in STANDARD_FIELDS) + (None,) for c in changes], schema)
    return build


MUTATIONS = [
    ({"account_id": ""}, "missing_account_id"), ({"account_id": None}, "missing_account_id"),
    ({"beginning_market_value": "-1"}, "negative_beginning_market_value"),
    ({"ending_market_value": "-1000.00"}, "negative_ending_market_value"),
    ({"vendor_twrr": "1.5"}, "unrealistic_twrr"), ({"vendor_twrr": "-1.01"}, "unrealistic_twrr"),
    ({"contributions": None}, "null_contributions"), ({"distributions": None}, "null_distributions"),
    ({"as_of_date": "31.01.2024"}, "invalid_date_format"),
    *[({name: "invalid"}, f"invalid_{name}_type") for name in NUMERIC_FIELDS],
]


def test_a_clean_row_has_no_issue(raw):
    assert quality.issues(raw({})).count() == 0


@pytest.mark.parametrize("change, kind", MUTATIONS)
def test_one_broken_cell_gives_one_issue(raw, change, kind):
    found = quality.issues(raw({}, change)).collect()
    assert [r.issue_type for r in found] == [kind]
    assert found[0].actual_value == next(iter(change.values()))


def test_split_is_complete(raw):
    routed = quality.route_rows(raw({}, *[c for c, _ in MUTATIONS]))
    counts = {r.destination: r["count"] for r in routed.groupBy("destination").count().collect()}
    assert counts == {"valid": 1, "quarantine": len(MUTATIONS)}


def test_missing_counts_and_required(perf):
    full = {"beginning_market_value": 1, "ending_market_value": 1}
    df = perf(full, full, {"ending_market_value": 1}, full)
    got = {r.field_name: r.missing_count for r in quality.missing_counts(df).collect()}
    assert got == {"account_id": 0, "as_of_date": 0, "beginning_market_value": 1, "ending_market_value": 0}
    assert tuple(quality.valid_counts(df).first()) == (4, 3)


def test_absolute_bound(perf):
    df = perf(*[{"calculated_twrr": v} for v in ("0.01", "0.02", "0.015", "0.012", "0.5", "0.018", "0.022")])
    assert [float(r.calculated_twrr) for r in quality.beyond_bound(df, 0.1).collect()] == [0.5]


def test_profile_modes_agree(perf):
    df = perf({"income": 1}, {"income": 1}, {"income": 3}, {"income": None, "account_id": "B"})
    exact = {r.column_name: r for r in quality.profile(df, ["income", "account_id"]).collect()}
    rough = {r.column_name: r for r in quality.profile(df, ["income", "account_id"], approximate=True).collect()}
    assert exact == rough
    assert exact["income"][1:] == ("decimal", 4, 0.25, 2, "1.00000000", "3.00000000", 1.6667)
    assert exact["account_id"].distinct_values == 2
