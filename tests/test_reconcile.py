import datetime as dt
from decimal import Decimal

import pytest
from navrecon.operators import reconcile
from navrecon.operators.running import cumulative_metrics
from navrecon.plans import flows
from pyspark.sql import functions as F

BALANCED = {"beginning_market_value": 100000, "contributions": 5000, "distributions": 2000, "net_flow": 3000,
            "income": 1200, "appreciation": 800, "fees": 300, "other_adjustments": 300,
            "ending_market_value": 105000, "calculated_twrr": "0.0234", "vendor_twrr": "0.0235"}


def outcome(perf, **change):
    rows = reconcile.check_rows(perf({**BALANCED, **change})).collect()
    return {r.field_name: r for r in rows}


def test_a_balanced_row_passes_all_checks(perf):
    got = outcome(perf)
    assert {k: v.within_tolerance for k, v in got.items()} == {
        "ending_market_value": True, "twrr": True, "net_flow": True}
    assert got["twrr"].variance == Decimal("0.00010000") and got["twrr"].notes == ""


def test_each_check_fails_alone(perf):
    assert outcome(perf, ending_market_value="105000.02")["ending_market_value"].within_tolerance is False
    assert outcome(perf, ending_market_value="105000.01")["ending_market_value"].within_tolerance is True
    assert outcome(perf, vendor_twrr="0.0244")["twrr"].within_tolerance is False
    off = outcome(perf, net_flow="3000.02", ending_market_value="105000.02")
    assert (off["net_flow"].within_tolerance, off["ending_market_value"].within_tolerance) == (False, True)


def test_missing_values(perf):
    row = outcome(perf, vendor_twrr=None)["twrr"]
    assert (row.within_tolerance, row.variance, row.notes) == (None, None, "Missing TWRR values")
    assert outcome(perf, other_adjustments=None, ending_market_value=104700)["ending_market_value"].within_tolerance


def test_report_counts_a_missing_verdict_as_failed(perf):
    checks = reconcile.check_rows(perf(BALANCED, {**BALANCED, "vendor_twrr": None}, {**BALANCED, "fees": 999}))
    row = reconcile.report_totals(checks).first()
    assert (row.total_checks, row.passed_checks, row.failed_checks, row.not_comparable) == (9, 7, 2, 1)
    assert row.pass_rate_percentage == 77.78
    assert reconcile.failures(checks).count() == 2


def owned(perf, values, portfolio="P", **more):
    return perf(*[{"portfolio_id": portfolio, "account_id": f"A{i}", "calculated_twrr": v, **more}
                  for i, v in enumerate(values)])


VALUES = ["0.01", "0.02", "0.015", "0.012", "2.0", "0.018", "0.022"]


def test_outliers_by_sigma(perf):
    rows = owned(perf, VALUES)
    population = reconcile.outliers(rows, reconcile.portfolio_stats(rows, ddof=0), sigmas=2).collect()
    assert [float(r.calculated_twrr) for r in population] == [2.0]
    assert reconcile.outliers(rows, reconcile.portfolio_stats(rows)).count() == 0


def test_many_normal_rows_and_one_far_row(perf):
    rows = owned(perf, ["0.01"] * 20 + ["5"])
    far = reconcile.outliers(rows, reconcile.portfolio_stats(rows))
    assert [r.account_id for r in far.collect()] == ["A20"]
    summary = reconcile.outlier_summary(far).first()
    assert (summary.outlier_rows, summary.severity) == (1, "WARNING")


def test_broadcast_and_shuffle_paths_agree(perf, monkeypatch):
    rows = owned(perf, ["0.01"] * 20 + ["5"])
    quick = reconcile.outliers(rows, reconcile.portfolio_stats(rows)).collect()
    from navrecon import session
    monkeypatch.setattr(reconcile, "broadcast_if_small", lambda df: session.broadcast_if_small(df, max_rows=0))
    assert reconcile.outliers(rows, reconcile.portfolio_stats(rows)).collect() == quick


def test_portfolio_dates(perf):
    same = owned(perf, ["0.01", "0.02"])
    other = owned(perf, ["0.01"], as_of_date=dt.date(2024, 2, 29))
    assert reconcile.portfolio_dates(reconcile.portfolio_stats(same)).count() == 0
    row = reconcile.portfolio_dates(reconcile.portfolio_stats(same.unionByName(other))).first()
    assert (row.unique_dates, row.total_accounts, row.severity) == (2, 2, "WARNING")


def test_report_flow_and_recommendations(perf):
    good = owned(perf, ["0.0234"], **{k: v for k, v in BALANCED.items() if k != "calculated_twrr"})
    report = flows.reconcile_files(good)
    assert (report.first().overall_status, report.first().reconciliation_status) == ("PASS", "COMPLETED")
    assert [r.recommendation for r in reconcile.recommendations(report).collect()] == [
        "All reconciliation checks passed. Data quality is acceptable."]
    bad = good.withColumn("fees", F.lit(Decimal("1000.00")))
    report = flows.reconcile_files(bad)
    assert (report.first().overall_status, report.first().reconciliation_status) == ("FAIL", "COMPLETED_WITH_ISSUES")
    assert reconcile.recommendations(report).count() == 2
    assert reconcile.rate_gate(report).first().gate_status == "COMPLETED_WITH_ISSUES"


def test_counts_equal_the_long_form(perf):
    rows = perf(BALANCED, {**BALANCED, "vendor_twrr": None}, {**BALANCED, "fees": 999, "file_name": "g.csv"})
    by = ["data_source", "file_name"]
    fast = reconcile.totals_from_counts(reconcile.with_verdicts(rows).groupBy(*by).agg(*reconcile.check_counts()))
    slow = reconcile.report_totals(reconcile.check_rows(rows))
    assert sorted(fast.collect()) == sorted(slow.select(*fast.columns).collect())


def test_unknown_accounts_stay_in_the_totals(spark, perf):
    accounts = spark.createDataFrame([("A0", "P")], "account_id string, portfolio_id string")
    rows = perf({**BALANCED, "account_id": "A0"}, {**BALANCED, "account_id": "lost"}).drop("portfolio_id")
    owned = reconcile.with_portfolio(rows, accounts)
    assert flows.reconcile_files(owned).first().total_checks == 6


def test_check_matrix(perf):
    rows = perf({**BALANCED, "account_id": "A"}, {**BALANCED, "account_id": "B", "fees": 1},
                {**BALANCED, "account_id": "C", "vendor_twrr": "0.5"})
    matrix = reconcile.check_matrix(reconcile.check_rows(rows))
    assert {r.account_id: r.passed_checks for r in matrix.collect()} == {"A": 3, "B": 2, "C": 2}
    total = reconcile.matrix_rate(matrix).first()
    assert (total.total_checks, total.passed_checks, total.pass_rate) == (9, 7, 77.78)


@pytest.mark.parametrize("flags, rate, status", [([True, False, False], 33.33, "FAIL"), ([True] * 3, 100.0, "PASS")])
def test_account_pass_rate(perf, flags, rate, status):
    row = reconcile.account_pass_rate(perf(*[{"twrr_tolerance_check": f} for f in flags])).first()
    assert (row.pass_rate, row.status) == (rate, status)


def test_recompute_finds_a_slip_and_its_running_effect(perf):
    base = {k: v for k, v in BALANCED.items() if k not in ("calculated_twrr", "vendor_twrr")}
    rows = flows.derive(perf(*[{**base, "as_of_date": dt.date(2024, 1, d)} for d in range(1, 6)]), strict=False)
    whole = cumulative_metrics(rows)
    found = lambda df: tuple(flows.recompute_check(df).first())[2:]
    assert found(whole) == (5, 0, 0, 0, 0)
    slipped = rows.withColumn("net_flow", F.when(F.col("period_id") == 2, F.col("net_flow") + 5).otherwise(F.col("net_flow")))
    assert found(cumulative_metrics(slipped)) == (5, 1, 0, 3, 0)
    # What is stored is what is compared: a wrong or missing running value is found, whatever its parts are.
    third = F.col("period_id") == 3
    for name, place in (("cumulative_net_flow", 3), ("cumulative_twrr", 4)):
        for value in (F.col(name) + 1, F.lit(None)):
            wrong = whole.withColumn(name, F.when(third, value).otherwise(F.col(name)))
            assert found(wrong) == tuple([5] + [int(k == place) for k in range(1, 5)])


def test_gate_takes_the_worst_branch(spark):
    key = "data_source string, file_name string, "
    reports = spark.createDataFrame(
        [("v", "clean", "PASS", 0, 0), ("v", "warn", "PASS", 0, 1), ("v", "bad", "FAIL", 0, 0)],
        key + "overall_status string, error_count long, warning_count long")
    recomputed = spark.createDataFrame(
        [("v", name, 0, 0, 0, 0) for name in ("clean", "warn", "bad")],
        key + "net_flow_mismatches long, twrr_mismatches long, cumulative_flow_mismatches long, cumulative_twrr_mismatches long")
    issues = spark.createDataFrame([("v", "bad", "HIGH"), ("v", "bad", "LOW")], key + "severity string")
    got = {r.file_name: (r.overall_status, r.database_status) for r in flows.file_gate(issues, reports, recomputed).collect()}
    assert got == {"clean": ("SUCCESS", "COMPLETED"), "warn": ("WARNING", "COMPLETED_WITH_WARNINGS"),
                   "bad": ("FAILED", "FAILED")}


@pytest.mark.parametrize("passed, advised", [(94_996, True), (95_000, False), (95_004, False)])
def test_rates_are_compared_unrounded(spark, passed, advised):
    """94.996 percent shows as 95.00 and is still below the limit."""
    row = spark.createDataFrame([("v", "f", 100_000, passed, 0, 0, 0, 95.0)], (
        "data_source string, file_name string, total_checks long, passed_checks long, failed_checks long, "
        "error_count long, warning_count long, pass_rate_percentage double"))
    texts = [r.recommendation for r in reconcile.recommendations(row).collect()]
    assert any(t.startswith("Low pass rate") for t in texts) is advised
    assert (reconcile.rate_gate(row).first().gate_status == "COMPLETED") is (passed > 95_000)
