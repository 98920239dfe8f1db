"""Reconciliation: three checks per row, cross-account checks, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navrecon.functions.checks import flow_outcome, twrr_outcome, value_outcome
from navrecon.schemas import COMPLETED, RATE, WITH_ISSUES
from navrecon.session import broadcast_if_small

FILE_KEY = ("data_source", "file_name")


def check_rows(performance: DataFrame, outcomes: list[Column] | None = None) -> DataFrame:
    """One row per (performance row, check). No shuffle: a narrow explode."""
    outcomes = outcomes or [value_outcome(), twrr_outcome(), flow_outcome()]
    lineage = ["account_id", "as_of_date", "data_source", "file_name"]
    return performance.select(
        *lineage, F.col("created_at").alias("reconciliation_date"),
        F.explode(F.array(*outcomes)).alias("_check"),
    ).select(*lineage, "reconciliation_date", "_check.*")


def results(performance: DataFrame) -> DataFrame:
    """The stored result table; file lineage is found again by the join on its key."""
    return check_rows(performance).drop("data_source", "file_name")


def pass_rate(passed: Column, total: Column) -> Column:
    """Percentage to two places; null when nothing was counted."""
    return F.round(F.try_divide(passed * F.lit(100.0), total), 2)


VERDICTS = ("_value_ok", "_twrr_ok", "_flow_ok")


def with_verdicts(performance: DataFrame) -> DataFrame:
    """The three verdicts as columns of the row, for counting without a long form."""
    outcomes = (value_outcome(), twrr_outcome(), flow_outcome())
    return performance.select("*", *[o["within_tolerance"].alias(n) for n, o in zip(VERDICTS, outcomes)])


def check_counts() -> tuple[Column, ...]:
    """Check counts as aggregates over rows with verdicts."""
    def total(wanted: Callable[[Column], Column]) -> Column:
        return sum((F.count_if(wanted(F.col(n))) for n in VERDICTS), F.lit(0))

    return (
        (F.count("*") * len(VERDICTS)).alias("total_checks"),
        total(lambda v: v).alias("passed_checks"),
        total(lambda v: v.isNull()).alias("not_comparable"),
    )


def totals_from_counts(counted: DataFrame, by: tuple[str, ...] = FILE_KEY) -> DataFrame:
    """Fold finer counts into the totals of a file."""
    names = ["total_checks", "passed_checks", "not_comparable"]
    return _with_rate(counted.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names]))


def _with_rate(totals: DataFrame) -> DataFrame:
    failed = F.col("total_checks") - F.col("passed_checks")
    return totals.withColumn("failed_checks", failed).withColumn(
        "pass_rate_percentage", pass_rate(F.col("passed_checks"), F.col("total_checks")))


def report_totals(checks: DataFrame, by: tuple[str, ...] = FILE_KEY) -> DataFrame:
    """Check totals per group. A check without verdict counts as failed here and
    is also shown apart as not_comparable."""
    ok = F.coalesce(F.col("within_tolerance"), F.lit(False))
    return _with_rate(checks.groupBy(*by).agg(
        F.count("*").alias("total_checks"),
        F.count_if(ok).alias("passed_checks"),
        F.count_if(F.col("within_tolerance").isNull()).alias("not_comparable"),
    ))


def failures(checks: DataFrame) -> DataFrame:
    """Every check that did not pass, with its field: the long form of failures by field."""
    return checks.where(~F.coalesce(F.col("within_tolerance"), F.lit(False)))


def with_portfolio(performance: DataFrame, accounts: DataFrame) -> DataFrame:
    """Attach portfolio_id, null for an unknown account. No broadcast hint: accounts
    grow with the data, so the measured size decides, and a hot account is split
    by the skew join."""
    return performance.join(accounts.select("account_id", "portfolio_id"), "account_id", "left")


PORTFOLIO = (*FILE_KEY, "portfolio_id")


def portfolio_stats(
    rows: DataFrame, ddof: int = 1, by: tuple[str, ...] = PORTFOLIO,
    value: str = "calculated_twrr", extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Dates, accounts, mean and deviation per portfolio: one row per group,
    folded before the shuffle, so a portfolio with a third of all rows costs no
    task more than its share. Kept for broadcast once its size is measured.
    `extra` aggregates ride along in the same pass."""
    # Sums of decimals are exact, so the result does not depend on how the rows are dealt.
    x = F.col(value).cast(RATE)
    n, total, squares = F.count(x), F.sum(x).cast("double"), F.sum(x * x).cast("double")
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return broadcast_if_small(rows.groupBy(*by).agg(
        F.count_distinct("as_of_date").alias("unique_dates"),
        F.count_distinct("account_id").alias("total_accounts"),
        F.try_divide(total, n).alias("mean_twrr"),
        F.when(n > ddof, F.sqrt(spread / (n - ddof))).alias("std_twrr"),
        n.alias("known_returns"),
        *extra,
    ))


def portfolio_dates(stats: DataFrame, by: tuple[str, ...] = PORTFOLIO) -> DataFrame:
    """Portfolios of a file whose accounts report on more than one date."""
    return stats.where((F.col("unique_dates") > 1) & F.col("portfolio_id").isNotNull()).select(
        *by, F.lit("portfolio_date_consistency").alias("validation_type"),
        "unique_dates", "total_accounts", F.lit("WARNING").alias("severity"),
    )


def outliers(
    rows: DataFrame, stats: DataFrame, sigmas: float = 3,
    by: tuple[str, ...] = PORTFOLIO, value: str = "calculated_twrr",
) -> DataFrame:
    """Rows further than `sigmas` standard deviations from their group's mean, in
    groups with more than one known return. No window over a group is needed."""
    known = stats.where("known_returns > 1").select(*by, "mean_twrr", "std_twrr")
    distance = F.abs(F.col(value).cast("double") - F.col("mean_twrr"))
    return (
        rows.join(known, list(by))
        .where(distance > F.lit(float(sigmas)) * F.col("std_twrr"))
        .withColumn("severity", F.lit("WARNING"))
    )


def outlier_summary(found: DataFrame, by: tuple[str, ...] = PORTFOLIO) -> DataFrame:
    """One validation per portfolio with outliers; the accounts stay in long form."""
    return found.groupBy(*by).agg(
        F.count("*").alias("outlier_rows"),
        F.first("mean_twrr").alias("mean_twrr"),
        F.first("std_twrr").alias("std_twrr"),
        F.lit("twrr_outlier_detection").alias("validation_type"),
        F.lit("WARNING").alias("severity"),
    )


def cross_validations(rows: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Both portfolio checks in one table: one row per finding."""
    stats = portfolio_stats(rows) if stats is None else stats
    common = [*PORTFOLIO, "validation_type", "severity"]
    return portfolio_dates(stats).select(*common).unionByName(
        outlier_summary(outliers(rows, stats)).select(*common)
    )


def severity_counts(validations: DataFrame, by: tuple[str, ...] = FILE_KEY) -> DataFrame:
    return validations.groupBy(*by, "severity").agg(F.count("*").alias("issue_count"))


def report(totals: DataFrame, validations: DataFrame, by: tuple[str, ...] = FILE_KEY) -> DataFrame:
    """Report row per file: totals, warnings, errors, verdict and stored status."""
    found = validations.groupBy(*by).agg(
        F.count_if(F.col("severity") == "WARNING").alias("warning_count"),
        F.count_if(F.col("severity") == "ERROR").alias("error_count"),
    )
    passed = (F.col("failed_checks") == 0) & (F.col("error_count") == 0)
    return (
        totals.join(found, list(by), "left")
        .na.fill(0, ["warning_count", "error_count"])
        .withColumn("overall_status", F.when(passed, "PASS").otherwise("FAIL"))
        .withColumn("reconciliation_status", F.when(passed, COMPLETED).otherwise(WITH_ISSUES))
    )


def exceeds(part: Column, whole: Column, percent: float) -> Column:
    """part / whole > percent / 100, compared without rounding."""
    return part * F.lit(100.0) > F.lit(float(percent)) * whole


def below(part: Column, whole: Column, percent: float) -> Column:
    return part * F.lit(100.0) < F.lit(float(percent)) * whole


def rate_gate(totals: DataFrame, threshold: float = 95) -> DataFrame:
    """The documented alternative verdict: a pass rate above a threshold completes."""
    return totals.withColumn(
        "gate_status",
        F.when(exceeds(F.col("passed_checks"), F.col("total_checks"), threshold), COMPLETED).otherwise(WITH_ISSUES),
    )


def recommendations(reports: DataFrame, by: tuple[str, ...] = FILE_KEY) -> DataFrame:
    """Advice per report, one row per applicable sentence."""
    failed = F.concat(
        F.col("failed_checks").cast("string"),
        F.lit(" reconciliation checks failed. Investigate tolerance thresholds and data accuracy."),
    )
    # The wording of the report.
    advice = F.array_compact(F.array(
        F.when(below(F.col("passed_checks"), F.col("total_checks"), 95),
               "Low pass rate detected. Review calculation logic and data quality."),
        F.when(F.col("failed_checks") > 0, failed),
        F.when(F.col("error_count") > 0,
               "Critical validation errors detected. Manual review required."),
        F.when(F.col("warning_count") > 0,
               "Data quality warnings detected. Consider additional validation rules."),
    ))
    nothing = F.array(F.lit("All reconciliation checks passed. Data quality is acceptable."))
    return reports.select(
        *by, F.posexplode(F.when(F.size(advice) > 0, advice).otherwise(nothing)).alias("position", "recommendation")
    )


def check_matrix(checks: DataFrame, by: tuple[str, ...] = ("account_id",)) -> DataFrame:
    """Per account: did every check of each kind pass, and the rate over the three."""
    def all_pass(field: str) -> Column:
        return F.bool_and(F.when(F.col("field_name") == field, F.coalesce(F.col("within_tolerance"), F.lit(False))))

    flags = {"twrr_check": "twrr", "mv_check": "ending_market_value", "netflow_check": "net_flow"}
    matrix = checks.groupBy(*by).agg(*[all_pass(field).alias(name) for name, field in flags.items()])
    passed = sum((F.coalesce(F.col(name), F.lit(False)).cast("int") for name in flags), F.lit(0))
    return matrix.withColumn("passed_checks", passed.cast("long"))


def matrix_rate(matrix: DataFrame) -> DataFrame:
    return matrix.agg(
        F.count("*").alias("total_accounts"),
        (F.count("*") * 3).alias("total_checks"),
        F.sum("passed_checks").alias("passed_checks"),
        pass_rate(F.sum("passed_checks"), F.count("*") * 3).alias("pass_rate"),
    )


def account_pass_rate(performance: DataFrame, by: tuple[str, ...] = FILE_KEY, threshold: float = 95) -> DataFrame:
    """Share of rows whose return flag passed, with a verdict at the threshold."""
    rate = F.try_divide(F.count_if("twrr_tolerance_check") * F.lit(100.0), F.count("*"))
    return performance.groupBy(*by).agg(
        F.count("*").alias("total_accounts"),
        F.count_if("twrr_tolerance_check").alias("passed_tolerance"),
        (F.count("*") - F.count_if("twrr_tolerance_check")).alias("failed_tolerance"),
        F.round(rate, 2).alias("pass_rate"),
        F.when(rate >= threshold, "PASS").otherwise("FAIL").alias("status"),
    )
