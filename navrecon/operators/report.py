"""Reporting queries: summaries, dashboards, lists, pages and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navrecon.functions.finance import or_zero
from navrecon.functions.text import (
    basis_points, contains_text, currency, field_label, ilike_text, percent, rate_tier, since,
)
from navrecon.operators.latest import PERFORMANCE_KEY
from navrecon.operators.reconcile import pass_rate
from navrecon.schemas import COMPLETED, PROCESSING, WITH_ISSUES


def where_equal(df: DataFrame, **wanted: object) -> DataFrame:
    """Optional equality filters: an argument left None does not filter."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def mean(value: str) -> Column:
    """Average from an exact decimal sum: the same whatever the row order."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


# -- joins -------------------------------------------------------------------

def performance_summary(performance: DataFrame, accounts: DataFrame) -> DataFrame:
    """Performance rows of active accounts with name and portfolio."""
    active = accounts.where(F.col("status") == "ACTIVE").select("account_id", "account_name", "portfolio_id")
    return performance.join(active, "account_id").select(
        "account_id", "account_name", "portfolio_id", "as_of_date", "beginning_market_value",
        "ending_market_value", "net_flow", "calculated_twrr", "vendor_twrr", "twrr_variance",
        "twrr_tolerance_check", "reconciliation_status", "data_source",
    )


def with_lineage(results: DataFrame, performance: DataFrame, *extra: str) -> DataFrame:
    """Find the file of each check through the table key.

    `performance` holds one row per (account_id, as_of_date), so a check meets
    at most one row and no group can multiply.
    """
    side = performance.select(*PERFORMANCE_KEY, "data_source", "file_name", *extra)
    return results.join(side, list(PERFORMANCE_KEY))


def recon_results(
    results: DataFrame, performance: DataFrame, vendor: str | None = None, file_name: str | None = None,
    account_id: str | None = None, field_name: str | None = None, failures_only: bool = False,
    account_search: str | None = None, date_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Checks with their vendor and file, optionally filtered (before the join)."""
    results = where_equal(results, account_id=account_id, field_name=field_name)
    if failures_only:
        results = results.where(~F.col("within_tolerance"))
    if account_search:
        results = results.where(contains_text("account_id", account_search))
    if date_range:
        low, high = (F.lit(day).cast("date") for day in date_range)
        results = results.where(F.col("as_of_date").between(low, high))
    performance = where_equal(performance, data_source=vendor, file_name=file_name)
    return with_lineage(results, performance).withColumnRenamed("data_source", "vendor")


def recon_summary(
    results: DataFrame, performance: DataFrame, as_of: str, days_back: int = 30,
    vendor: str | None = None, file_name: str | None = None,
) -> DataFrame:
    """Totals per checked field. A check without verdict is in the total only."""
    recent = results.where(since("reconciliation_date", as_of, days_back))
    joined = with_lineage(recent, where_equal(performance, data_source=vendor, file_name=file_name))
    passed, failed = F.count_if("within_tolerance"), F.count_if(~F.col("within_tolerance"))
    return (
        joined.groupBy("field_name")
        .agg(
            F.count("*").alias("total_checks"), passed.alias("passed_checks"),
            failed.alias("failed_checks"), mean("variance").alias("avg_variance"),
            F.max("variance").alias("max_variance"), pass_rate(passed, F.count("*")).alias("pass_rate"),
        )
        .withColumn("field_label", field_label("field_name"))
        .withColumn("tier", rate_tier("pass_rate", 95, 90))
        .orderBy("pass_rate", "field_name")
    )


def export_report(
    results: DataFrame, performance: DataFrame, file_name: str | None = None, vendor: str | None = None
) -> DataFrame:
    """Rows of the reconciliation report, sorted for export."""
    values = ["beginning_market_value", "ending_market_value", "calculated_twrr", "vendor_twrr"]
    performance = where_equal(performance, data_source=vendor, file_name=file_name)
    return with_lineage(results, performance, *values).select(
        "account_id", "as_of_date", "field_name", "calculated_value", "vendor_value", "variance",
        "tolerance_threshold", "within_tolerance", "notes", *values,
    ).orderBy("account_id", "as_of_date", "field_name")


# -- lists and totals --------------------------------------------------------

def vendor_list(performance: DataFrame) -> DataFrame:
    return performance.groupBy(F.col("data_source").alias("vendor_name")).agg(
        F.count("*").alias("row_count"), F.count_distinct("file_name").alias("file_count"),
        F.max("created_at").alias("last_processed"),
    ).orderBy("vendor_name")


def file_list(performance: DataFrame, vendor: str | None = None, search: str | None = None) -> DataFrame:
    """One row per file with its times and a status rolled up from its rows."""
    rows = where_equal(performance, data_source=vendor).where(contains_text("file_name", search))

    def status(value: str) -> Column:
        return F.count_if(F.col("reconciliation_status") == value)

    return rows.groupBy("file_name", F.col("data_source").alias("vendor")).agg(
        F.count("*").alias("record_count"), F.min("created_at").alias("processing_start"),
        F.max("updated_at").alias("last_updated"),
        F.when(status(COMPLETED) == F.count("*"), COMPLETED)
        .when(status(WITH_ISSUES) > 0, WITH_ISSUES).otherwise(PROCESSING).alias("overall_status"),
    ).orderBy(F.desc("last_updated"), "file_name")


def file_details(performance: DataFrame, file_name: str | None = None, vendor: str | None = None) -> DataFrame:
    rows = where_equal(performance, file_name=file_name, data_source=vendor)
    return rows.groupBy("file_name", F.col("data_source").alias("vendor")).agg(
        F.count("*").alias("total_records"), F.count_distinct("account_id").alias("unique_accounts"),
        F.min("as_of_date").alias("earliest_date"), F.max("as_of_date").alias("latest_date"),
        F.sum("ending_market_value").alias("total_market_value"), mean("calculated_twrr").alias("avg_twrr"),
        F.count_if(~F.col("twrr_tolerance_check")).alias("twrr_failures"),
    )


def file_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count("*").alias("total_files"), F.sum("record_count").alias("total_records"),
        F.count_if(F.col("overall_status") == COMPLETED).alias("completed_files"),
    )


def dashboard_metrics(performance: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    """Headline totals. Rows are first folded per (file, vendor, account), so the
    three distinct counts expand that small table and not the rows."""
    folded = (
        performance.where(since("created_at", as_of, days_back))
        .groupBy("file_name", "data_source", "account_id")
        .agg(
            F.count("*").alias("n"), F.sum("ending_market_value").alias("aum"),
            F.sum("calculated_twrr").alias("twrr"), F.count("calculated_twrr").alias("n_twrr"),
        )
    )
    return folded.agg(
        F.count_distinct("file_name").alias("total_files_processed"),
        F.count_distinct("data_source").alias("total_vendors"),
        F.count_distinct("account_id").alias("total_accounts"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.sum("aum").alias("total_aum"),
        F.try_divide(F.sum("twrr").cast("double"), F.sum("n_twrr")).alias("avg_twrr"),
    )


def recon_overall(results: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    passed = F.count_if("within_tolerance")
    return results.where(since("reconciliation_date", as_of, days_back)).agg(
        F.count("*").alias("total_recon_checks"), passed.alias("passed_checks"),
        pass_rate(passed, F.count("*")).alias("overall_pass_rate"),
    )


def daily_volume(performance: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    return (
        performance.where(since("created_at", as_of, days_back))
        .groupBy(F.to_date("created_at").alias("processing_date"))
        .agg(F.count_distinct("file_name").alias("files_processed"), F.count("*").alias("records_processed"))
        .orderBy(F.desc("processing_date"))
    )


def monthly_growth(performance: DataFrame, as_of: str, days_back: int = 180) -> DataFrame:
    return (
        performance.where(since("created_at", as_of, days_back))
        .groupBy(F.trunc("created_at", "month").alias("month"))
        .agg(F.count("*").alias("records"))
        .orderBy("month")
    )


def dq_dashboard(issues: DataFrame, as_of: str, days_back: int = 30) -> DataFrame:
    return (
        issues.where(since("created_at", as_of, days_back))
        .groupBy(F.to_date("created_at").alias("issue_date"), "issue_type", "severity")
        .agg(F.count("*").alias("issue_count"), F.count_distinct("account_id").alias("affected_accounts"))
        .orderBy(F.desc("issue_date"), F.desc("issue_count"), "issue_type", "severity")
    )


def dq_daily(issues: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    return (
        issues.where(since("created_at", as_of, days_back))
        .groupBy(F.to_date("created_at").alias("date"), "severity")
        .agg(F.count("*").alias("issue_count"))
        .orderBy(F.desc("date"), "severity")
    )


def issue_type_stats(issues: DataFrame, as_of: str, days_back: int = 1) -> DataFrame:
    """Issues per type; the average uses only values that are plain numbers."""
    plain = F.when(F.col("actual_value").rlike(r"^[0-9.]+$"), F.col("actual_value").try_cast("decimal(28,8)"))
    return (
        issues.where(since("created_at", as_of, days_back))
        .withColumn("_number", plain)
        .groupBy("issue_type")
        .agg(F.count("*").alias("issue_count"), mean("_number").alias("avg_actual_value"))
    )


def recent_runs(log: DataFrame, as_of: str, days_back: int = 1) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.col("processing_start_time"), F.col("processing_end_time"))
    return (
        log.where(since("processing_start_time", as_of, days_back))
        .select("file_name", "vendor", "status", "records_processed", seconds.alias("duration_seconds"),
                "processing_start_time")
        .orderBy(F.desc("processing_start_time"), "file_name")
    )


def weekly_report(log: DataFrame) -> DataFrame:
    """Per week and vendor: rows, mean duration of a file, share of failed rows."""
    seconds = F.timestamp_diff("SECOND", F.col("processing_start_time"), F.col("processing_end_time"))
    return log.groupBy(F.to_date(F.date_trunc("week", "processing_start_time")).alias("week_start"), "vendor").agg(
        F.count("*").alias("files"), F.sum("records_processed").alias("records_processed"),
        F.round(F.avg(seconds), 2).alias("avg_duration_seconds"),
        pass_rate(F.sum("records_failed"), F.sum("records_processed")).alias("error_rate"),
    )


def file_tolerance_summary(performance: DataFrame) -> DataFrame:
    return performance.groupBy("file_name").agg(
        F.count("*").alias("total_accounts"),
        F.count_if("twrr_tolerance_check").alias("passed_tolerance"),
        mean("twrr_variance").alias("avg_variance"),
    )


def vendor_profile(performance: DataFrame, bound: float = 0.5) -> DataFrame:
    far = F.abs(F.col("vendor_twrr")) > F.lit(str(bound)).cast("decimal(12,8)")
    return performance.groupBy("data_source").agg(
        F.count("*").alias("records"), F.count_distinct("account_id").alias("accounts"),
        F.min("as_of_date").alias("first_date"), F.max("as_of_date").alias("last_date"),
        F.sum("ending_market_value").alias("total_market_value"), mean("vendor_twrr").alias("avg_twrr"),
        F.count_if(F.col("income").isNull()).alias("missing_income_records"),
        F.count_if(far).alias("twrr_outliers"),
    )


# -- rows, pages and series --------------------------------------------------

def file_rows(performance: DataFrame, file_name: str, vendor: str) -> DataFrame:
    """Stored rows of one file for reconciliation, in table order."""
    columns = [
        "account_id", "as_of_date", "beginning_market_value", "ending_market_value", "contributions",
        "distributions", "income", "appreciation", "fees", "other_adjustments", "net_flow",
        "calculated_twrr", "vendor_twrr", "benchmark_return", "twrr_variance", "twrr_tolerance_check",
    ]
    optional = [c for c in ("cumulative_net_flow", "cumulative_twrr") if c in performance.columns]
    return where_equal(performance, file_name=file_name, data_source=vendor).select(
        *columns, *optional).orderBy("account_id", "as_of_date")


def account_rows(
    performance: DataFrame, vendor: str | None = None, file_name: str | None = None,
    search: str | None = None, status: str | None = None,
) -> DataFrame:
    rows = where_equal(performance, data_source=vendor, file_name=file_name, reconciliation_status=status)
    optional = [c for c in ("cumulative_net_flow",) if c in performance.columns]
    return rows.where(ilike_text("account_id", search)).select(
        "account_id", F.col("data_source").alias("vendor"), "file_name", "as_of_date",
        "beginning_market_value", "ending_market_value", "calculated_twrr", "vendor_twrr",
        "twrr_variance", "twrr_tolerance_check", "net_flow", *optional, "reconciliation_status",
    )


def page(rows: DataFrame, order: list[Column], size: int = 100, offset: int = 0) -> DataFrame:
    """LIMIT/OFFSET page; the order must end in a unique column. A page is a
    top-k over (offset + size) rows, so early pages need no full sort."""
    return rows.orderBy(*order).offset(offset).limit(size)


def next_page(
    rows: DataFrame, after: tuple[str, str] | None, size: int = 100,
    keys: tuple[str, str] = ("account_id", "as_of_date"),
) -> DataFrame:
    """Keyset page: rows after the last seen (account, date), dates descending.
    Deep pages cost the same as the first."""
    if after:
        account, day = F.lit(after[0]), F.lit(after[1]).cast("date")
        rows = rows.where((F.col(keys[0]) > account) | ((F.col(keys[0]) == account) & (F.col(keys[1]) < day)))
    return rows.orderBy(F.col(keys[0]), F.col(keys[1]).desc()).limit(size)


def page_info(counts: DataFrame, size: int, current: int, total: str = "total") -> DataFrame:
    """Paging facts for a row count: pages, offset, neighbours."""
    pages = F.ceil(F.col(total) / F.lit(size)).cast("long")
    return counts.withColumns({
        "page": F.lit(current).cast("long"), "per_page": F.lit(size).cast("long"), "pages": pages,
        "row_offset": F.lit((current - 1) * size).cast("long"),
        "has_prev": F.lit(current > 1), "has_next": F.lit(current) < pages,
        "prev_num": F.lit(current - 1 if current > 1 else None).cast("long"),
        "next_num": F.when(F.lit(current) < pages, F.lit(current + 1)).cast("long"),
    })


def estimated_total(returned: int, size: int, current: int) -> int:
    """Total shown while the real one is unknown: a full page implies one more row."""
    seen = (current - 1) * size
    return seen + returned if returned < size else seen + size + 1


def account_history(
    performance: DataFrame, as_of: str, months_back: int = 12,
    account_id: str | None = None, vendor: str | None = None,
) -> DataFrame:
    """History over months of 30 days; one account, or all when none is named."""
    floor = F.expr(f"DATE'{as_of}' - INTERVAL {int(months_back) * 30} DAYS")
    rows = where_equal(performance, account_id=account_id, data_source=vendor)
    return rows.where(F.col("as_of_date") >= floor).orderBy("account_id", "as_of_date")


def history_series(history: DataFrame) -> DataFrame:
    """Chart points: missing values as zero, returns in percent."""
    optional = [c for c in ("cumulative_twrr",) if c in history.columns]
    return history.select(
        "account_id", "as_of_date",
        or_zero("ending_market_value").alias("ending_mv"),
        *[(or_zero(c) * F.lit(100)).alias(c) for c in ("calculated_twrr", "vendor_twrr", *optional)],
        or_zero("net_flow").alias("net_flow"),
    )


def recent_window(rows: DataFrame, as_of: str, days_back: int, column: str = "created_at") -> DataFrame:
    return rows.where(since(column, as_of, days_back))


def variance_flags(checks: DataFrame) -> DataFrame:
    """Table highlights: PASS/FAIL tag and whether the variance stands out."""
    return checks.withColumns({
        "status": F.when(F.col("within_tolerance"), "PASS").otherwise("FAIL"),
        "high_variance": F.coalesce(F.col("variance") > F.lit("0.001").cast("decimal(28,8)"), F.lit(False)),
        "above_basis_point": F.coalesce(F.abs("variance") > F.lit("0.0001").cast("decimal(28,8)"), F.lit(False)),
    })


def sort_by_variance(rows: DataFrame, *ties: str, column: str = "twrr_variance") -> DataFrame:
    return rows.orderBy(F.abs(or_zero(column)).desc(), *ties)


def formatted(performance: DataFrame) -> DataFrame:
    return performance.select(
        "period_id",
        currency("ending_market_value").alias("ending_value_text"),
        percent("calculated_twrr").alias("return_text"),
        basis_points("calculated_twrr").alias("return_bps_text"),
    )
