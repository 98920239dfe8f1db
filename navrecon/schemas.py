"""Table layouts and fixed values of the performance data model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(12, 8)
# Check values hold both money and rates, so they need the integer digits of
# the first and the fraction digits of the second.
CHECK = T.DecimalType(28, 8)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _DAY, _TIME, _FLAG, _INT = (
    T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType(), T.IntegerType(),
)

ACCOUNTS = _struct(
    ("account_id", _TEXT), ("account_name", _TEXT), ("portfolio_id", _TEXT),
    ("client_id", _TEXT), ("account_type", _TEXT), ("inception_date", _DAY),
    ("status", _TEXT), ("created_at", _TIME), ("updated_at", _TIME),
)

# The loaded table, in its fixed column order.
PERFORMANCE = _struct(
    ("account_id", _TEXT), ("as_of_date", _DAY),
    ("beginning_market_value", MONEY), ("ending_market_value", MONEY),
    ("contributions", MONEY), ("distributions", MONEY), ("income", MONEY),
    ("appreciation", MONEY), ("fees", MONEY), ("other_adjustments", MONEY),
    ("net_flow", MONEY), ("cumulative_net_flow", T.DecimalType(28, 2)),
    ("calculated_twrr", RATE), ("cumulative_twrr", T.DoubleType()),
    ("vendor_twrr", RATE), ("benchmark_return", RATE),
    ("twrr_tolerance_check", _FLAG), ("twrr_variance", RATE),
    ("data_source", _TEXT), ("file_name", _TEXT), ("processed_by", _TEXT),
    ("created_at", _TIME), ("updated_at", _TIME), ("reconciliation_status", _TEXT),
)

# An account's flow and growth factor within one month.
MONTH_TOTALS = _struct(("account_id", _TEXT), ("flow_total", T.DecimalType(28, 2)), ("growth_total", T.DoubleType()))

PROCESSING_LOG = _struct(
    ("file_name", _TEXT), ("file_path", _TEXT), ("vendor", _TEXT),
    ("processing_start_time", _TIME), ("processing_end_time", _TIME),
    ("records_processed", T.LongType()), ("records_inserted", T.LongType()),
    ("records_updated", T.LongType()), ("records_failed", T.LongType()),
    ("status", _TEXT), ("error_message", _TEXT), ("created_at", _TIME),
)

QUALITY_ISSUES = _struct(
    ("account_id", _TEXT), ("as_of_date", _DAY), ("issue_type", _TEXT),
    ("issue_description", _TEXT), ("field_name", _TEXT), ("expected_value", _TEXT),
    ("actual_value", _TEXT), ("severity", _TEXT), ("created_at", _TIME),
)

RECON_RESULTS = _struct(
    ("account_id", _TEXT), ("as_of_date", _DAY), ("field_name", _TEXT),
    ("calculated_value", CHECK), ("vendor_value", CHECK), ("variance", CHECK),
    ("tolerance_threshold", CHECK), ("within_tolerance", _FLAG),
    ("reconciliation_date", _TIME), ("notes", _TEXT),
)

# Nested layout of vendor C. Leaves stay text so a bad value can be reported.
VENDOR_C = _struct(
    ("account", _struct(("id", _TEXT), ("name", _TEXT), ("portfolio", _TEXT))),
    ("reporting", _struct(
        ("period_end", _TEXT),
        ("market_values", _struct(("beginning", _TEXT), ("ending", _TEXT))),
        ("cash_flows", _struct(("contributions", _TEXT), ("distributions", _TEXT))),
        ("performance", _struct(
            ("income_earned", _TEXT), ("capital_appreciation", _TEXT),
            ("fees_paid", _TEXT), ("other_adjustments", _TEXT))),
        ("returns", _struct(("time_weighted", _TEXT), ("benchmark", _TEXT))),
    )),
)

# ---------------------------------------------------------------------------
# Field names, vendor spellings, tolerances, statuses, formats.
# ---------------------------------------------------------------------------

FIELD_ALIASES = {
    "account_id": ["account_id", "acct_id", "account_number"],
    "account_name": ["account_name", "acct_name", "account_desc"],
    "portfolio_id": ["portfolio_id", "port_id", "portfolio_number"],
    "as_of_date": ["as_of_date", "report_date", "date"],
    "beginning_market_value": ["beginning_mv", "start_value", "bmv"],
    "contributions": ["contributions", "deposits", "cash_in"],
    "distributions": ["distributions", "withdrawals", "cash_out"],
    "income": ["income", "dividend", "interest"],
    "appreciation": ["appreciation", "unrealized_gl", "price_change"],
    "fees": ["fees", "expenses", "management_fee"],
    "other_adjustments": ["adjustments", "other", "misc"],
    "ending_market_value": ["ending_mv", "end_value", "emv"],
    "benchmark_return": ["benchmark", "index_return", "bmk_return"],
    "vendor_twrr": ["twrr", "time_weighted_return", "twr"],
}
STANDARD_FIELDS = list(FIELD_ALIASES)
NUMERIC_FIELDS = [
    "beginning_market_value", "contributions", "distributions", "income",
    "appreciation", "fees", "other_adjustments", "ending_market_value",
    "benchmark_return", "vendor_twrr",
]
MONEY_FIELDS = NUMERIC_FIELDS[:8]
RATE_FIELDS = NUMERIC_FIELDS[8:]
REQUIRED_FIELDS = ["account_id", "as_of_date", "beginning_market_value", "ending_market_value"]
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd"]

VENDOR_NAME_PARTS = {
    "vendor_a": ["vendor_a_", "vendora_", "va_"],
    "vendor_b": ["vendor_b_", "vendorb_", "vb_"],
    "vendor_c": ["vendor_c_", "vendorc_", "vc_"],
}
DEFAULT_VENDOR = "vendor_a"
VENDOR_SUFFIXES = {"vendor_a": ["csv"], "vendor_b": ["xlsx", "xls"], "vendor_c": ["json"]}
SKIPPED_PREFIXES = ["processing/", "archive/", "error/"]
ARRIVAL_PREFIX = "incoming/"
ARRIVAL_SUFFIXES = ["csv", "json", "xlsx"]

TWRR_TOLERANCE = Decimal("0.0001")
VALUE_TOLERANCE = Decimal("0.01")
FLOW_TOLERANCE = Decimal("0.01")

PENDING, PROCESSING = "PENDING", "PROCESSING"
COMPLETED, WITH_ISSUES = "COMPLETED", "COMPLETED_WITH_ISSUES"
WITH_WARNINGS, FAILED = "COMPLETED_WITH_WARNINGS", "FAILED"

# Monitoring alarms: metric, statistic, period in seconds, periods, operator, threshold.
ALARMS = [
    ("glue-job-failure", "numFailedTasks", "Sum", 300, 1, ">=", 1.0),
    ("lambda-errors", "Errors", "Sum", 300, 2, ">", 3.0),
    ("lambda-duration", "Duration", "Average", 300, 3, ">", 240000.0),
    ("stepfunctions-failures", "ExecutionsFailed", "Sum", 300, 1, ">=", 1.0),
    ("rds-cpu-high", "CPUUtilization", "Average", 300, 3, ">", 80.0),
    ("rds-connections-high", "DatabaseConnections", "Average", 300, 2, ">", 80.0),
    ("data-quality-low", "Data_Quality_Score", "Average", 600, 2, "<", 90.0),
    ("reconciliation-failures", "TWRR_Reconciliation_Pass_Rate", "Average", 600, 1, "<", 95.0),
]

# KPI alerts: metric, comparison that raises the alert, limit, alert name.
ALERTS = [
    ("processing_success_rate", "<", 95.0, "LOW_PROCESSING_SUCCESS_RATE"),
    ("reconciliation_pass_rate", "<", 95.0, "LOW_RECONCILIATION_PASS_RATE"),
    ("error_rate_percent", ">", 5.0, "HIGH_ERROR_RATE"),
    ("lambda_duration_ms", ">", 10000.0, "HIGH_LAMBDA_DURATION"),
    ("rds_cpu_utilization", ">", 80.0, "HIGH_RDS_CPU_UTILIZATION"),
]
