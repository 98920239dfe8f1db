"""SQL counterparts of the registered queries, for DuckDB on the same tables.

Written from the definitions, independent of the Spark code. BLOCKS are common
table expressions; each query names the ones it needs.
"""

from __future__ import annotations

from navrecon.schemas import ALARMS

AS_OF = "DATE '2001-08-02'"
SINCE = f"CAST({AS_OF} - INTERVAL 1200 DAY AS TIMESTAMP)"
# The fixed alarms as the query sets them on the test tables' metrics.
WATCHED = [(name, ("view", "click", "error", "purchase", "signup")[i % 5], statistic, seconds * 12, periods, operator,
            60.0 if statistic == "Sum" else 50.0)
           for i, (name, _, statistic, seconds, periods, operator, _) in enumerate(ALARMS)]
M = "DECIMAL(18,2)"
R = "DECIMAL(12,8)"
C = "DECIMAL(28,8)"


def ret(b: str, e: str, f: str, guard: str | None = None) -> str:
    adj = f"(CAST({b} AS DOUBLE) + CAST(COALESCE({f}, 0) AS DOUBLE) / 2)"
    return (
        f"CASE WHEN {guard or adj + ' > 0'} THEN "
        f"TRY_CAST((CAST({e} AS DOUBLE) - {adj}) / {adj} AS {R}) END"
    )


def dbl(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def rnd(expr: str, digits: int = 6) -> str:
    return f"FLOOR(({expr}) * CAST(1e{digits} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1e{digits} AS DOUBLE)"


def mean(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / NULLIF(COUNT({c}), 0)"


def deviation(c: str, ddof: int) -> str:
    """Standard deviation from exact decimal sums."""
    total, squares = f"CAST(SUM({c}) AS DOUBLE)", f"CAST(SUM(CAST({c} AS DECIMAL(19,8)) * CAST({c} AS DECIMAL(19,8))) AS DOUBLE)"
    return f"SQRT(GREATEST({squares} - {total} * {total} / COUNT({c}), CAST(0 AS DOUBLE)) / (COUNT({c}) - {ddof}))"


def rate(part: str, whole: str, digits: int = 2) -> str:
    return f"ROUND({part} * CAST(100 AS DOUBLE) / NULLIF({whole}, 0), {digits})"


DATE_OF_TEXT = (
    "CAST(COALESCE(TRY_STRPTIME(as_of_date, '%Y-%m-%d'), TRY_STRPTIME(as_of_date, '%m/%d/%Y'), "
    "TRY_STRPTIME(as_of_date, '%d/%m/%Y'), TRY_STRPTIME(as_of_date, '%Y/%m/%d')) AS DATE)"
)
NUMERIC = [
    "beginning_market_value", "contributions", "distributions", "income", "appreciation", "fees",
    "other_adjustments", "ending_market_value", "benchmark_return", "vendor_twrr",
]
STANDARD = ["account_id", "account_name", "portfolio_id", "as_of_date", *NUMERIC]


def num(c: str) -> str:
    return f"TRY_CAST({c} AS {C})"


def _check(field: str, calculated: str, vendor: str, tol: str, note: str) -> str:
    gap = f"ABS(CAST({calculated} AS {C}) - CAST({vendor} AS {C}))"
    return f"""SELECT account_id, as_of_date, data_source, file_name, created_at AS reconciliation_date,
      '{field}' AS field_name, CAST({calculated} AS {C}) AS calculated_value, CAST({vendor} AS {C}) AS vendor_value,
      {gap} AS variance, CAST({tol} AS {C}) AS tolerance_threshold, {gap} <= {tol} AS within_tolerance,
      {note} AS notes FROM stored"""


MV_CHECK = _check(
    "ending_market_value",
    "(COALESCE(beginning_market_value, 0) + COALESCE(net_flow, 0) + COALESCE(income, 0) + COALESCE(appreciation, 0)"
    " - COALESCE(fees, 0) + COALESCE(other_adjustments, 0))",
    "COALESCE(ending_market_value, 0)", "0.01", "''")
TWRR_CHECK = _check(
    "twrr", "calculated_twrr", "vendor_twrr", "0.0001",
    "CASE WHEN calculated_twrr IS NULL OR vendor_twrr IS NULL THEN 'Missing TWRR values' ELSE '' END")
FLOW_CHECK = _check(
    "net_flow", "(COALESCE(contributions, 0) - COALESCE(distributions, 0))", "COALESCE(net_flow, 0)", "0.01", "''")


def _rule(kind: str, field: str, severity: str, bad: str, text: str, expected: str) -> str:
    return f"""SELECT period_id, data_source, file_name, account_id, {DATE_OF_TEXT} AS as_of_date,
      '{kind}' AS issue_type, '{text}' AS issue_description, '{field}' AS field_name, '{expected}' AS expected_value,
      {field} AS actual_value, '{severity}' AS severity, created_at FROM raw_text WHERE {bad}"""


RULES = [
    _rule("missing_account_id", "account_id", "HIGH", "account_id IS NULL OR TRIM(account_id) = ''",
          "account id is blank", "non-blank"),
    _rule("negative_beginning_market_value", "beginning_market_value", "HIGH",
          f"{num('beginning_market_value')} < 0", "value is below zero", ">= 0"),
    _rule("negative_ending_market_value", "ending_market_value", "HIGH",
          f"{num('ending_market_value')} < 0", "value is below zero", ">= 0"),
    _rule("unrealistic_twrr", "vendor_twrr", "MEDIUM", f"ABS({num('vendor_twrr')}) > 1",
          "return is beyond 100 percent", "between -1 and 1"),
    _rule("null_contributions", "contributions", "LOW", "contributions IS NULL", "flow is missing", "not null"),
    _rule("null_distributions", "distributions", "LOW", "distributions IS NULL", "flow is missing", "not null"),
]
TYPES = [
    *[_rule(f"invalid_{c}_type", c, "HIGH", f"{c} IS NOT NULL AND TRY_CAST({c} AS {R if c in ('benchmark_return', 'vendor_twrr') else M}) IS NULL",
          "value is not a number", "number")
      for c in NUMERIC],
    _rule("invalid_date_format", "as_of_date", "HIGH", f"as_of_date IS NOT NULL AND {DATE_OF_TEXT} IS NULL",
          "date matches no known format", "date"),
]
UNION = "\nUNION ALL\n"

_PERF_COLS = "* EXCLUDE (flow)"
BLOCKS = {
    "li": (f"""SELECT l_orderkey,
      SUM(CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS {M})) AS a_amt,
      SUM(CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS {M})) AS r_amt,
      SUM(CAST(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END AS {M})) AS o_amt,
      SUM(CAST(l_extendedprice AS {M}) * CAST(l_discount AS DECIMAL(4,2))) AS disc_amt,
      SUM(CAST(l_extendedprice AS {M}) * CAST(l_tax AS DECIMAL(4,2))) AS tax_amt
      FROM lineitem GROUP BY l_orderkey""", []),
    "base": (f"""SELECT o_orderkey AS period_id, CAST(CASE WHEN o_orderkey % 53 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END
        AS VARCHAR) AS account_id,
      CAST(o_orderdate AS DATE) AS as_of_date,
      CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_totalprice AS {M}) END AS beginning_market_value,
      CAST(a_amt * CAST(0.05 AS DECIMAL(3,2)) AS {M}) AS contributions,
      CAST(r_amt * CAST(0.05 AS DECIMAL(3,2)) AS {M}) AS distributions,
      CAST(tax_amt AS {M}) AS income,
      CAST(o_amt * CAST(0.01 AS DECIMAL(3,2)) AS {M}) AS appreciation,
      CAST(disc_amt AS {M}) AS fees,
      CASE WHEN o_orderkey % 17 = 0 THEN CAST(1.25 AS {M}) END AS other_adjustments
      FROM orders LEFT JOIN li ON o_orderkey = l_orderkey""", ["li"]),
    "flows": (f"""SELECT *, CAST(COALESCE(contributions, 0) - COALESCE(distributions, 0) AS {M}) AS flow,
      CASE period_id % 3 WHEN 0 THEN 'vendor_a' WHEN 1 THEN 'vendor_b' ELSE 'vendor_c' END AS data_source
      FROM base""", ["base"]),
    "ended": (f"""SELECT *, CAST(beginning_market_value + flow + COALESCE(income, 0) + COALESCE(appreciation, 0)
      - COALESCE(fees, 0) + COALESCE(other_adjustments, 0)
      + CASE WHEN period_id % 13 = 0 THEN CAST(0.02 AS {M}) ELSE CAST(0 AS {M}) END AS {M}) AS ending_market_value
      FROM flows""", ["flows"]),
    "records": (f"""SELECT *, CAST(((period_id % 21) - 10) * CAST(0.001 AS DECIMAL(4,3)) AS {R}) AS benchmark_return,
      CASE WHEN period_id % 11 <> 0 THEN TRY_CAST({ret('beginning_market_value', 'ending_market_value', 'flow')}
        + CAST(((period_id % 5) - 2) * CAST(0.00006 AS {R}) AS {R}) AS {R}) END AS vendor_twrr,
      data_source || '_performance_' || CAST(EXTRACT(YEAR FROM as_of_date) AS VARCHAR) || '.csv' AS file_name,
      CAST(as_of_date AS TIMESTAMP) + INTERVAL 1 DAY AS created_at,
      CAST(as_of_date AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 1 HOUR * (period_id % 24) AS updated_at
      FROM ended""", ["ended"]),
    "slipped": (f"""SELECT *, CAST(flow + CASE WHEN period_id % 19 = 0 THEN CAST(0.05 AS {M})
      ELSE CAST(0 AS {M}) END AS {M}) AS net_flow FROM records""", ["records"]),
    "returned": (f"""SELECT *, {ret('beginning_market_value', 'ending_market_value', 'net_flow')} AS calculated_twrr
      FROM slipped""", ["slipped"]),
    "performance": (f"""SELECT *, TRY_CAST(ABS(calculated_twrr - vendor_twrr) AS {R}) AS twrr_variance,
      ABS(calculated_twrr - vendor_twrr) <= 0.0001 AS twrr_tolerance_check,
      CASE WHEN period_id % 7 = 0 THEN 'COMPLETED_WITH_ISSUES' WHEN period_id % 5 = 0 THEN 'PENDING'
        ELSE 'COMPLETED' END AS reconciliation_status FROM returned""", ["returned"]),
    "stored": ("""SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY account_id, as_of_date ORDER BY updated_at DESC, period_id DESC) AS rk FROM performance)
      WHERE rk = 1""", ["performance"]),
    "load_rows": (f"""SELECT *, {DATE_OF_TEXT} AS day,
      CASE WHEN TRIM(account_id) = '' THEN 'missing_account_id' WHEN {DATE_OF_TEXT} IS NULL THEN 'missing_or_invalid_date'
        WHEN {' OR '.join(f"({c} IS NOT NULL AND TRY_CAST({c} AS {M if c not in ('benchmark_return', 'vendor_twrr') else R}) IS NULL)" for c in NUMERIC)}
        THEN 'invalid_value' END AS reason FROM raw_text""", ["raw_text"]),
    "loaded": (f"""SELECT *, CAST(COALESCE(c, 0) - COALESCE(d, 0) AS {M}) AS flow FROM (
      SELECT account_id, day, 'vendor_a_' || CAST(1 + period_id % 2 AS VARCHAR) || '.csv' AS file_name,
        CAST(beginning_market_value AS {M}) AS b, CAST(ending_market_value AS {M}) AS e, CAST(vendor_twrr AS {R}) AS v,
        CAST(contributions AS {M}) AS c, CAST(distributions AS {M}) AS d, CAST(income AS {M}) AS i
        FROM load_rows WHERE reason IS NULL)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id, day ORDER BY file_name DESC, e DESC NULLS LAST,
        b DESC NULLS LAST, v DESC NULLS LAST, c DESC NULLS LAST, d DESC NULLS LAST, i DESC NULLS LAST) = 1""", ["load_rows"]),
    "load_parts": ("""SELECT reason AS part, COUNT(*) AS n FROM load_rows WHERE reason IS NOT NULL GROUP BY 1
      UNION ALL SELECT 'stored', COUNT(*) FROM (SELECT DISTINCT account_id, day FROM load_rows WHERE reason IS NULL)
      UNION ALL SELECT 'duplicate_key', n FROM (SELECT COUNT(*) - COUNT(DISTINCT (account_id, day)) AS n
        FROM load_rows WHERE reason IS NULL) WHERE n > 0""", ["load_rows"]),
    "accumulated": ("""SELECT *, SUM(COALESCE(net_flow, 0)) OVER w AS cumulative_net_flow,
      PRODUCT(1 + COALESCE(CAST(calculated_twrr AS DOUBLE), 0)) OVER w - 1 AS cumulative_twrr
      FROM stored WINDOW w AS (PARTITION BY account_id ORDER BY as_of_date, period_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ["stored"]),
    "accounts": ("""SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS account_name,
      CAST(c_nationkey AS VARCHAR) AS portfolio_id, c_mktsegment AS account_type,
      CASE WHEN c_custkey % 10 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
      FROM customer""", []),
    "ported": ("SELECT stored.*, portfolio_id FROM stored JOIN accounts USING (account_id)", ["stored", "accounts"]),
    "raw_text": ("""SELECT period_id, CASE WHEN period_id % 29 = 0 THEN '' ELSE account_id END AS account_id,
      'Account ' || account_id AS account_name,
      'P' || CAST(CAST(account_id AS BIGINT) % 25 AS VARCHAR) AS portfolio_id,
      CASE WHEN period_id % 41 = 0 THEN 'n/a' WHEN period_id % 4 = 1 THEN STRFTIME(as_of_date, '%m/%d/%Y')
        WHEN period_id % 4 = 2 THEN STRFTIME(as_of_date, '%Y/%m/%d') ELSE CAST(as_of_date AS VARCHAR) END AS as_of_date,
      CASE WHEN period_id % 43 = 0 THEN '-' || CAST(beginning_market_value AS VARCHAR)
        ELSE CAST(beginning_market_value AS VARCHAR) END AS beginning_market_value,
      CASE WHEN period_id % 23 = 0 THEN 'invalid'
        WHEN period_id % 31 = 0 THEN '-' || CAST(ending_market_value AS VARCHAR)
        ELSE CAST(ending_market_value AS VARCHAR) END AS ending_market_value,
      CAST(contributions AS VARCHAR) AS contributions, CAST(distributions AS VARCHAR) AS distributions,
      CAST(income AS VARCHAR) AS income, CAST(appreciation AS VARCHAR) AS appreciation,
      CAST(fees AS VARCHAR) AS fees, CAST(other_adjustments AS VARCHAR) AS other_adjustments,
      CAST(benchmark_return AS VARCHAR) AS benchmark_return,
      CASE WHEN period_id % 37 = 0 THEN '1.5' ELSE CAST(vendor_twrr AS VARCHAR) END AS vendor_twrr,
      data_source, file_name, created_at FROM records""", ["records"]),
    "checks": (UNION.join([MV_CHECK, TWRR_CHECK, FLOW_CHECK]), ["stored"]),
    "issues": (UNION.join(RULES + TYPES), ["raw_text"]),
    "routed": ("""SELECT raw_text.period_id, raw_text.data_source, COUNT(i.period_id) AS issue_count
      FROM raw_text LEFT JOIN issues i ON raw_text.period_id = i.period_id GROUP BY 1, 2""", ["raw_text", "issues"]),
    "log": ("""SELECT file_name, data_source AS vendor, MIN(created_at) AS processing_start_time,
      MAX(updated_at) AS processing_end_time, COUNT(*) AS records_processed,
      COUNT(DISTINCT account_id || '~' || CAST(as_of_date AS VARCHAR)) AS records_inserted,
      COUNT(*) - COUNT(DISTINCT account_id || '~' || CAST(as_of_date AS VARCHAR)) AS records_updated,
      COUNT(*) FILTER (WHERE beginning_market_value IS NULL OR ending_market_value IS NULL) AS records_failed
      FROM performance GROUP BY 1, 2""", ["performance"]),
    "running": ("""SELECT *, SUM(COALESCE(net_flow, 0)) OVER w AS cumulative_net_flow,
      PRODUCT(1 + COALESCE(CAST(calculated_twrr AS DOUBLE), 0)) OVER w - 1 AS cumulative_twrr
      FROM performance WINDOW w AS (PARTITION BY account_id ORDER BY as_of_date, period_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ["performance"]),
    "outliers": (f"""SELECT p.*, mean_twrr, std_twrr FROM ported p JOIN (
      SELECT data_source, file_name, portfolio_id, {mean('calculated_twrr')} AS mean_twrr,
        {deviation('calculated_twrr', 1)} AS std_twrr FROM ported GROUP BY 1, 2, 3
        HAVING COUNT(calculated_twrr) > 1) s
      ON p.data_source = s.data_source AND p.file_name = s.file_name AND p.portfolio_id = s.portfolio_id
      WHERE ABS(CAST(calculated_twrr AS DOUBLE) - mean_twrr) > 3 * std_twrr""", ["ported"]),
    "dates": ("""SELECT data_source, file_name, portfolio_id, COUNT(DISTINCT as_of_date) AS unique_dates,
      COUNT(DISTINCT account_id) AS total_accounts FROM ported GROUP BY 1, 2, 3
      HAVING COUNT(DISTINCT as_of_date) > 1""", ["ported"]),
    "totals": (f"""SELECT data_source, file_name, COUNT(*) AS total_checks,
      COUNT(*) FILTER (WHERE within_tolerance) AS passed_checks,
      COUNT(*) FILTER (WHERE within_tolerance IS NULL) AS not_comparable,
      COUNT(*) - COUNT(*) FILTER (WHERE within_tolerance) AS failed_checks,
      {rate('COUNT(*) FILTER (WHERE within_tolerance)', 'COUNT(*)')} AS pass_rate_percentage
      FROM checks GROUP BY 1, 2""", ["checks"]),
    "findings": ("""SELECT data_source, file_name, portfolio_id FROM dates
      UNION ALL SELECT DISTINCT data_source, file_name, portfolio_id FROM outliers""", ["dates", "outliers"]),
    "reports": ("""SELECT t.*, COALESCE(w.n, 0) AS warning_count, CAST(0 AS BIGINT) AS error_count,
      CASE WHEN failed_checks = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status,
      CASE WHEN failed_checks = 0 THEN 'COMPLETED' ELSE 'COMPLETED_WITH_ISSUES' END AS reconciliation_status
      FROM totals t LEFT JOIN (SELECT data_source, file_name, COUNT(*) AS n FROM findings GROUP BY 1, 2) w
      ON t.data_source = w.data_source AND t.file_name = w.file_name""", ["totals", "findings"]),
    "all_issues": ("""SELECT period_id, data_source, file_name, issue_type, field_name, severity FROM issues
      UNION ALL SELECT period_id, data_source, file_name, 'unknown_account', 'account_id', 'HIGH' FROM stored
        WHERE account_id NOT IN (SELECT account_id FROM accounts)
      UNION ALL SELECT period_id, data_source, file_name, 'twrr_outlier', 'calculated_twrr', 'WARNING' FROM outliers""",
      ["issues", "stored", "accounts", "outliers"]),
    "fresh": (f"""SELECT *, {ret('beginning_market_value', 'ending_market_value', 'flow')} AS fresh_twrr
      FROM performance""", ["performance"]),
    "twice": ("""SELECT *, CASE WHEN period_id % 107 <> 0 THEN SUM(COALESCE(net_flow, 0)) OVER w
        + CASE WHEN period_id % 101 = 0 THEN 1 ELSE 0 END END AS sum_old, SUM(flow) OVER w AS sum_new,
      CASE WHEN period_id % 107 <> 0 THEN PRODUCT(1 + COALESCE(CAST(calculated_twrr AS DOUBLE), 0)) OVER w
        + CASE WHEN period_id % 103 = 0 THEN CAST(0.001 AS DOUBLE) ELSE 0 END END AS growth_old,
      PRODUCT(1 + COALESCE(CAST(fresh_twrr AS DOUBLE), 0)) OVER w AS growth_new
      FROM fresh WINDOW w AS (PARTITION BY account_id ORDER BY as_of_date, period_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ["fresh"]),
    "recomputed": ("""SELECT data_source, file_name, COUNT(*) AS rows_checked,
      COUNT(*) FILTER (WHERE ABS(net_flow - flow) > 0.01) AS net_flow_mismatches,
      COUNT(*) FILTER (WHERE ABS(calculated_twrr - fresh_twrr) > 0.0001) AS twrr_mismatches,
      COUNT(*) FILTER (WHERE COALESCE(ABS(sum_old - sum_new) > 0.01, TRUE)) AS cumulative_flow_mismatches,
      COUNT(*) FILTER (WHERE COALESCE(ABS(growth_old - growth_new) > CAST(0.0001 AS DOUBLE), TRUE)) AS cumulative_twrr_mismatches
      FROM twice GROUP BY 1, 2""", ["twice"]),
    "arrivals": ("""SELECT
      CASE o_orderkey % 6 WHEN 3 THEN 'processing/' WHEN 4 THEN 'archive/' WHEN 5 THEN 'error/' ELSE 'incoming/' END
      || CASE o_orderkey % 7 WHEN 0 THEN 'Vendor_A_' WHEN 1 THEN 'vendorb_' WHEN 2 THEN 'VC_' WHEN 3 THEN 'unknown_'
        WHEN 4 THEN 'va_' WHEN 5 THEN 'vendor_b_' ELSE 'vendorc_' END
      || CAST(o_orderkey AS VARCHAR)
      || CASE o_orderkey % 5 WHEN 0 THEN '.csv' WHEN 1 THEN '.XLSX' WHEN 2 THEN '.json' WHEN 3 THEN '.txt'
        ELSE '.xls' END AS file_key,
      CAST(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE FLOOR(o_totalprice) END AS BIGINT) AS file_size FROM orders""", []),
    "named": ("""SELECT *, SPLIT_PART(file_key, '/', 2) AS file_name FROM arrivals""", ["arrivals"]),
    "routes": ("""SELECT *, CASE
      WHEN LOWER(file_name) LIKE '%vendor!_a!_%' ESCAPE '!' OR LOWER(file_name) LIKE '%vendora!_%' ESCAPE '!'
        OR LOWER(file_name) LIKE '%va!_%' ESCAPE '!' THEN 'vendor_a'
      WHEN LOWER(file_name) LIKE '%vendor!_b!_%' ESCAPE '!' OR LOWER(file_name) LIKE '%vendorb!_%' ESCAPE '!'
        OR LOWER(file_name) LIKE '%vb!_%' ESCAPE '!' THEN 'vendor_b'
      WHEN LOWER(file_name) LIKE '%vendor!_c!_%' ESCAPE '!' OR LOWER(file_name) LIKE '%vendorc!_%' ESCAPE '!'
        OR LOWER(file_name) LIKE '%vc!_%' ESCAPE '!' THEN 'vendor_c'
      ELSE 'vendor_a' END AS vendor FROM named""", ["named"]),
    "lines": ("""SELECT event_id, ts, CASE event_type
      WHEN 'error' THEN 'ERROR batch failed, variance above tolerance for user ' || CAST(user_id AS VARCHAR)
      WHEN 'purchase' THEN 'records processed: processed ' || REGEXP_EXTRACT(props, '"k": (\\d+)', 1) || ' records'
      WHEN 'view' THEN 'twrr variance found for user ' || CAST(user_id AS VARCHAR)
      WHEN 'click' THEN 'data quality check done, quality score: ' || REGEXP_EXTRACT(props, '"k": (\\d+)', 1)
      ELSE 'INFO heartbeat' END AS message FROM events""", []),
    "points": ("""SELECT event_type AS metric_name, ts, CAST(value AS DECIMAL(18,4)) AS value FROM events""", []),
}


def sql(select: str, *blocks: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        for other in BLOCKS[name][1]:
            need(other)
        if name not in order:
            order.append(name)

    for name in blocks:
        need(name)
    head = ",\n".join(f"{name} AS ({BLOCKS[name][0]})" for name in order)
    return f"WITH {head}\n{select}" if order else select


CHECK_COLS = (
    "account_id, as_of_date, data_source, file_name, reconciliation_date, field_name, "
    + dbl("calculated_value", "vendor_value", "variance", "tolerance_threshold") + ", within_tolerance, notes"
)
CHECK_ROW = (
    "c.account_id, c.as_of_date, field_name, CAST(calculated_value AS DOUBLE) AS calculated_value, "
    "CAST(vendor_value AS DOUBLE) AS vendor_value, CAST(variance AS DOUBLE) AS variance, within_tolerance, notes, "
    "p.data_source AS vendor, p.file_name"
)
CHECK_JOIN = "FROM checks c JOIN stored p ON c.account_id = p.account_id AND c.as_of_date = p.as_of_date"
ACCOUNT_ROW = (
    "account_id, data_source AS vendor, file_name, as_of_date, "
    + dbl("beginning_market_value", "ending_market_value", "calculated_twrr", "vendor_twrr", "twrr_variance")
    + ", twrr_tolerance_check, CAST(net_flow AS DOUBLE) AS net_flow, reconciliation_status"
)
FILE_LIST = """SELECT file_name, data_source AS vendor, COUNT(*) AS record_count, MIN(created_at) AS processing_start,
  MAX(updated_at) AS last_updated, CASE
    WHEN COUNT(CASE WHEN reconciliation_status = 'COMPLETED' THEN 1 END) = COUNT(*) THEN 'COMPLETED'
    WHEN COUNT(CASE WHEN reconciliation_status = 'COMPLETED_WITH_ISSUES' THEN 1 END) > 0 THEN 'COMPLETED_WITH_ISSUES'
    ELSE 'PROCESSING' END AS overall_status
  FROM performance {where} GROUP BY file_name, data_source"""
LOG_STATUS = "CASE WHEN records_failed = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status"
ISSUE_ROW = ("period_id, account_id, as_of_date, issue_type, issue_description, field_name, expected_value, "
             "actual_value, severity")


def typed(c: str) -> str:
    if c == "as_of_date":
        return f"{DATE_OF_TEXT} AS as_of_date"
    if c in NUMERIC:
        kind = R if c in ("benchmark_return", "vendor_twrr") else M
        return f"CAST(TRY_CAST({c} AS {kind}) AS DOUBLE) AS {c}"
    return c


TYPED = ", ".join(typed(c) for c in STANDARD)


def windows(select: str, where: str, size: str) -> str:
    return sql(f"SELECT {select}, TIME_BUCKET(INTERVAL '{size}', ts) AS window_start FROM lines WHERE {where} "
               f"GROUP BY TIME_BUCKET(INTERVAL '{size}', ts)", "lines")


ERRORS_5M = windows("COUNT(*) AS error_count", "message LIKE '%ERROR%'", "5 minutes")
_N = "CAST(REGEXP_EXTRACT(message, 'processed (\\d+) records', 1) AS BIGINT)"
PERF_1H = windows(f"ROUND(AVG({_N}), 6) AS avg_records, MAX({_N}) AS max_records, MIN({_N}) AS min_records",
                  "message LIKE '%records processed%'", "1 hour")
RECON_1H = windows("COUNT(*) AS issue_count", "message LIKE '%tolerance%' OR message LIKE '%variance%'", "1 hour")
QUALITY_1H = windows("ROUND(AVG(CAST(REGEXP_EXTRACT(message, 'quality score: ([0-9.]+)', 1) AS DOUBLE)), 6) AS avg_score",
                     "message LIKE '%data quality%'", "1 hour")
METRICS = sql("""SELECT metric_name, TIME_BUCKET(INTERVAL '10 minutes', ts) AS window_start, COUNT(value) AS samples,
  CAST(SUM(value) AS DOUBLE) AS sum_value, ROUND(CAST(SUM(value) AS DOUBLE) / COUNT(value), 6) AS avg_value
  FROM points GROUP BY 1, 2""", "points")


def profile(columns: dict[str, str]) -> str:
    parts = []
    for name, kind in columns.items():
        if kind == "decimal":
            low, high, avg = (f"CAST(CAST(MIN({name}) AS {C}) AS VARCHAR)", f"CAST(CAST(MAX({name}) AS {C}) AS VARCHAR)",
                              f"ROUND(SUM(CAST({name} AS DOUBLE)) / COUNT({name}), 4)")
        else:
            low, high, avg = (f"MIN(CAST({name} AS VARCHAR))", f"MAX(CAST({name} AS VARCHAR))", "CAST(NULL AS DOUBLE)")
        parts.append(f"""SELECT '{name}' AS column_name, '{kind}' AS column_type, COUNT(*) AS total_records,
          ROUND((COUNT(*) - COUNT({name})) / CAST(COUNT(*) AS DOUBLE), 6) AS null_share,
          COUNT(DISTINCT {name}) AS distinct_values, {low} AS min_value, {high} AS max_value, {avg} AS mean_value
          FROM performance""")
    return sql(UNION.join(parts), "performance")


def missing(columns: list[str]) -> str:
    return sql(UNION.join(
        f"SELECT COUNT(*) AS total_records, '{c}' AS field_name, COUNT(*) - COUNT({c}) AS missing_count FROM performance"
        for c in columns), "performance")


ORACLE: dict[str, str] = {
    # ingest
    "flatten_vendor_c": sql(f"SELECT period_id, {', '.join(STANDARD)} FROM raw_text", "raw_text"),
    "perf_by_file": sql(f"""SELECT account_id, as_of_date, {dbl('beginning_market_value', 'ending_market_value',
      'contributions', 'distributions', 'income', 'appreciation', 'fees', 'other_adjustments', 'net_flow',
      'calculated_twrr', 'vendor_twrr', 'benchmark_return', 'twrr_variance', 'cumulative_net_flow')},
      ROUND(cumulative_twrr, 6) AS cumulative_twrr, twrr_tolerance_check FROM accumulated
      WHERE file_name = 'vendor_b_performance_1997.csv' AND data_source = 'vendor_b'""", "accumulated"),
    "status_update": sql("""SELECT period_id, file_name,
      CASE WHEN hit THEN 'COMPLETED_WITH_ISSUES' ELSE reconciliation_status END AS reconciliation_status,
      CASE WHEN hit THEN TIMESTAMP '2001-08-02 00:00:00' ELSE updated_at END AS updated_at
      FROM (SELECT *, file_name = 'vendor_a_performance_1998.csv' AND data_source = 'vendor_a' AS hit
        FROM performance)""", "performance"),
    "export_recon_report": sql(f"""SELECT c.account_id, c.as_of_date, field_name,
      {dbl('calculated_value', 'vendor_value', 'variance', 'tolerance_threshold')}, within_tolerance, notes,
      {dbl('beginning_market_value', 'ending_market_value', 'calculated_twrr', 'vendor_twrr')} {CHECK_JOIN}""",
      "checks"),
    "route_files": sql("SELECT * FROM routes", "routes"),
    "validate_format": sql("""SELECT *, CASE vendor
      WHEN 'vendor_a' THEN LOWER(SPLIT_PART(file_name, '.', 2)) = 'csv'
      WHEN 'vendor_b' THEN LOWER(SPLIT_PART(file_name, '.', 2)) IN ('xlsx', 'xls')
      ELSE LOWER(SPLIT_PART(file_name, '.', 2)) = 'json' END AS format_ok FROM routes""", "routes"),
    "ready_files": sql("SELECT * FROM arrivals WHERE file_key LIKE 'incoming/%' AND file_size > 0", "arrivals"),
    "unprocessed_files": sql("""SELECT * FROM routes WHERE file_key LIKE 'incoming/%' AND file_size > 0
      AND file_name NOT IN (SELECT 'vendorb_' || CAST(period_id AS VARCHAR) || '.csv' FROM performance
        WHERE reconciliation_status = 'COMPLETED')""", "routes", "performance"),
    "processing_log": sql(f"SELECT *, {LOG_STATUS} FROM log", "log"),
    "quarantine_split": sql("""SELECT period_id, issue_count,
      CASE WHEN issue_count = 0 THEN 'valid' ELSE 'quarantine' END AS destination FROM routed""", "routed"),
    "normalize_columns": sql(f"SELECT period_id, {', '.join(STANDARD)} FROM raw_text", "raw_text"),
    "cast_types": sql(f"SELECT period_id, {TYPED} FROM raw_text", "raw_text"),
    "parse_dates": sql(f"SELECT period_id, as_of_date AS date_text, {DATE_OF_TEXT} AS as_of_date FROM raw_text",
                       "raw_text"),
    "conform_schema": sql(f"""SELECT account_id, as_of_date, {dbl('beginning_market_value', 'ending_market_value',
      'contributions', 'distributions', 'income', 'appreciation', 'fees', 'other_adjustments')},
      CAST(flow AS DOUBLE) AS net_flow, CAST(SUM(flow) OVER w AS DOUBLE) AS cumulative_net_flow,
      CAST(fresh_twrr AS DOUBLE) AS calculated_twrr,
      {dbl('vendor_twrr', 'benchmark_return')}, ABS(fresh_twrr - vendor_twrr) <= 0.0001 AS twrr_tolerance_check,
      CAST(TRY_CAST(ABS(fresh_twrr - vendor_twrr) AS DECIMAL(12,8)) AS DOUBLE) AS twrr_variance, data_source,
      file_name, CAST(NULL AS VARCHAR) AS processed_by,
      created_at, updated_at, CAST(NULL AS VARCHAR) AS reconciliation_status
      FROM fresh WINDOW w AS (PARTITION BY account_id ORDER BY as_of_date, period_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "fresh"),
    "required_fields": sql("""SELECT period_id, account_id IS NOT NULL AND as_of_date IS NOT NULL
      AND beginning_market_value IS NOT NULL AND ending_market_value IS NOT NULL AS has_required_fields
      FROM performance""", "performance"),
    "union_vendors": sql(f"SELECT period_id, {TYPED}, data_source AS vendor FROM raw_text", "raw_text"),
    # filters and rows
    "recon_results": sql(f"SELECT {CHECK_ROW} {CHECK_JOIN}", "checks"),
    "recon_results_bucketed": sql(f"SELECT {CHECK_ROW} {CHECK_JOIN}", "checks"),
    "recon_results_filtered": sql(f"""SELECT {CHECK_ROW} {CHECK_JOIN} WHERE p.data_source = 'vendor_b'
      AND field_name = 'twrr' AND c.as_of_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""", "checks"),
    "recon_failures": sql(f"SELECT {CHECK_ROW} {CHECK_JOIN} WHERE within_tolerance = FALSE", "checks"),
    "account_search": sql(f"SELECT {ACCOUNT_ROW} FROM stored WHERE account_id ILIKE '%12%'", "stored"),
    "file_search": sql(FILE_LIST.format(where="WHERE LOWER(file_name) LIKE '%performance!_199%' ESCAPE '!'"),
                       "performance"),
    "recent_window": sql(f"""SELECT period_id, account_id, as_of_date, created_at FROM performance
      WHERE created_at >= {SINCE}""", "performance"),
    "variance_flags": sql("""SELECT account_id, as_of_date, field_name,
      CASE WHEN within_tolerance THEN 'PASS' ELSE 'FAIL' END AS status,
      COALESCE(variance > 0.001, FALSE) AS high_variance,
      COALESCE(ABS(variance) > 0.0001, FALSE) AS above_basis_point FROM checks""", "checks"),
    "history_series": sql(f"""SELECT account_id, as_of_date,
      CAST(COALESCE(ending_market_value, 0) AS DOUBLE) AS ending_mv,
      CAST(COALESCE(calculated_twrr, 0) * 100 AS DOUBLE) AS calculated_twrr,
      CAST(COALESCE(vendor_twrr, 0) * 100 AS DOUBLE) AS vendor_twrr,
      {rnd('cumulative_twrr * 100', 4)} AS cumulative_twrr,
      CAST(COALESCE(net_flow, 0) AS DOUBLE) AS net_flow
      FROM running WHERE as_of_date >= {AS_OF} - INTERVAL 1200 DAY""", "running"),
    "account_history": sql(f"""SELECT account_id, as_of_date, {dbl('beginning_market_value', 'ending_market_value',
      'net_flow', 'calculated_twrr', 'vendor_twrr', 'twrr_variance', 'cumulative_net_flow')},
      ROUND(cumulative_twrr, 6) AS cumulative_twrr, twrr_tolerance_check FROM accumulated
      WHERE as_of_date >= {AS_OF} - INTERVAL 1200 DAY""", "accumulated"),
    "accounts_page": sql(f"""SELECT {ACCOUNT_ROW}, {dbl('cumulative_net_flow')} FROM accumulated
      ORDER BY account_id, as_of_date DESC LIMIT 100 OFFSET 200""", "accumulated"),
    "file_sample": sql(f"""SELECT period_id, account_id, as_of_date, {dbl('beginning_market_value',
      'ending_market_value', 'calculated_twrr', 'vendor_twrr')} FROM stored
      WHERE file_name = 'vendor_c_performance_1996.csv' AND data_source = 'vendor_c'
      ORDER BY account_id, as_of_date LIMIT 10""", "stored"),
    "page_info": sql("""SELECT file_name, total, CAST(5 AS BIGINT) AS page, CAST(20 AS BIGINT) AS per_page,
      CAST(CEIL(total / 20.0) AS BIGINT) AS pages, CAST(80 AS BIGINT) AS row_offset, TRUE AS has_prev,
      5 < CEIL(total / 20.0) AS has_next, CAST(4 AS BIGINT) AS prev_num,
      CASE WHEN 5 < CEIL(total / 20.0) THEN CAST(6 AS BIGINT) END AS next_num
      FROM (SELECT file_name, COUNT(*) AS total FROM performance GROUP BY 1)""", "performance"),
    "sort_abs_variance": sql(f"""SELECT period_id, {dbl('twrr_variance')} FROM performance
      ORDER BY ABS(COALESCE(performance.twrr_variance, 0)) DESC, period_id""", "performance"),
    "format_values": sql("""SELECT period_id,
      '$' || FORMAT('{:,.2f}', CAST(ending_market_value AS DOUBLE)) AS ending_value_text,
      CAST(CAST(CAST(calculated_twrr AS DECIMAL(20,8)) * 100 AS DECIMAL(20,2)) AS VARCHAR) || '%' AS return_text,
      CAST(CAST(CAST(calculated_twrr AS DECIMAL(20,8)) * 10000 AS DECIMAL(20,1)) AS VARCHAR) || ' bps' AS return_bps_text
      FROM performance""", "performance"),
    # joins and keyed tables
    "performance_summary": sql(f"""SELECT p.account_id, account_name, portfolio_id, as_of_date,
      {dbl('beginning_market_value', 'ending_market_value', 'net_flow', 'calculated_twrr', 'vendor_twrr',
      'twrr_variance')}, twrr_tolerance_check, reconciliation_status, data_source
      FROM performance p JOIN accounts a ON p.account_id = a.account_id WHERE a.status = 'ACTIVE'""",
      "performance", "accounts"),
    "orphan_accounts": sql("""SELECT period_id, account_id, as_of_date FROM performance p
      WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = p.account_id)""", "performance", "accounts"),
    "insert_if_absent": sql("""SELECT account_id, account_name, CAST(0 AS BIGINT) AS seen_in FROM accounts
      UNION ALL SELECT account_id, 'Account ' || account_id, MIN(period_id) FROM records
      WHERE account_id NOT IN (SELECT account_id FROM accounts) GROUP BY account_id""", "records", "accounts"),
    "upsert_performance": sql(f"""SELECT period_id, account_id, as_of_date, data_source, {dbl('vendor_twrr')},
      updated_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id, as_of_date
        ORDER BY updated_at DESC, period_id DESC) AS rk FROM (
          SELECT period_id, account_id, as_of_date, data_source, vendor_twrr, updated_at FROM performance
          UNION ALL SELECT period_id, account_id, as_of_date, data_source,
            TRY_CAST(vendor_twrr + CAST(0.0001 AS {R}) AS {R}), updated_at + INTERVAL 2 DAY
          FROM performance WHERE data_source = 'vendor_c')) WHERE rk = 1""", "performance"),
    # returns and checks
    "cumulative_twrr": sql(f"""SELECT period_id, account_id, as_of_date, {dbl('calculated_twrr')},
      {rnd('cumulative_twrr')} AS cumulative_twrr FROM running""", "running"),
    "cumulative_twrr_log": sql(f"""SELECT period_id, account_id, as_of_date, {rnd('EXP(SUM(lg) OVER w) - 1')}
      AS cumulative_twrr FROM (SELECT *, CASE WHEN 1 + COALESCE(CAST(calculated_twrr AS DOUBLE), 0) > 0
        THEN LN(1 + COALESCE(CAST(calculated_twrr AS DOUBLE), 0)) ELSE 0 END AS lg FROM performance)
      WINDOW w AS (PARTITION BY account_id ORDER BY as_of_date, period_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "performance"),
    "cumulative_net_flow": sql(f"""SELECT period_id, account_id, as_of_date, {dbl('net_flow', 'cumulative_net_flow')}
      FROM running""", "running"),
    "financial_metrics": sql(f"""SELECT period_id, account_id, as_of_date, CAST(flow AS DOUBLE) AS net_flow,
      CAST(tw AS DOUBLE) AS calculated_twrr, CAST(ABS(tw - vendor_twrr) AS DOUBLE) AS twrr_variance,
      ABS(tw - vendor_twrr) <= 0.0001 AS twrr_tolerance_check, CAST(SUM(flow) OVER w AS DOUBLE) AS cumulative_net_flow,
      {rnd('PRODUCT(1 + COALESCE(CAST(tw AS DOUBLE), 0)) OVER w - 1')} AS cumulative_twrr
      FROM (SELECT *, {ret('beginning_market_value', 'ending_market_value', 'flow')} AS tw FROM records)
      WINDOW w AS (PARTITION BY account_id ORDER BY as_of_date, period_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "records"),
    "net_flow": sql("SELECT period_id, CAST(flow AS DOUBLE) AS net_flow FROM records", "records"),
    "twrr": sql(f"""SELECT period_id, CAST({ret('beginning_market_value', 'ending_market_value', 'flow')} AS DOUBLE)
      AS twrr FROM records""", "records"),
    "twrr_strict": sql(f"""SELECT period_id, CAST({ret('beginning_market_value', 'ending_market_value', 'flow',
      'beginning_market_value > 0 AND CAST(beginning_market_value AS DOUBLE) + CAST(flow AS DOUBLE) / 2 <> 0')}
      AS DOUBLE) AS twrr FROM records""", "records"),
    "twrr_tolerance": sql("""SELECT period_id, CAST(ABS(calculated_twrr - vendor_twrr) AS DOUBLE) AS twrr_variance,
      ABS(calculated_twrr - vendor_twrr) <= 0.0001 AS within,
      ABS(COALESCE(calculated_twrr, 0) - COALESCE(vendor_twrr, 0)) <= 0.0001 AS within_null_as_zero
      FROM performance""", "performance"),
    "mv_equation": sql("""SELECT period_id, CAST(g0 AS DOUBLE) AS gap_without_other, g0 <= 0.01 AS holds_without_other,
      CAST(g1 AS DOUBLE) AS gap, g1 <= 0.01 AS holds FROM (SELECT period_id,
        ABS(ending_market_value - (part - COALESCE(fees, 0))) AS g0,
        ABS(ending_market_value - (part - COALESCE(fees, 0) + COALESCE(other_adjustments, 0))) AS g1
        FROM (SELECT *, beginning_market_value + COALESCE(net_flow, 0) + COALESCE(income, 0)
          + COALESCE(appreciation, 0) AS part FROM performance))""", "performance"),
    "recon_mv": sql(f"SELECT {CHECK_COLS} FROM ({MV_CHECK})", "stored"),
    "recon_twrr": sql(f"SELECT {CHECK_COLS} FROM ({TWRR_CHECK})", "stored"),
    "recon_net_flow": sql(f"SELECT {CHECK_COLS} FROM ({FLOW_CHECK})", "stored"),
    "recon_long": sql(f"SELECT {CHECK_COLS} FROM checks", "checks"),
    "annualize": sql(f"""SELECT period_id, {rnd('POW(1 + CAST(calculated_twrr AS DOUBLE), 4) - 1')} AS annual_return
      FROM performance""", "performance"),
    "derive_on_write": sql(f"""SELECT period_id, CAST(flow AS DOUBLE) AS net_flow, CAST(tw AS DOUBLE) AS calculated_twrr,
      CAST(ABS(tw - vendor_twrr) AS DOUBLE) AS twrr_variance, ABS(tw - vendor_twrr) <= 0.0001 AS twrr_tolerance_check
      FROM (SELECT *, {ret('beginning_market_value', 'ending_market_value', 'flow',
      'beginning_market_value > 0 AND CAST(beginning_market_value AS DOUBLE) + CAST(flow AS DOUBLE) / 2 <> 0')} AS tw
      FROM records)""", "records"),
    # reconciliation
    "recon_report": sql("SELECT * FROM reports", "reports"),
    "recommendations": sql("""SELECT data_source, file_name,
      CAST(ROW_NUMBER() OVER (PARTITION BY data_source, file_name ORDER BY k) - 1 AS INTEGER) AS position, recommendation
      FROM (
        SELECT data_source, file_name, 1 AS k,
          'Low pass rate detected. Review calculation logic and data quality.' AS recommendation
          FROM reports WHERE passed_checks * 100.0 < 95 * total_checks
        UNION ALL SELECT data_source, file_name, 2, CAST(failed_checks AS VARCHAR)
          || ' reconciliation checks failed. Investigate tolerance thresholds and data accuracy.'
          FROM reports WHERE failed_checks > 0
        UNION ALL SELECT data_source, file_name, 4,
          'Data quality warnings detected. Consider additional validation rules.' FROM reports WHERE warning_count > 0
        UNION ALL SELECT data_source, file_name, 5,
          'All reconciliation checks passed. Data quality is acceptable.' FROM reports
          WHERE passed_checks * 100.0 >= 95 * total_checks AND failed_checks = 0 AND warning_count = 0)""", "reports"),
    "recon_rate_gate": sql("""SELECT data_source, file_name, pass_rate_percentage,
      CASE WHEN passed_checks * 100.0 > 95 * total_checks THEN 'COMPLETED' ELSE 'COMPLETED_WITH_ISSUES' END AS gate_status
      FROM totals""", "totals"),
    "failures_by_field": sql(f"""SELECT field_name, account_id, as_of_date,
      {dbl('calculated_value', 'vendor_value', 'variance')}, notes FROM checks
      WHERE NOT COALESCE(within_tolerance, FALSE)""", "checks"),
    "severity_counts": sql("""SELECT data_source, file_name, 'WARNING' AS severity, COUNT(*) AS issue_count
      FROM findings GROUP BY 1, 2""", "findings"),
    "portfolio_date_check": sql("""SELECT data_source, file_name, portfolio_id,
      'portfolio_date_consistency' AS validation_type, unique_dates, total_accounts, 'WARNING' AS severity
      FROM dates""", "dates"),
    "portfolio_outliers": sql(f"""SELECT data_source, file_name, portfolio_id, account_id, as_of_date,
      {dbl('calculated_twrr')}, {rnd('mean_twrr')} AS mean_twrr, {rnd('std_twrr')} AS std_twrr,
      'WARNING' AS severity FROM outliers""", "outliers"),
    "portfolio_outlier_summary": sql(f"""SELECT data_source, file_name, portfolio_id, COUNT(*) AS outlier_rows,
      {rnd('MAX(mean_twrr)')} AS mean_twrr, {rnd('MAX(std_twrr)')} AS std_twrr,
      'twrr_outlier_detection' AS validation_type, 'WARNING' AS severity FROM outliers GROUP BY 1, 2, 3""",
      "outliers"),
    "outliers_pop": sql(f"""SELECT p.portfolio_id, account_id, as_of_date, {dbl('calculated_twrr')},
      {rnd('m')} AS mean_twrr, {rnd('sd')} AS std_twrr FROM ported p JOIN (SELECT portfolio_id,
        {mean('calculated_twrr')} AS m, {deviation('calculated_twrr', 0)} AS sd FROM ported
        GROUP BY 1 HAVING COUNT(calculated_twrr) > 1) s ON p.portfolio_id = s.portfolio_id
      WHERE ABS(CAST(p.calculated_twrr AS DOUBLE) - m) > 2 * sd""", "ported"),
    "outliers_abs": sql(f"""SELECT period_id, account_id, as_of_date, {dbl('calculated_twrr')} FROM performance
      WHERE ABS(performance.calculated_twrr) > 0.1""", "performance"),
    "account_pass_rate": sql(f"""SELECT data_source, file_name, COUNT(*) AS total_accounts,
      COUNT(*) FILTER (WHERE twrr_tolerance_check) AS passed_tolerance,
      COUNT(*) - COUNT(*) FILTER (WHERE twrr_tolerance_check) AS failed_tolerance,
      {rate('COUNT(*) FILTER (WHERE twrr_tolerance_check)', 'COUNT(*)')} AS pass_rate,
      CASE WHEN COUNT(*) FILTER (WHERE twrr_tolerance_check) * 100.0 / COUNT(*) >= 95 THEN 'PASS' ELSE 'FAIL' END
      AS status FROM performance GROUP BY 1, 2""", "performance"),
    "check_matrix": sql("""SELECT account_id, twrr_check, mv_check, netflow_check,
      CAST(CAST(twrr_check AS INTEGER) + CAST(mv_check AS INTEGER) + CAST(netflow_check AS INTEGER) AS BIGINT)
      AS passed_checks FROM (SELECT account_id,
        BOOL_AND(COALESCE(within_tolerance, FALSE)) FILTER (WHERE field_name = 'twrr') AS twrr_check,
        BOOL_AND(COALESCE(within_tolerance, FALSE)) FILTER (WHERE field_name = 'ending_market_value') AS mv_check,
        BOOL_AND(COALESCE(within_tolerance, FALSE)) FILTER (WHERE field_name = 'net_flow') AS netflow_check
        FROM checks GROUP BY 1)""", "checks"),
    "pass_tier": sql(f"""SELECT file_name, UPPER(REPLACE(field_name, '_', ' ')) AS field, pass_rate_percentage,
      CASE WHEN pass_rate_percentage >= 98 THEN 'green' WHEN pass_rate_percentage >= 95 THEN 'amber' ELSE 'red' END AS tier,
      CASE WHEN pass_rate_percentage >= 95 THEN 'green' WHEN pass_rate_percentage >= 90 THEN 'amber' ELSE 'red' END
      AS loose_tier FROM (SELECT file_name, field_name,
        {rate('COUNT(*) FILTER (WHERE within_tolerance)', 'COUNT(*)')} AS pass_rate_percentage
        FROM checks GROUP BY 1, 2)""", "checks"),
    # reporting
    "recon_summary": sql(f"""SELECT *, UPPER(REPLACE(field_name, '_', ' ')) AS field_label,
      CASE WHEN pass_rate >= 95 THEN 'green' WHEN pass_rate >= 90 THEN 'amber' ELSE 'red' END AS tier
      FROM (SELECT field_name, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE within_tolerance) AS passed_checks,
      COUNT(*) FILTER (WHERE NOT within_tolerance) AS failed_checks, {rnd(mean('variance'))} AS avg_variance,
      CAST(MAX(variance) AS DOUBLE) AS max_variance,
      {rate('COUNT(*) FILTER (WHERE within_tolerance)', 'COUNT(*)')} AS pass_rate
      {CHECK_JOIN} WHERE reconciliation_date >= {SINCE} GROUP BY field_name)""", "checks"),
    "vendor_list": sql("""SELECT data_source AS vendor_name, COUNT(*) AS row_count,
      COUNT(DISTINCT file_name) AS file_count, MAX(created_at) AS last_processed FROM performance GROUP BY 1""",
      "performance"),
    "file_list": sql(FILE_LIST.format(where=""), "performance"),
    "file_details": sql(f"""SELECT file_name, data_source AS vendor, COUNT(*) AS total_records,
      COUNT(DISTINCT account_id) AS unique_accounts, MIN(as_of_date) AS earliest_date, MAX(as_of_date) AS latest_date,
      CAST(SUM(ending_market_value) AS DOUBLE) AS total_market_value, {rnd(mean('calculated_twrr'))} AS avg_twrr,
      COUNT(CASE WHEN twrr_tolerance_check = FALSE THEN 1 END) AS twrr_failures FROM performance GROUP BY 1, 2""",
      "performance"),
    "file_totals": sql(f"""SELECT COUNT(*) AS total_files, CAST(SUM(record_count) AS BIGINT) AS total_records,
      COUNT(*) FILTER (WHERE overall_status = 'COMPLETED') AS completed_files
      FROM ({FILE_LIST.format(where='')})""", "performance"),
    "dashboard_metrics": sql(f"""SELECT COUNT(DISTINCT file_name) AS total_files_processed,
      COUNT(DISTINCT data_source) AS total_vendors, COUNT(DISTINCT account_id) AS total_accounts,
      COUNT(*) AS total_records, CAST(SUM(ending_market_value) AS DOUBLE) AS total_aum,
      {rnd(mean('calculated_twrr'))} AS avg_twrr FROM performance WHERE created_at >= {SINCE}""", "performance"),
    "recon_overall": sql(f"""SELECT COUNT(*) AS total_recon_checks,
      COUNT(*) FILTER (WHERE within_tolerance) AS passed_checks,
      {rate('COUNT(*) FILTER (WHERE within_tolerance)', 'COUNT(*)')} AS overall_pass_rate
      FROM checks WHERE reconciliation_date >= {SINCE}""", "checks"),
    "daily_volume": sql(f"""SELECT CAST(created_at AS DATE) AS processing_date,
      COUNT(DISTINCT file_name) AS files_processed, COUNT(*) AS records_processed FROM performance
      WHERE created_at >= {SINCE} GROUP BY 1""", "performance"),
    "monthly_growth": sql(f"""SELECT CAST(DATE_TRUNC('month', created_at) AS DATE) AS month, COUNT(*) AS records
      FROM performance WHERE created_at >= {SINCE} GROUP BY 1""", "performance"),
    "dq_dashboard": sql(f"""SELECT CAST(created_at AS DATE) AS issue_date, issue_type, severity,
      COUNT(*) AS issue_count, COUNT(DISTINCT account_id) AS affected_accounts FROM issues
      WHERE created_at >= {SINCE} GROUP BY 1, 2, 3""", "issues"),
    "dq_daily": sql(f"""SELECT CAST(created_at AS DATE) AS date, severity, COUNT(*) AS issue_count FROM issues
      WHERE created_at >= {SINCE} GROUP BY 1, 2""", "issues"),
    "issue_type_stats": sql(f"""SELECT issue_type, COUNT(*) AS issue_count, {rnd(mean('v'))} AS avg_actual_value
      FROM (SELECT *, CASE WHEN REGEXP_MATCHES(actual_value, '^[0-9.]+$') THEN TRY_CAST(actual_value AS {C}) END AS v
      FROM issues) WHERE created_at >= {SINCE} GROUP BY 1""", "issues"),
    "recent_runs": sql(f"""SELECT file_name, vendor, {LOG_STATUS}, records_processed,
      DATEDIFF('second', processing_start_time, processing_end_time) AS duration_seconds, processing_start_time
      FROM log WHERE processing_start_time >= {SINCE}""", "log"),
    "weekly_report": sql(f"""SELECT CAST(DATE_TRUNC('week', processing_start_time) AS DATE) AS week_start, vendor,
      COUNT(*) AS files, CAST(SUM(records_processed) AS BIGINT) AS records_processed,
      ROUND(AVG(DATEDIFF('second', processing_start_time, processing_end_time)), 2) AS avg_duration_seconds,
      {rate('SUM(records_failed)', 'SUM(records_processed)')} AS error_rate FROM log GROUP BY 1, 2""", "log"),
    "file_tolerance_summary": sql(f"""SELECT file_name, COUNT(*) AS total_accounts,
      COUNT(*) FILTER (WHERE twrr_tolerance_check) AS passed_tolerance, {rnd(mean('twrr_variance'))} AS avg_variance
      FROM performance GROUP BY 1""", "performance"),
    "vendor_profile": sql(f"""SELECT data_source, COUNT(*) AS records, COUNT(DISTINCT account_id) AS accounts,
      MIN(as_of_date) AS first_date, MAX(as_of_date) AS last_date,
      CAST(SUM(ending_market_value) AS DOUBLE) AS total_market_value, {rnd(mean('vendor_twrr'))} AS avg_twrr,
      COUNT(*) - COUNT(income) AS missing_income_records,
      COUNT(*) FILTER (WHERE ABS(vendor_twrr) > 0.5) AS twrr_outliers FROM performance GROUP BY 1""", "performance"),
    # quality
    "missing_counts": missing(["account_id", "as_of_date", "beginning_market_value", "ending_market_value",
                               "contributions", "vendor_twrr"]),
    "profile_columns": profile({
        "account_id": "string", "as_of_date": "date", "beginning_market_value": "decimal",
        "contributions": "decimal", "vendor_twrr": "decimal", "twrr_tolerance_check": "boolean",
        "data_source": "string", "reconciliation_status": "string"}),
    "valid_counts": sql("""SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE beginning_market_value IS NOT NULL
      AND ending_market_value IS NOT NULL) AS valid_records FROM performance""", "performance"),
    "dq_rules": sql(f"SELECT {ISSUE_ROW} FROM ({UNION.join(RULES)})", "raw_text"),
    "dq_type_issues": sql(f"SELECT {ISSUE_ROW} FROM ({UNION.join(TYPES)})", "raw_text"),
    "dq_issues": sql("SELECT * FROM all_issues", "all_issues"),
    "issues_without_log": sql("""SELECT period_id, file_name, issue_type, severity FROM issues WHERE file_name NOT IN
      (SELECT file_name FROM log WHERE processing_start_time < TIMESTAMP '1999-01-01 00:00:00')""", "issues", "log"),
    "surrogate_ids": sql("""SELECT SHA256(account_id || '~' || CAST(as_of_date AS VARCHAR) || '~' || field_name) AS id,
      account_id, as_of_date, field_name FROM checks""", "checks"),
    "quality_rates": sql(f"""SELECT s.data_source, completeness_rate, validity_rate, accuracy_rate, consistency_rate,
      stored_good AND valid_good AS all_at_least_95 FROM (SELECT data_source,
        (COUNT(account_id) + COUNT(as_of_date) + COUNT(beginning_market_value) + COUNT(ending_market_value)) * 100.0
          >= 95 * COUNT(*) * 4
        AND COUNT(*) FILTER (WHERE twrr_tolerance_check) * 100.0 >= 95 * COUNT(twrr_tolerance_check)
        AND COUNT(*) FILTER (WHERE ABS(ending_market_value - (beginning_market_value + COALESCE(net_flow, 0)
          + COALESCE(income, 0) + COALESCE(appreciation, 0) - COALESCE(fees, 0) + COALESCE(other_adjustments, 0)))
          <= 0.01) * 100.0 >= 95 * COUNT(*) AS stored_good,
        {rate('(COUNT(account_id) + COUNT(as_of_date) + COUNT(beginning_market_value) + COUNT(ending_market_value))',
              '(COUNT(*) * 4)', 4)} AS completeness_rate,
        {rate('COUNT(*) FILTER (WHERE twrr_tolerance_check)', 'COUNT(twrr_tolerance_check)', 4)} AS accuracy_rate,
        {rate('''COUNT(*) FILTER (WHERE ABS(ending_market_value - (beginning_market_value + COALESCE(net_flow, 0)
          + COALESCE(income, 0) + COALESCE(appreciation, 0) - COALESCE(fees, 0) + COALESCE(other_adjustments, 0)))
          <= 0.01)''', 'COUNT(*)', 4)} AS consistency_rate FROM performance GROUP BY 1) s
      FULL JOIN (SELECT data_source, {rate('COUNT(*) FILTER (WHERE issue_count = 0)', 'COUNT(*)', 4)} AS validity_rate,
        COUNT(*) FILTER (WHERE issue_count = 0) * 100.0 >= 95 * COUNT(*) AS valid_good
        FROM routed GROUP BY 1) v ON s.data_source = v.data_source""", "performance", "routed"),
    "recompute_check": sql("SELECT * FROM recomputed", "recomputed"),
    "file_gate": sql("""SELECT data_source, file_name, CAST(q AS BIGINT) AS quality_level,
      CAST(r AS BIGINT) AS reconciliation_level, CAST(c AS BIGINT) AS calculation_level,
      CASE GREATEST(q, r, c) WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'WARNING' ELSE 'FAILED' END AS overall_status,
      CASE GREATEST(q, r, c) WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'COMPLETED_WITH_WARNINGS' ELSE 'FAILED' END
        AS database_status
      FROM (SELECT t.data_source, t.file_name, COALESCE(i.lv, 0) AS q,
        CASE WHEN t.overall_status = 'FAIL' THEN 1 WHEN t.warning_count > 0 THEN 1 ELSE 0 END AS r,
        CASE WHEN net_flow_mismatches + twrr_mismatches + cumulative_flow_mismatches + cumulative_twrr_mismatches > 0
          THEN 1 ELSE 0 END AS c
        FROM reports t JOIN recomputed x ON t.data_source = x.data_source AND t.file_name = x.file_name
        LEFT JOIN (SELECT data_source, file_name, MAX(CASE WHEN severity = 'HIGH' THEN 2 ELSE 1 END) AS lv
          FROM all_issues GROUP BY 1, 2) i ON t.data_source = i.data_source AND t.file_name = i.file_name)""",
      "reports", "recomputed", "all_issues"),
    # monitoring
    "kpi_metrics": sql(f"""SELECT 'ETL_Records_Processed' AS metric_name, CAST(COUNT(*) AS DOUBLE) AS metric_value
        FROM performance
      UNION ALL SELECT 'ETL_Records_Failed', CAST(COUNT(*) FILTER (WHERE beginning_market_value IS NULL
        OR ending_market_value IS NULL) AS DOUBLE) FROM performance
      UNION ALL SELECT 'TWRR_Reconciliation_Pass_Rate',
        {rate('COUNT(*) FILTER (WHERE twrr_tolerance_check)', 'COUNT(twrr_tolerance_check)', 4)} FROM performance
      UNION ALL SELECT 'Market_Value_Reconciliation_Variance', ROUND({mean('g')}, 6) FROM (
        SELECT ABS(ending_market_value - (beginning_market_value + COALESCE(net_flow, 0) + COALESCE(income, 0)
          + COALESCE(appreciation, 0) - COALESCE(fees, 0) + COALESCE(other_adjustments, 0))) AS g FROM performance)
      UNION ALL SELECT 'Data_Quality_Score', {rate('COUNT(*) FILTER (WHERE issue_count = 0)', 'COUNT(*)', 4)} FROM routed
      UNION ALL SELECT 'Pipeline_Execution_Duration',
        CAST(SUM(DATEDIFF('second', processing_start_time, processing_end_time)) AS DOUBLE) FROM log""",
      "performance", "routed", "log"),
    "alert_conditions": sql(f"""SELECT * FROM (
      SELECT file_name, 'processing_success_rate' AS metric_name, ok AS metric_value,
        CAST(95 AS DOUBLE) AS alert_limit, 'LOW_PROCESSING_SUCCESS_RATE' AS alert FROM k WHERE good * 100.0 < 95 * n
      UNION ALL SELECT file_name, 'error_rate_percent', bad, CAST(5 AS DOUBLE), 'HIGH_ERROR_RATE' FROM k WHERE (n - good) * 100.0 > 5 * n
      UNION ALL SELECT file_name, 'reconciliation_pass_rate', pass_rate_percentage, CAST(95 AS DOUBLE),
        'LOW_RECONCILIATION_PASS_RATE' FROM totals WHERE passed_checks * 100.0 < 95 * total_checks)""".replace("FROM k", f"""FROM (
        SELECT data_source, file_name,
        {rate('COUNT(*) FILTER (WHERE beginning_market_value IS NOT NULL AND ending_market_value IS NOT NULL)',
              'COUNT(*)')} AS ok,
        {rate('COUNT(*) FILTER (WHERE beginning_market_value IS NULL OR ending_market_value IS NULL)', 'COUNT(*)')}
        AS bad, COUNT(*) AS n,
        COUNT(*) FILTER (WHERE beginning_market_value IS NOT NULL AND ending_market_value IS NOT NULL) AS good
        FROM performance GROUP BY 1, 2) k"""), "performance", "totals"),
    "alarm_eval": sql("""SELECT metric_name, window_start, ROUND(metric_value, 6) AS metric_value, breach,
      CASE WHEN COUNT(*) OVER w = 2 AND MIN(CAST(breach AS INTEGER)) OVER w = 1 THEN 'ALARM' ELSE 'OK' END AS state
      FROM (SELECT s.metric_name, s.window_start, metric_value, COALESCE(metric_value > 20.0, FALSE) AS breach
        FROM (SELECT metric_name, UNNEST(GENERATE_SERIES(MIN(b), MAX(b), INTERVAL 1 HOUR)) AS window_start
          FROM (SELECT metric_name, TIME_BUCKET(INTERVAL '1 hour', ts) AS b FROM points) GROUP BY 1) s
        LEFT JOIN (SELECT metric_name, TIME_BUCKET(INTERVAL '1 hour', ts) AS b,
          ROUND(CAST(SUM(value) AS DOUBLE) / COUNT(value), 6) AS metric_value FROM points GROUP BY 1, 2) v
        ON s.metric_name = v.metric_name AND s.window_start = v.b)
      WINDOW w AS (PARTITION BY metric_name ORDER BY window_start ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""",
      "points"),
    "alarm_set": sql(f"""SELECT * FROM (WITH defs AS (SELECT * FROM (VALUES {', '.join(
        f"('{a}', '{m}', '{st}', {sec}, {n}, '{op}', CAST({lim} AS DOUBLE))" for a, m, st, sec, n, op, lim in WATCHED)})
        t(alarm, metric_name, statistic, seconds, periods, operator, lim)),
      f AS (SELECT alarm, metric_name, statistic, seconds, periods, operator, lim,
          CAST(FLOOR(EPOCH(ts)) AS BIGINT) - CAST(FLOOR(EPOCH(ts)) AS BIGINT) % seconds AS since,
          CASE WHEN statistic = 'Sum' THEN CAST(SUM(value) AS DOUBLE) ELSE CAST(SUM(value) AS DOUBLE) / COUNT(value) END AS v
        FROM points JOIN defs USING (metric_name) GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
      b AS (SELECT *, COALESCE(CASE operator WHEN '>' THEN v > lim WHEN '>=' THEN v >= lim WHEN '<' THEN v < lim
          ELSE v <= lim END, FALSE) AS breach FROM f)
      SELECT alarm, metric_name, MAKE_TIMESTAMP(since * 1000000) AS window_start, ROUND(v, 6) AS metric_value, breach,
        CASE WHEN COUNT(*) FILTER (WHERE breach) OVER (PARTITION BY alarm ORDER BY since
          RANGE BETWEEN (periods - 1) * seconds PRECEDING AND CURRENT ROW) = periods THEN 'ALARM' ELSE 'OK' END AS state
      FROM b)""", "points"),
    "metric_windows": METRICS,
    "log_errors_5m": ERRORS_5M,
    "log_perf_1h": PERF_1H,
    "log_recon_1h": RECON_1H,
    "log_quality_1h": QUALITY_1H,
    "recent_errors": sql("""SELECT * FROM lines WHERE message LIKE '%ERROR%' ORDER BY ts DESC, event_id DESC
      LIMIT 100""", "lines"),
    # streaming
    "stream_ingest": sql("SELECT part, n FROM load_parts", "load_parts"),
    "stream_closed_windows": sql("""SELECT * FROM (WITH e AS (SELECT event_type AS metric_name, ts,
        TIME_BUCKET(INTERVAL '10 minutes', ts) AS window_start, CAST(value AS DECIMAL(18,4)) AS v,
        ts < TIMESTAMP '2024-01-15 00:00:00' AND event_id % 50 <> 0 AS first FROM events),
      m AS (SELECT MAX(ts) FILTER (WHERE first) AS w1, MAX(ts) AS w2 FROM e),
      t AS (SELECT e.*, NOT first AND window_start + INTERVAL 10 MINUTE <= w1 AS late, w2 FROM e, m)
      SELECT metric_name, window_start, COUNT(*) FILTER (WHERE NOT late) AS n,
        CAST(SUM(v) FILTER (WHERE NOT late) AS DOUBLE) AS sum_value, COUNT(*) FILTER (WHERE late) AS late
      FROM t WHERE window_start + INTERVAL 10 MINUTE <= w2 GROUP BY 1, 2 HAVING COUNT(*) FILTER (WHERE NOT late) > 0)"""),
    "stream_log_errors_5m": ERRORS_5M,
    "stream_log_perf_1h": PERF_1H,
    "stream_log_recon_1h": RECON_1H,
    "stream_log_quality_1h": QUALITY_1H,
    "stream_metric_windows": METRICS,
    # load and store
    "load_file": sql("""SELECT part, n, 'vendor_a' AS data_source, 'vendor_a_all.csv' AS file_name, 'navrecon' AS processed_by,
      TIMESTAMP '2001-08-02 00:00:00' AS created_at, TIMESTAMP '2001-08-02 00:00:00' AS updated_at,
      'PENDING' AS reconciliation_status FROM load_parts""", "load_parts"),
    "load_two_files": sql(f"""SELECT account_id, day AS as_of_date, file_name, CAST(e AS DOUBLE) AS ending_market_value,
      CAST(SUM(flow) OVER w AS DOUBLE) AS cumulative_net_flow,
      {rnd('PRODUCT(1 + COALESCE(CAST(tw AS DOUBLE), 0)) OVER w - 1')} AS cumulative_twrr
      FROM (SELECT *, {ret('b', 'e', 'flow')} AS tw FROM loaded)
      WINDOW w AS (PARTITION BY account_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "loaded"),
    "dashboard_from_parts": sql(f"""SELECT COUNT(DISTINCT file_name) AS total_files_processed,
      CAST(1 AS BIGINT) AS total_vendors, COUNT(DISTINCT account_id) AS total_accounts, COUNT(*) AS total_records,
      CAST(SUM(e) AS DOUBLE) AS total_aum, {rnd(mean('tw'))} AS avg_twrr
      FROM (SELECT *, {ret('b', 'e', 'flow')} AS tw FROM loaded)""", "loaded"),
    "stored_recompute_check": sql("""SELECT 'vendor_a' AS data_source, 'vendor_a_all.csv' AS file_name,
      COUNT(DISTINCT (account_id, day)) AS rows_checked, CAST(0 AS BIGINT) AS net_flow_mismatches,
      CAST(0 AS BIGINT) AS twrr_mismatches, CAST(0 AS BIGINT) AS cumulative_flow_mismatches,
      CAST(0 AS BIGINT) AS cumulative_twrr_mismatches FROM load_rows WHERE reason IS NULL""", "load_rows"),
    "export_read_back": sql("""SELECT account_id, CAST(as_of_date AS VARCHAR) AS as_of_date, field_name,
      CAST(variance AS DOUBLE) AS variance, CAST(within_tolerance AS VARCHAR) AS within_tolerance, TRUE AS in_order
      FROM checks""", "checks"),
    "load_issues": sql("""SELECT issue_type, severity, COUNT(*) AS n FROM issues GROUP BY 1, 2
      UNION ALL SELECT 'duplicate_key', 'MEDIUM', n FROM load_parts WHERE part = 'duplicate_key'""",
      "issues", "load_parts"),
    "load_twice": sql("""SELECT account_id, day AS as_of_date, CAST(1 AS BIGINT) AS n,
      CAST(MAX(CAST(ending_market_value AS DECIMAL(18,2))) AS DOUBLE) AS ending_market_value
      FROM load_rows WHERE reason IS NULL GROUP BY 1, 2""", "load_rows"),
    "load_log": sql("""SELECT 'vendor_a_all.csv' AS file_name, COUNT(*) AS records_processed,
      CAST(0 AS BIGINT) AS records_inserted, COUNT(DISTINCT CASE WHEN reason IS NULL THEN (account_id, day) END) AS records_updated,
      COUNT(*) - COUNT(DISTINCT CASE WHEN reason IS NULL THEN (account_id, day) END) AS records_failed,
      'COMPLETED_WITH_WARNINGS' AS status FROM load_rows
      UNION ALL SELECT 'vendor_a_bad.csv', COUNT(*), 0, 0, COUNT(*), 'COMPLETED_WITH_WARNINGS' FROM load_rows""",
      "load_rows"),
    "reconcile_flow": sql("""SELECT r.file_name, r.total_checks, r.passed_checks, r.overall_status,
      r.total_checks AS saved_checks, r.reconciliation_status, s.n AS stored_rows
      FROM reports r JOIN (SELECT file_name, COUNT(*) AS n FROM stored GROUP BY 1) s ON r.file_name = s.file_name
      WHERE r.file_name = 'vendor_a_performance_1997.csv'""", "reports", "stored"),
    "csv_scan": sql("""SELECT period_id,
      CASE WHEN period_id % 3 < 2 THEN TRY_CAST(beginning_market_value AS DOUBLE) END AS beginning_market_value,
      CASE WHEN period_id % 9 <> 2 THEN TRY_CAST(ending_market_value AS DOUBLE) END AS ending_market_value,
      CASE WHEN period_id % 3 < 2 THEN CAST(fees AS DOUBLE) END AS fees,
      CASE period_id % 9 WHEN 2 THEN CAST(period_id AS VARCHAR) || ',' || account_id
        WHEN 5 THEN CAST(period_id AS VARCHAR) || ',' || account_id || ',' || COALESCE(ending_market_value, '') || ',more' END
        AS raw_line FROM raw_text""", "raw_text"),
    "list_arrivals": """SELECT * FROM (VALUES ('va_100.csv', 'vendor_a', TRUE), ('vb_a+b.csv', 'vendor_b', TRUE),
      ('vc_a b.csv', 'vendor_c', TRUE)) t(file_name, vendor, has_content)
      WHERE (SELECT COUNT(DISTINCT o_orderkey % 3) FROM orders) = 3""",
    "partitioned_store": sql(f"""SELECT account_id, as_of_date, {dbl('ending_market_value')} FROM stored
      WHERE as_of_date BETWEEN DATE '1995-02-10' AND DATE '1996-03-05'""", "stored"),
    "upsert_on_disk": sql("""SELECT account_id, as_of_date,
      CAST(CASE WHEN MONTH(as_of_date) % 2 > 0 THEN fees ELSE 0 END AS DOUBLE) AS fees FROM stored""", "stored"),
    "status_on_disk": sql("""SELECT file_name, CASE WHEN file_name = 'vendor_a_performance_1998.csv'
      THEN 'COMPLETED_WITH_ISSUES' ELSE reconciliation_status END AS reconciliation_status, COUNT(*) AS n
      FROM stored GROUP BY 1, 2""", "stored"),
    "column_defaults": sql("""SELECT period_id, CAST(COALESCE(contributions, 0) AS DOUBLE) AS contributions,
      CAST(COALESCE(distributions, 0) AS DOUBLE) AS distributions,
      CAST(COALESCE(other_adjustments, 0) AS DOUBLE) AS other_adjustments,
      CASE WHEN period_id % 2 = 0 THEN reconciliation_status ELSE 'PENDING' END AS reconciliation_status
      FROM performance""", "performance"),
    "matrix_rate": sql(f"""SELECT COUNT(*) AS total_accounts, COUNT(*) * 3 AS total_checks,
      CAST(SUM(ok) AS BIGINT) AS passed_checks, {rate('SUM(ok)', '(COUNT(*) * 3)')} AS pass_rate
      FROM (SELECT account_id, SUM(good) AS ok FROM (SELECT account_id, field_name,
        MIN(CASE WHEN within_tolerance THEN 1 ELSE 0 END) AS good FROM checks
        WHERE field_name IN ('twrr', 'ending_market_value', 'net_flow') GROUP BY 1, 2) GROUP BY 1)""", "checks"),
    "next_page": sql("""SELECT account_id, as_of_date, file_name FROM stored
      WHERE account_id > '2' OR account_id = '2' AND as_of_date < DATE '1996-01-01'
      ORDER BY account_id, as_of_date DESC LIMIT 50""", "stored"),
    "json_scan": sql("""SELECT account_id, as_of_date, COUNT(*) AS n,
      MAX(TRY_CAST(ending_market_value AS DOUBLE)) AS ending_market_value FROM raw_text GROUP BY 1, 2""", "raw_text"),
    "vendor_config": sql("""SELECT account_id, as_of_date, CAST(MAX(ending_market_value) AS DOUBLE) AS ending_market_value
      FROM records GROUP BY 1, 2""", "records"),
    "schema_issues": sql("""SELECT field_name, expected_value, actual_value, rows_seen FROM (VALUES
      ('as_of_date', 'string', 'date'), ('period_id', 'int', 'bigint'), ('no_such', 'date', 'missing'))
      t(field_name, expected_value, actual_value), (SELECT COUNT(*) AS rows_seen FROM stored)""", "stored"),
    "sql_functions": sql(f"""SELECT period_id, CAST(flow AS DOUBLE) AS net_flow, CAST({ret('beginning_market_value',
      'ending_market_value', 'flow', 'beginning_market_value > 0 AND CAST(beginning_market_value AS DOUBLE) + CAST(flow AS DOUBLE) / 2 <> 0')}
      AS DOUBLE) AS twrr FROM records""", "records"),
}
ORACLE["stream_alarm_set"] = ORACLE["alarm_set"]
