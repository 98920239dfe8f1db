import datetime as dt
import random

import pytest
from navrecon.operators import monitor
from navrecon.schemas import ALARMS

START = dt.datetime(2024, 1, 1)


def points(spark, values):
    rows = [("m", START + dt.timedelta(seconds=300 * i + 7), float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "metric_name string, ts timestamp_ntz, value double")


def brute(values, periods, breach):
    flags = [v is not None and breach(v) for v in values]
    return ["ALARM" if i + 1 >= periods and all(flags[i - periods + 1:i + 1]) else "OK" for i in range(len(flags))]


@pytest.mark.parametrize("periods", [1, 2, 3])
@pytest.mark.parametrize("operator, breach", [(">", lambda v: v > 3), (">=", lambda v: v >= 3), ("<", lambda v: v < 3)])
def test_alarm_states(spark, periods, operator, breach):
    rng = random.Random(periods)
    values = [5, *[rng.choice([None, 1, 3, 5, 5]) for _ in range(60)], 5]
    out = monitor.evaluate_alarm(points(spark, values), "Sum", 300, periods, operator, 3).orderBy("window_start").collect()
    assert [r.state for r in out] == brute(values, periods, breach)


def test_every_alarm_definition_runs(spark):
    for _, _, statistic, seconds, periods, operator, threshold in ALARMS:
        got = monitor.evaluate_alarm(points(spark, [1, 2]), statistic, seconds, periods, operator, threshold)
        assert got.count() >= 1


def test_log_windows(spark):
    text = ["ERROR one", "records processed: processed 40 records", "records processed: processed 60 records",
            "variance 2", "outside tolerance", "data quality check, quality score: 87.5"]
    lines = spark.createDataFrame(
        [(i, START + dt.timedelta(minutes=i), m) for i, m in enumerate(text)], "event_id long, ts timestamp_ntz, message string")
    assert monitor.errors_per_5_minutes(lines).first().error_count == 1
    row = monitor.processed_per_hour(lines).first()
    assert (row.avg_records, row.max_records, row.min_records) == (50.0, 60, 40)
    assert monitor.recon_messages_per_hour(lines).first().issue_count == 2
    assert monitor.quality_score_per_hour(lines).first().avg_score == 87.5
    assert monitor.recent_errors(lines).count() == 1


def test_alerts(spark):
    limits = monitor.threshold_table(spark)
    healthy = spark.createDataFrame([
        ("processing_success_rate", 99.5), ("reconciliation_pass_rate", 98.7), ("error_rate_percent", 0.5),
        ("lambda_duration_ms", 4500.0), ("rds_cpu_utilization", 45.0)], "metric_name string, metric_value double")
    assert monitor.alert_conditions(healthy, limits).count() == 0
    ill = spark.createDataFrame([("processing_success_rate", 94.9), ("error_rate_percent", 5.1)], healthy.schema)
    assert {r.alert for r in monitor.alert_conditions(ill, limits).collect()} == {
        "LOW_PROCESSING_SUCCESS_RATE", "HIGH_ERROR_RATE"}
