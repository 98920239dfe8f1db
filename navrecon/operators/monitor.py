"""Log windows, metric windows, alarms, KPIs and alerts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navrecon.functions.checks import value_equation_gap
from navrecon.operators.quality import has_required
from navrecon.schemas import ALERTS


def bins(size: str, ts: str = "ts") -> Column:
    return F.window(ts, size)


def window_parts(lines: DataFrame, size: str, value: Column | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Additive facts of each window: rows, values, their sum, smallest and largest.

    Parts of the same window from several batches add up (merge_parts), in any order.
    """
    value = F.lit(None).cast("double") if value is None else value
    return (
        lines.select(*by, bins(size).alias("_bin"), value.alias("_value")).groupBy(*by, "_bin")
        .agg(F.count("*").alias("n"), F.count("_value").alias("samples"), F.sum("_value").alias("total"),
             F.min("_value").alias("low"), F.max("_value").alias("high"))
        .withColumn("window_start", F.col("_bin.start")).drop("_bin")
    )


def merge_parts(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return parts.groupBy(*by, "window_start").agg(
        F.sum("n").alias("n"), F.sum("samples").alias("samples"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def _mean() -> Column:
    return F.round(F.try_divide(F.col("total").cast("double"), F.col("samples")), 6)


def error_parts(lines: DataFrame) -> DataFrame:
    return window_parts(lines.where(F.col("message").rlike("ERROR")), "5 minutes")


def error_counts(parts: DataFrame) -> DataFrame:
    return parts.select("window_start", F.col("n").alias("error_count"))


def errors_per_5_minutes(lines: DataFrame) -> DataFrame:
    return error_counts(error_parts(lines))


def processed_parts(lines: DataFrame) -> DataFrame:
    count = F.regexp_extract("message", r"processed (\d+) records", 1).try_cast("long")
    return window_parts(lines.where(F.contains("message", F.lit("records processed"))), "1 hour", count)


def processed_facts(parts: DataFrame) -> DataFrame:
    return parts.select("window_start", _mean().alias("avg_records"), F.col("high").alias("max_records"),
                        F.col("low").alias("min_records"))


def processed_per_hour(lines: DataFrame) -> DataFrame:
    """Average, largest and smallest count named in 'processed N records'."""
    return processed_facts(processed_parts(lines))


def recon_parts(lines: DataFrame) -> DataFrame:
    return window_parts(lines.where(F.col("message").rlike("tolerance|variance")), "1 hour")


def recon_counts(parts: DataFrame) -> DataFrame:
    return parts.select("window_start", F.col("n").alias("issue_count"))


def recon_messages_per_hour(lines: DataFrame) -> DataFrame:
    return recon_counts(recon_parts(lines))


def quality_parts(lines: DataFrame) -> DataFrame:
    score = F.regexp_extract("message", r"quality score: ([0-9.]+)", 1).try_cast("double")
    return window_parts(lines.where(F.contains("message", F.lit("data quality"))), "1 hour", score)


def quality_scores(parts: DataFrame) -> DataFrame:
    return parts.select("window_start", _mean().alias("avg_score"))


def quality_score_per_hour(lines: DataFrame) -> DataFrame:
    return quality_scores(quality_parts(lines))


def recent_errors(lines: DataFrame, size: int = 100) -> DataFrame:
    return lines.where(F.col("message").rlike("ERROR")).orderBy(F.desc("ts"), F.desc("event_id")).limit(size)


def metric_parts(points: DataFrame, seconds: int) -> DataFrame:
    return window_parts(points, f"{seconds} seconds", F.col("value"), ("metric_name",))


def metric_facts(parts: DataFrame) -> DataFrame:
    return parts.select("metric_name", "window_start", "samples", F.col("total").alias("sum_value"),
                        _mean().alias("avg_value"))


def metric_windows(points: DataFrame, seconds: int) -> DataFrame:
    """Sum and average of every metric per period."""
    return metric_facts(metric_parts(points, seconds))


_COMPARE = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def evaluate_alarm(
    points: DataFrame, statistic: str, seconds: int, periods: int, operator: str, threshold: float
) -> DataFrame:
    """ALARM in a period when it and the periods before it, `periods` in all, breach.

    Samples are folded per period first. A dense line of periods is laid from
    the first to the last sample of each metric; an empty period does not breach.
    The window therefore runs over periods, never over samples.
    """
    value = F.col("sum_value") if statistic == "Sum" else F.col("avg_value")
    folded = metric_windows(points, seconds).withColumn("metric_value", value.cast("double"))
    step = F.expr(f"INTERVAL {int(seconds)} SECONDS")
    line = (
        folded.groupBy("metric_name")
        .agg(F.min("window_start").alias("_from"), F.max("window_start").alias("_to"))
        .select("metric_name", F.explode(F.sequence("_from", "_to", step)).alias("window_start"))
    )
    dense = line.join(
        folded.select("metric_name", "window_start", "metric_value"), ["metric_name", "window_start"], "left"
    )
    breach = F.coalesce(_COMPARE[operator](F.col("metric_value"), F.lit(float(threshold))), F.lit(False))
    recent = Window.partitionBy("metric_name").orderBy("window_start").rowsBetween(-(periods - 1), 0)
    state = (F.count("*").over(recent) == periods) & F.min("_breach").over(recent)
    return dense.withColumn("_breach", breach).select(
        "metric_name", "window_start", F.round("metric_value", 6).alias("metric_value"),
        F.col("_breach").alias("breach"), F.when(state, "ALARM").otherwise("OK").alias("state"),
    )


def alarm_table(spark: SparkSession, alarms: list[tuple]) -> DataFrame:
    """Alarm definitions: a fixed handful of rows."""
    return spark.createDataFrame(alarms, (
        "alarm string, metric_name string, statistic string, seconds int, periods int, operator string, limit double"))


ALARM_KEYS = ("alarm", "metric_name", "statistic", "seconds", "periods", "operator", "limit")


def alarm_parts(points: DataFrame, definitions: DataFrame) -> DataFrame:
    """Sum and number of the samples of each alarm and period: parts of several batches add up."""
    named = points.join(F.broadcast(definitions), "metric_name")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    return named.groupBy(*ALARM_KEYS, (at - at % F.col("seconds")).alias("_at")).agg(
        F.sum("value").alias("_sum"), F.count("value").alias("_n"))


def merge_alarm_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*ALARM_KEYS, "_at").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))


def alarm_runs(folded: DataFrame, day: int = 86_400) -> DataFrame:
    """The state of each folded period: how many breaching periods without a gap end with it.

    Runs are found in windows of one alarm and day, to which the last periods of the day
    before are carried, so no window covers more than that.
    """
    value = F.when(F.col("statistic") == "Sum", F.col("_sum").cast("double")).otherwise(
        F.try_divide(F.col("_sum").cast("double"), F.col("_n")))
    breach = F.lit(False)
    for sign, compare in _COMPARE.items():
        breach = F.when(F.col("operator") == sign, compare(F.col("_value"), F.col("limit"))).otherwise(breach)
    told = folded.withColumn("_value", value).withColumn("breach", F.coalesce(breach, F.lit(False)))
    last = F.col("_at") + (F.col("periods") - 1) * F.col("seconds")
    carried = told.withColumn("_day", F.explode(F.sequence(F.floor(F.col("_at") / day), F.floor(last / day))))
    order = Window.partitionBy("alarm", "metric_name", "_day").orderBy("_at")
    # Of the breaching periods that follow each other without a gap, this one's place.
    gap = F.coalesce(F.col("_at") - F.lag("_at").over(order) != F.col("seconds"), F.lit(True)) | ~F.col("breach")
    run = carried.withColumn("_start", F.max(F.when(gap, F.when(
        F.col("breach"), F.col("_at")).otherwise(F.col("_at") + F.col("seconds")))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    length = (F.col("_at") - F.col("_start")) / F.col("seconds") + 1
    return run.where(F.col("_day") == F.floor(F.col("_at") / day)).select(
        "alarm", "metric_name", F.timestamp_seconds("_at").cast("timestamp_ntz").alias("window_start"),
        F.round("_value", 6).alias("metric_value"), "breach",
        F.when(F.col("breach") & (length >= F.col("periods")), "ALARM").otherwise("OK").alias("state"))


def alarm_states(points: DataFrame, definitions: DataFrame, day: int = 86_400) -> DataFrame:
    """(alarm, metric_name, window_start, metric_value, breach, state) of every alarm and period that has samples.

    An alarm is raised when its period and the ones before it, `periods` in all,
    breach; a period without samples does not. Each definition has its own statistic,
    period length and comparison. Samples are folded per period first.
    """
    return alarm_runs(alarm_parts(points, definitions), day)


def kpi_metrics(performance: DataFrame, routed: DataFrame, log: DataFrame) -> DataFrame:
    """Published metrics in long form, each from one global pass."""
    rows = performance.agg(
        F.count("*").cast("double").alias("ETL_Records_Processed"),
        F.count_if(~has_required()).cast("double").alias("ETL_Records_Failed"),
        F.round(F.try_divide(F.count_if("twrr_tolerance_check") * F.lit(100.0), F.count("twrr_tolerance_check")), 4)
        .alias("TWRR_Reconciliation_Pass_Rate"),
        F.round(F.try_divide(F.sum(value_equation_gap()).cast("double"), F.count(value_equation_gap())), 6)
        .alias("Market_Value_Reconciliation_Variance"),
    )
    score = routed.agg(
        F.round(F.try_divide(F.count_if(F.col("issue_count") == 0) * F.lit(100.0), F.count("*")), 4)
        .alias("Data_Quality_Score")
    )
    seconds = F.timestamp_diff("SECOND", F.col("processing_start_time"), F.col("processing_end_time"))
    runs = log.agg(F.sum(seconds).cast("double").alias("Pipeline_Execution_Duration"))

    def long(wide: DataFrame) -> DataFrame:
        return wide.unpivot([], wide.columns, "metric_name", "metric_value")

    return long(rows).unionByName(long(score)).unionByName(long(runs))


def file_kpis(performance: DataFrame, totals: DataFrame) -> DataFrame:
    """Success, error and pass rates of every file in long form, not rounded: limits are compared with them."""
    key = ["data_source", "file_name"]
    good = F.count_if(has_required()) * F.lit(100.0)
    wide = performance.groupBy(*key).agg(
        (good / F.count("*")).alias("processing_success_rate"),
        ((F.count("*") * F.lit(100.0) - good) / F.count("*")).alias("error_rate_percent"),
    )
    passed = F.try_divide(F.col("passed_checks") * F.lit(100.0), F.col("total_checks"))
    # A file on one side only keeps its own rates; names may be null.
    theirs = totals.select(*[F.col(k).alias(f"_{k}") for k in key], passed.alias("reconciliation_pass_rate"))
    same = reduce(and_, [wide[k].eqNullSafe(theirs[f"_{k}"]) for k in key])
    wide = wide.join(theirs, same, "full").select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in key], "processing_success_rate", "error_rate_percent",
        "reconciliation_pass_rate")
    rates = ["processing_success_rate", "error_rate_percent", "reconciliation_pass_rate"]
    return wide.unpivot(key, rates, "metric_name", "metric_value")


def threshold_table(spark: SparkSession) -> DataFrame:
    """The alert limits: a fixed handful of rows."""
    return spark.createDataFrame(ALERTS, "metric_name string, comparison string, alert_limit double, alert string")


def alert_conditions(kpis: DataFrame, thresholds: DataFrame) -> DataFrame:
    """KPI values that break their limit, rounded only for display. Thresholds are a constant table."""
    low = (F.col("comparison") == "<") & (F.col("metric_value") < F.col("alert_limit"))
    high = (F.col("comparison") == ">") & (F.col("metric_value") > F.col("alert_limit"))
    found = kpis.join(F.broadcast(thresholds), "metric_name").where(low | high)
    return found.withColumn("metric_value", F.round("metric_value", 2))
