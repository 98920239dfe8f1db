"""The performance data model projected from the order tables used for testing.

Deterministic, so a SQL engine can repeat it. Modulo rules below only plant the
defects the checks must find; every record is kept. The functions keep the plans
they built (never data), so a query that uses a table twice builds it once.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navrecon.functions.checks import twrr_variance, twrr_within
from navrecon.functions.finance import net_flow, or_zero, period_return
from navrecon.schemas import COMPLETED, MONEY, PENDING, RATE, WITH_ISSUES

#: Every so many-th record belongs to an account that no table knows: its number is raised.
ORPHANS, UNKNOWN = 53, 1_000_000_000


@lru_cache(maxsize=16)
def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _money(value: Column) -> Column:
    return value.cast(MONEY)


def _hundredths(name: str) -> Column:
    """A two-decimal double as a whole number of hundredths: exact to add up,
    and much cheaper per line than a decimal."""
    return F.floor(F.col(name) * 100 + 0.5)


def _shifted(value: Column) -> Column:
    """A whole number of ten-thousandths as money."""
    return _money(value.cast("decimal(20,0)") * F.lit("0.0001").cast("decimal(4,4)"))


def _every(n: int, key: str = "period_id") -> Column:
    return F.col(key) % n == 0


@lru_cache(maxsize=16)
def records(spark: SparkSession, folder: str) -> DataFrame:
    """Vendor records: one per order, money from its lines, with file lineage."""
    price = _hundredths("l_extendedprice")

    def amount(condition: Column) -> Column:
        return F.sum(F.when(condition, price))

    lines = (
        _table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            amount(F.col("l_returnflag") == "A").alias("a_amt"),
            amount(F.col("l_returnflag") == "R").alias("r_amt"),
            amount(F.col("l_linestatus") == "O").alias("o_amt"),
            F.sum(price * _hundredths("l_discount")).alias("disc_amt"),
            F.sum(price * _hundredths("l_tax")).alias("tax_amt"),
        )
    )
    vendor = (
        F.when(_every(3), "vendor_a").when(F.col("period_id") % 3 == 1, "vendor_b").otherwise("vendor_c")
    )
    base = (
        _table(spark, folder, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("period_id"),
            F.when(F.col("o_orderkey") % ORPHANS == 0, F.col("o_custkey") + UNKNOWN)
            .otherwise(F.col("o_custkey")).cast("string").alias("account_id"),
            F.col("o_orderdate").cast("date").alias("as_of_date"),
            F.when(F.col("o_orderkey") % 97 != 0, _money(F.col("o_totalprice"))).alias("beginning_market_value"),
            _shifted(F.col("a_amt") * 5).alias("contributions"),
            _shifted(F.col("r_amt") * 5).alias("distributions"),
            _shifted(F.col("tax_amt")).alias("income"),
            _shifted(F.col("o_amt")).alias("appreciation"),
            _shifted(F.col("disc_amt")).alias("fees"),
            F.when(F.col("o_orderkey") % 17 == 0, F.lit("1.25").cast(MONEY)).alias("other_adjustments"),
        )
    )
    flow = net_flow("contributions", "distributions")
    planted = F.when(_every(13), F.lit("0.02").cast(MONEY)).otherwise(F.lit(0).cast(MONEY))
    ending = _money(
        F.col("beginning_market_value") + flow + or_zero("income") + or_zero("appreciation")
        - or_zero("fees") + or_zero("other_adjustments") + planted
    )
    drift = ((F.col("period_id") % 5 - 2) * F.lit("0.00006").cast(RATE)).cast(RATE)
    created = F.col("as_of_date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return (
        base.withColumn("ending_market_value", ending)
        .withColumn("_twrr", period_return("beginning_market_value", "ending_market_value", flow))
        .withColumns({
            "benchmark_return": ((F.col("period_id") % 21 - 10) * F.lit("0.001").cast("decimal(4,3)")).cast(RATE),
            "vendor_twrr": F.when(~_every(11), (F.col("_twrr") + drift).try_cast(RATE)),
            "data_source": vendor,
            "file_name": F.concat(vendor, F.lit("_performance_"), F.year("as_of_date").cast("string"), F.lit(".csv")),
            "created_at": created,
            "updated_at": created + F.make_dt_interval(hours=(F.col("period_id") % 24).cast("int")),
        })
        .drop("_twrr")
    )


@lru_cache(maxsize=16)
def performance(spark: SparkSession, folder: str) -> DataFrame:
    """Stored rows: records plus derived columns; every 19th flow is stored wrong."""
    status = (
        F.when(_every(7), WITH_ISSUES).when(_every(5), PENDING).otherwise(COMPLETED)
    )
    slip = F.when(_every(19), F.lit("0.05").cast(MONEY)).otherwise(F.lit(0).cast(MONEY))
    return (
        records(spark, folder)
        .withColumn("net_flow", _money(net_flow("contributions", "distributions") + slip))
        .withColumn("calculated_twrr", period_return("beginning_market_value", "ending_market_value", "net_flow"))
        .withColumns({
            "twrr_variance": twrr_variance("calculated_twrr", "vendor_twrr"),
            "twrr_tolerance_check": twrr_within("calculated_twrr", "vendor_twrr"),
            "reconciliation_status": status,
        })
    )


@lru_cache(maxsize=16)
def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Account dimension: every customer; every 10th account is inactive. Records whose
    account number was raised by UNKNOWN are orphans."""
    return (
        _table(spark, folder, "customer")
        .select(
            F.col("c_custkey").cast("string").alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.col("c_nationkey").cast("string").alias("portfolio_id"),
            F.concat(F.lit("CL"), F.col("c_nationkey").cast("string")).alias("client_id"),
            F.col("c_mktsegment").alias("account_type"),
            F.lit(None).cast("date").alias("inception_date"),
            F.when(F.col("c_custkey") % 10 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        )
    )


@lru_cache(maxsize=16)
def raw_text(spark: SparkSession, folder: str) -> DataFrame:
    """The records as a vendor would send them: all text, with planted bad values."""
    text = {name: F.col(name).cast("string") for name in (
        "contributions", "distributions", "income", "appreciation", "fees",
        "other_adjustments", "benchmark_return", "vendor_twrr")}
    day = (
        F.when(F.col("period_id") % 4 == 1, F.date_format("as_of_date", "MM/dd/yyyy"))
        .when(F.col("period_id") % 4 == 2, F.date_format("as_of_date", "yyyy/MM/dd"))
        .otherwise(F.col("as_of_date").cast("string"))
    )
    return records(spark, folder).select(
        "period_id",
        F.when(_every(29), "").otherwise(F.col("account_id")).alias("account_id"),
        F.concat(F.lit("Account "), F.col("account_id")).alias("account_name"),
        F.concat(F.lit("P"), (F.col("account_id").cast("long") % 25).cast("string")).alias("portfolio_id"),
        F.when(_every(41), "n/a").otherwise(day).alias("as_of_date"),
        F.when(_every(43), F.concat(F.lit("-"), F.col("beginning_market_value").cast("string")))
        .otherwise(F.col("beginning_market_value").cast("string")).alias("beginning_market_value"),
        F.when(_every(23), "invalid")
        .when(_every(31), F.concat(F.lit("-"), F.col("ending_market_value").cast("string")))
        .otherwise(F.col("ending_market_value").cast("string")).alias("ending_market_value"),
        *[column.alias(name) for name, column in text.items() if name != "vendor_twrr"],
        F.when(_every(37), "1.5").otherwise(text["vendor_twrr"]).alias("vendor_twrr"),
        "data_source", "file_name", "created_at",
    )


@lru_cache(maxsize=16)
def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """One arriving file key per order, in varied folders, spellings and sizes."""
    vendor = F.element_at(
        F.array(*[F.lit(v) for v in ("Vendor_A_", "vendorb_", "VC_", "unknown_", "va_", "vendor_b_", "vendorc_")]),
        (F.col("o_orderkey") % 7 + 1).cast("int"),
    )
    place = F.element_at(
        F.array(*[F.lit(v) for v in ("incoming/", "incoming/", "incoming/", "processing/", "archive/", "error/")]),
        (F.col("o_orderkey") % 6 + 1).cast("int"),
    )
    ending = F.element_at(
        F.array(*[F.lit(v) for v in (".csv", ".XLSX", ".json", ".txt", ".xls")]),
        (F.col("o_orderkey") % 5 + 1).cast("int"),
    )
    return _table(spark, folder, "orders").select(
        F.concat(place, vendor, F.col("o_orderkey").cast("string"), ending).alias("file_key"),
        F.when(F.col("o_orderkey") % 10 == 0, 0).otherwise(F.floor("o_totalprice")).cast("long").alias("file_size"),
    )


@lru_cache(maxsize=16)
def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return log_lines_of(_table(spark, folder, "events"))


def log_lines_of(events: DataFrame) -> DataFrame:
    """Pipeline log lines, one per event; the events may be a stream."""
    count = F.regexp_extract("props", r'"k": (\d+)', 1)
    message = (
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit("ERROR batch failed, variance above tolerance for user "), F.col("user_id").cast("string")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("records processed: processed "), count, F.lit(" records")))
        .when(F.col("event_type") == "view", F.concat(F.lit("twrr variance found for user "), F.col("user_id").cast("string")))
        .when(F.col("event_type") == "click", F.concat(F.lit("data quality check done, quality score: "), count))
        .otherwise("INFO heartbeat")
    )
    return events.select("event_id", "ts", message.alias("message"))


@lru_cache(maxsize=16)
def metric_points(spark: SparkSession, folder: str) -> DataFrame:
    return metric_points_of(_table(spark, folder, "events"))


def metric_points_of(events: DataFrame) -> DataFrame:
    """Metric samples, one per event."""
    return events.select(
        F.col("event_type").alias("metric_name"), "ts",
        F.col("value").cast("decimal(18,4)").alias("value"),
    )
