"""Summaries of the stored table that do not scan it again.

Each month of the table has additive parts: counts, exact sums and extremes for each
vendor, file, day of creation and status, and the accounts of each as bitmaps over
account numbers. Parts of months add up, bitmaps are united, so totals and exact
distinct counts come from the parts alone. A month that was rewritten since has no
parts yet: `refresh` makes them, and until then its rows are read instead.

Accounts get their numbers when they first appear: consecutive within a task, so that
the bitmaps of 32,768 numbers are well filled and few.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.operators.report import since
from navrecon.schemas import COMPLETED, PROCESSING, WITH_ISSUES
from navrecon.sources import store

GROUP = ("data_source", "file_name", "created_day")
#: Tasks that number new accounts of one refresh; numbers of a task follow each other.
NUMBERING = 8
PARTS = T.StructType([T.StructField(n, k) for n, k in (
    ("data_source", T.StringType()), ("file_name", T.StringType()), ("created_day", T.DateType()),
    ("reconciliation_status", T.StringType()), ("n", T.LongType()), ("aum", T.DecimalType(38, 2)),
    ("twrr", T.DecimalType(38, 8)), ("n_twrr", T.LongType()), ("failures", T.LongType()), ("first_date", T.DateType()),
    ("last_date", T.DateType()), ("first_created", T.TimestampNTZType()), ("last_created", T.TimestampNTZType()),
    ("last_updated", T.TimestampNTZType()), ("as_of_year", T.IntegerType()), ("as_of_month", T.IntegerType()))])
BITS = T.StructType([T.StructField(n, k) for n, k in (
    ("data_source", T.StringType()), ("file_name", T.StringType()), ("created_day", T.DateType()),
    ("bucket", T.LongType()), ("bitmap", T.BinaryType()), ("as_of_year", T.IntegerType()), ("as_of_month", T.IntegerType()))])
NUMBERS = T.StructType([T.StructField("account_id", T.StringType()), T.StructField("number", T.LongType())])


def _by_day(rows: DataFrame) -> DataFrame:
    return store.with_partitions(rows).withColumn("created_day", F.to_date("created_at"))


def parts_of(rows: DataFrame) -> DataFrame:
    """Additive parts of table rows, folded before the shuffle."""
    found = _by_day(rows).groupBy(*GROUP, "reconciliation_status", *store.PARTITIONS).agg(
        F.count("*").alias("n"), F.sum("ending_market_value").alias("aum"), F.sum("calculated_twrr").alias("twrr"),
        F.count("calculated_twrr").alias("n_twrr"), F.count_if(~F.col("twrr_tolerance_check")).alias("failures"),
        F.min("as_of_date").alias("first_date"), F.max("as_of_date").alias("last_date"),
        F.min("created_at").alias("first_created"), F.max("created_at").alias("last_created"),
        F.max("updated_at").alias("last_updated"))
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PARTS])


def bits_of(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The accounts of each group as bitmaps over account numbers."""
    numbered = _by_day(rows).select(*GROUP, *store.PARTITIONS, "account_id").distinct().join(numbers, "account_id")
    found = numbered.groupBy(*GROUP, *store.PARTITIONS, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    return found.select(*BITS.names)


def _numbers(spark: SparkSession, path: str) -> DataFrame:
    return store.read_parts(spark, f"{path}/numbers", NUMBERS).select(*NUMBERS.names)


def _number_accounts(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Numbers for accounts that have none. An earlier refresh that did not end leaves valid numbers."""
    known = _numbers(spark, path)
    start = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    # Each task of a refresh has a range of 2^33 numbers; the next refresh begins above the last one.
    start = (start >> 33) + 1 if start else 0
    fresh = rows.select("account_id").distinct().join(known, "account_id", "left_anti").coalesce(NUMBERING)
    store.write_part(fresh.select("account_id", (F.monotonically_increasing_id() + F.lit(start << 33) + 1).alias("number")),
                     f"{path}/numbers", uuid.uuid4().hex)


def _split(spark: SparkSession, path: str) -> tuple[list[store.Entry], set[store.Month]]:
    """(entries with parts, months without): a month counts as a whole."""
    found = store.entries(spark, path)
    bare = {(e.year, e.month) for e in found if not e.summary}
    return [e for e in found if (e.year, e.month) not in bare], bare


def refresh(spark: SparkSession, path: str) -> None:
    """Parts for the months that have none; only these are read. Run it after loads, as often as suits."""
    _, bare = _split(spark, path)
    if not bare:
        return
    rows = store.stored_rows(spark, path, bare).drop(*store.PARTITIONS)
    _number_accounts(spark, path, rows)
    version = uuid.uuid4().hex
    for name, df in (("parts", parts_of(rows)), ("bits", bits_of(rows, _numbers(spark, path)))):
        df.sortWithinPartitions(*store.PARTITIONS).write.parquet(f"{path}/summary-{name}/version={version}")
    changed = [e for e in store.entries(spark, path) if (e.year, e.month) in bare]
    store.commit(spark, path, [e._replace(summary=version) for e in changed], bare)


def _kept(spark: SparkSession, path: str, name: str, schema: T.StructType, found: list[store.Entry]) -> DataFrame:
    return store.read_months(spark, f"{path}/summary-{name}", schema, {(e.summary, e.year, e.month) for e in found})


def parts(spark: SparkSession, path: str) -> DataFrame:
    """The additive parts of the whole table."""
    kept, bare = _split(spark, path)
    out = _kept(spark, path, "parts", PARTS, kept)
    return out.unionByName(parts_of(store.stored_rows(spark, path, bare).drop(*store.PARTITIONS))) if bare else out


def account_bits(spark: SparkSession, path: str) -> DataFrame:
    """The account bitmaps of the whole table; months without parts have to be refreshed first."""
    kept, bare = _split(spark, path)
    if bare:
        raise ValueError("refresh the summary first: account numbers of changed months are missing")
    return _kept(spark, path, "bits", BITS, kept)


# ---- reports ---------------------------------------------------------------

def distinct_accounts(bits: DataFrame, *by: str) -> DataFrame:
    """Exact number of different accounts of each group."""
    united = bits.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("b"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("b")).alias("accounts"))


def _status(value: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("reconciliation_status") == value, F.col("n"))), F.lit(0))


def vendor_list(parts: DataFrame) -> DataFrame:
    return parts.groupBy(F.col("data_source").alias("vendor_name")).agg(
        F.sum("n").alias("row_count"), F.count_distinct("file_name").alias("file_count"),
        F.max("last_created").alias("last_processed")).orderBy("vendor_name")


def file_list(parts: DataFrame) -> DataFrame:
    return parts.groupBy("file_name", F.col("data_source").alias("vendor")).agg(
        F.sum("n").alias("record_count"), F.min("first_created").alias("processing_start"),
        F.max("last_updated").alias("last_updated"),
        F.when(_status(COMPLETED) == F.sum("n"), COMPLETED).when(_status(WITH_ISSUES) > 0, WITH_ISSUES)
        .otherwise(PROCESSING).alias("overall_status")).orderBy(F.desc("last_updated"), "file_name")


def file_details(parts: DataFrame, bits: DataFrame) -> DataFrame:
    key = ["file_name", "vendor"]
    totals = parts.groupBy("file_name", F.col("data_source").alias("vendor")).agg(
        F.sum("n").alias("total_records"), F.min("first_date").alias("earliest_date"), F.max("last_date").alias("latest_date"),
        F.sum("aum").alias("total_market_value"),
        F.try_divide(F.sum("twrr").cast("double"), F.sum("n_twrr")).alias("avg_twrr"), F.sum("failures").alias("twrr_failures"))
    accounts = distinct_accounts(bits, "file_name", "data_source").withColumnsRenamed(
        {"data_source": "vendor", "accounts": "unique_accounts"})
    return totals.join(accounts, key)


def dashboard_metrics(parts: DataFrame, bits: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    """Headline totals of the rows created in the last days; one row."""
    recent = since("created_day", as_of, days_back)
    totals = parts.where(recent).agg(
        F.count_distinct("file_name").alias("total_files_processed"), F.count_distinct("data_source").alias("total_vendors"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), F.sum("aum").alias("total_aum"),
        F.try_divide(F.sum("twrr").cast("double"), F.sum("n_twrr")).alias("avg_twrr"))
    accounts = distinct_accounts(bits.where(recent)).select(F.coalesce("accounts", F.lit(0)).alias("total_accounts"))
    return totals.join(accounts, F.lit(True))  # one row beside one row


def daily_volume(parts: DataFrame, as_of: str, days_back: int = 7) -> DataFrame:
    return parts.where(since("created_day", as_of, days_back)).groupBy(F.col("created_day").alias("processing_date")).agg(
        F.count_distinct("file_name").alias("files_processed"), F.sum("n").alias("records_processed")).orderBy(
        F.desc("processing_date"))
