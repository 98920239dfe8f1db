"""Running values of the stored table, carried from month to month over any number of loads.

The table keeps each account's totals of every month beside its rows. A load merges its
rows into the months they touch and restates only those and the later months in which
its accounts have rows: an account's month opens with what its earlier months add up
to, which is at most one number per month of the calendar. A group of the window is
an account's month, at most 31 rows, because account and date are unique.

Months, their totals and their running values change together, by one manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from navrecon.functions.finance import growth_factor
from navrecon.operators.latest import PERFORMANCE_KEY
from navrecon.session import fresh_dir
from navrecon.sources import mapping, store

ACCOUNT_MONTH = ("account_id", *store.PARTITIONS)


def _flow() -> Column:
    return F.coalesce("net_flow", F.lit(0))


@dataclass(frozen=True)
class Merged:
    """Keys that were new, keys that were known, and the rows written, with _inserted and _updated flags."""

    inserted: int
    updated: int
    rows: DataFrame


def month_totals(rows: DataFrame) -> DataFrame:
    """Flow and growth of each account's month; the factors multiply in the order of their dates."""
    dated = F.array_sort(F.collect_list(F.struct("as_of_date", growth_factor("calculated_twrr").alias("g"))))
    totals = store.with_partitions(rows).groupBy(*ACCOUNT_MONTH).agg(
        F.sum(_flow()).cast("decimal(28,2)").alias("flow_total"),
        F.aggregate(dated, F.lit(1.0), lambda product, day: product * day["g"]).alias("growth_total"))
    return totals.select("account_id", "flow_total", "growth_total", *store.PARTITIONS)


def totals_of(spark: SparkSession, path: str, found: list[store.Entry]) -> DataFrame:
    """Account totals of stored months; a month without kept totals is added up from its rows."""
    bare = {(e.year, e.month) for e in found if not e.totals}
    whole = store.stored_totals(spark, path, [e for e in found if (e.year, e.month) not in bare])
    return whole.unionByName(month_totals(store.stored_rows(spark, path, bare))) if bare else whole


def openings(totals: DataFrame) -> DataFrame:
    """What each account's month begins with: the totals of its earlier months."""
    before = (Window.partitionBy("account_id").orderBy(*store.PARTITIONS)
              .rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(
        *ACCOUNT_MONTH, F.coalesce(F.sum("flow_total").over(before), F.lit(0)).cast("decimal(28,2)").alias("_flow_before"),
        F.coalesce(F.product("growth_total").over(before), F.lit(1.0)).alias("_growth_before"))


def _merge(known: DataFrame, incoming: DataFrame, newest: tuple[str, ...]) -> DataFrame:
    """The newest row of each key, with its month's running values so far and where the key was found."""
    both = store.with_partitions(
        known.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)))
    ).repartition(*[F.col(c) for c in ACCOUNT_MONTH])  # one shuffle serves all three windows
    key = Window.partitionBy(*ACCOUNT_MONTH, "as_of_date")
    ranked = both.select(
        "*", F.max("_new").over(key).alias("_has_new"), F.min("_new").over(key).alias("_all_new"),
        F.row_number().over(key.orderBy(*[F.col(c).desc_nulls_last() for c in newest])).alias("_rank"))
    month = Window.partitionBy(*ACCOUNT_MONTH).orderBy("as_of_date")
    upto = month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.where("_rank = 1").select(
        *known.columns, *store.PARTITIONS, F.col("_all_new").alias("_inserted"),
        (F.col("_has_new") & ~F.col("_all_new")).alias("_updated"),
        F.sum(_flow()).over(upto).cast("decimal(28,2)").alias("_flow"),
        F.product(growth_factor("calculated_twrr")).over(upto).alias("_growth"),
        F.lead("as_of_date").over(month).isNull().alias("_last"))


def _months_to_restate(spark: SparkSession, path: str, incoming: DataFrame, touched: list[store.Month]) -> list[store.Month]:
    """The touched months and the later ones in which an incoming account has rows."""
    later = [e for e in store.entries(spark, path) if (e.year, e.month) > touched[0] and (e.year, e.month) not in set(touched)]
    if not later:
        return touched
    hit = totals_of(spark, path, later).join(incoming.select("account_id").distinct(), "account_id", "left_semi")
    return sorted({*touched, *[(r[0], r[1]) for r in hit.select(*store.PARTITIONS).distinct().collect()]})


def upsert_running(spark: SparkSession, path: str, incoming: DataFrame, newest: tuple[str, ...]) -> Merged:
    """Merge staged rows, unique by account and date, into the table and restate its running values.

    Loads in any order give the running values of one load of all rows. Rows without a date are refused.
    """
    touched = store.touched_months(incoming)
    if not touched:
        store.commit(spark, path, [])
        return Merged(0, 0, mapping.conform(incoming).select("*", *[F.lit(False).alias(c) for c in ("_inserted", "_updated")]))
    months = _months_to_restate(spark, path, incoming, touched)
    known = store.stored_rows(spark, path, months).drop(*store.PARTITIONS)
    counted = Observation()
    merged = _merge(known, mapping.conform(incoming), newest)
    folder = fresh_dir(spark, "merged")
    merged.observe(counted, F.count_if("_inserted").alias("inserted"), F.count_if("_updated").alias("updated")).write.parquet(folder)
    rows = spark.read.schema(merged.schema).parquet(folder)
    totals = rows.where("_last").select(
        "account_id", F.col("_flow").alias("flow_total"), F.col("_growth").alias("growth_total"), *store.PARTITIONS)
    earlier = [e for e in store.entries(spark, path) if (e.year, e.month) < months[-1] and (e.year, e.month) not in set(months)]
    opened = rows.join(openings(totals_of(spark, path, earlier).unionByName(totals)), list(ACCOUNT_MONTH))
    finished = opened.withColumns({
        "cumulative_net_flow": F.col("_flow_before") + F.col("_flow"),
        "cumulative_twrr": F.col("_growth_before") * F.col("_growth") - F.lit(1.0)})
    version, written = store.write_version(mapping.conform(finished), path)
    store.write_totals(totals, path, version)
    store.commit(spark, path, [store.Entry(*m, version, version) for m in written], months)
    return Merged(counted.get["inserted"], counted.get["updated"], rows)
