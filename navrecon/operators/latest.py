"""Keyed table maintenance: keep latest, upsert, insert if absent, status update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERFORMANCE_KEY = ("account_id", "as_of_date")
NEWEST_FIRST = ("updated_at", "period_id")


def keep_latest(
    df: DataFrame, key: tuple[str, ...] = PERFORMANCE_KEY, newest: tuple[str, ...] = NEWEST_FIRST
) -> DataFrame:
    """One row per key, the newest by the given columns.

    Spark turns row_number = 1 into a group limit that runs before the shuffle
    as well, so each map task sends at most one row per key: a key with very
    many versions cannot overload the task that owns it.
    """
    order = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in newest])
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def upsert(
    current: DataFrame, incoming: DataFrame,
    key: tuple[str, ...] = PERFORMANCE_KEY, newest: tuple[str, ...] = NEWEST_FIRST,
) -> DataFrame:
    """Insert new keys and replace known ones by their newer version."""
    return keep_latest(current.unionByName(incoming, allowMissingColumns=True), key, newest)


def insert_if_absent(
    current: DataFrame, incoming: DataFrame, key: tuple[str, ...], first: tuple[str, ...]
) -> DataFrame:
    """Add only rows whose key is not stored yet; of equal new keys the first stays.

    Incoming rows are reduced to one per key before the join (already in the map
    tasks), so a key repeated very often does not travel.
    """
    order = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in first])
    fresh = incoming.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    return current.unionByName(fresh.join(current.select(*key).distinct(), list(key), "left_anti"))


def update_status(
    df: DataFrame, file_name: str, vendor: str, status: str, updated_at: Column
) -> DataFrame:
    """Set the reconciliation status of the rows of one file."""
    hit = (F.col("file_name") == file_name) & (F.col("data_source") == vendor)
    return df.withColumns({
        "reconciliation_status": F.when(hit, F.lit(status)).otherwise(F.col("reconciliation_status")),
        "updated_at": F.when(hit, updated_at).otherwise(F.col("updated_at")),
    })
