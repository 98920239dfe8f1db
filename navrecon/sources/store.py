"""Stored tables: versioned months of parquet, JDBC append, exports and upserts.

Every write of the performance table goes to a folder of its own, a version. A small
manifest lists which version holds each month; a write counts from the moment its
manifest is renamed into place. Readers see the months of one manifest, so a job or
driver lost at any point leaves the old table, and a rerun makes the new one. A table
path has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.operators.latest import PERFORMANCE_KEY, update_status, upsert
from navrecon.schemas import MONTH_TOTALS, PERFORMANCE
from navrecon.session import fresh_dir

PARTITIONS = ("as_of_year", "as_of_month")
Month = tuple[int, int]


class Entry(NamedTuple):
    """A month of the table: the version that holds its rows, and those of its account totals and summary, if any."""

    year: int
    month: int
    version: str
    totals: str | None = None
    summary: str | None = None


# ---- manifest --------------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def _manifests(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _file_system(spark, f"{path}/_manifest")
    if not fs.exists(folder):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".json"))


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What the table holds now; empty for a table that nothing was written to."""
    names = _manifests(spark, path)
    if not names:
        return []
    fs, newest = _file_system(spark, f"{path}/_manifest/{names[-1]}")
    stream = fs.open(newest)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [Entry(*e) for e in json.loads(text)]


def commit(spark: SparkSession, path: str, added: Iterable[Entry], replaced: Iterable[Month] = ()) -> None:
    """A new manifest: without the entries of the replaced months, with the added ones."""
    gone = set(replaced)
    kept = [e for e in entries(spark, path) if (e.year, e.month) not in gone]
    names = _manifests(spark, path)
    number = int(names[-1].split(".")[0]) + 1 if names else 0
    fs, draft = _file_system(spark, f"{path}/_manifest/{uuid.uuid4().hex}.draft")
    stream = fs.create(draft)
    stream.write(bytearray(json.dumps(sorted([*kept, *added], key=lambda e: e[:3])).encode()))
    stream.close()
    _, place = _file_system(spark, f"{path}/_manifest/{number:010d}.json")
    if fs.exists(place) or not fs.rename(draft, place):
        raise RuntimeError(f"another writer has changed {path}")


def written_months(spark: SparkSession, folder: str) -> list[Month]:
    """The months below a folder, from its listing alone. A row without date belongs to none: it is refused."""
    fs, pattern = _file_system(spark, f"{folder}/{PARTITIONS[0]}=*/{PARTITIONS[1]}=*")
    found = [f.getPath() for f in fs.globStatus(pattern) or []]
    names = [(p.getParent().getName().split("=")[1], p.getName().split("=")[1]) for p in found]
    if any(not (y.lstrip("-").isdigit() and m.isdigit()) for y, m in names):
        raise ValueError("rows without as_of_date cannot be stored; set them apart before")
    return sorted((int(y), int(m)) for y, m in names)


# ---- writing ---------------------------------------------------------------

def with_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "as_of_year": F.year("as_of_date"), "as_of_month": F.month("as_of_date"),
    })


def _arrange(df: DataFrame) -> DataFrame:
    """Few files per month: shuffle by month, letting AQE split a large month,
    and sort inside for parquet statistics on account and date."""
    return (
        with_partitions(df).hint("rebalance", *[F.col(c) for c in PARTITIONS])
        .sortWithinPartitions(*PARTITIONS, *PERFORMANCE_KEY)
    )


def write_version(df: DataFrame, path: str) -> tuple[str, list[Month]]:
    """df as a version that no manifest names yet, and its months."""
    version = uuid.uuid4().hex
    _arrange(df).write.partitionBy(*PARTITIONS).parquet(f"{path}/rows/version={version}")
    return version, written_months(df.sparkSession, f"{path}/rows/version={version}")


def append_performance(df: DataFrame, path: str) -> None:
    version, months = write_version(df, path)
    commit(df.sparkSession, path, [Entry(y, m, version) for y, m in months])


def replace_partitions(df: DataFrame, path: str) -> None:
    """Put the months that df contains in place of the stored ones."""
    version, months = write_version(df, path)
    commit(df.sparkSession, path, [Entry(y, m, version) for y, m in months], months)


# ---- reading ---------------------------------------------------------------

def _folders(spark: SparkSession, base: str, schema: T.StructType, places: list[tuple[str, int, int]]) -> DataFrame:
    """Rows of some months of some versions below base, with the fixed schema: a file with other columns cannot change it."""
    full = T.StructType([*schema, *[T.StructField(name, T.IntegerType()) for name in PARTITIONS]])
    if not places:
        return spark.createDataFrame([], full)
    folders = [f"{base}/version={v}/as_of_year={y}/as_of_month={m}" for v, y, m in places]
    wide = T.StructType([*full, T.StructField("version", T.StringType())])
    return spark.read.schema(wide).option("basePath", base).parquet(*folders).select(full.names)


def stored_rows(spark: SparkSession, path: str, months: Iterable[Month] | None = None) -> DataFrame:
    """The table, or some months of it; other months are not even listed."""
    wanted = None if months is None else set(months)
    return _folders(spark, f"{path}/rows", PERFORMANCE, [
        (e.version, e.year, e.month) for e in entries(spark, path) if wanted is None or (e.year, e.month) in wanted])


def write_totals(totals: DataFrame, path: str, version: str) -> None:
    """Account totals of some months as the totals of a version, in few files ordered by month."""
    totals.sortWithinPartitions(*PARTITIONS).write.parquet(f"{path}/totals/version={version}")


def read_months(spark: SparkSession, base: str, schema: T.StructType, places: set[tuple[str, int, int]]) -> DataFrame:
    """Rows of (version, year, month) places; a version's months lie together, ordered by month."""
    out = spark.createDataFrame([], schema)
    for version in sorted({v for v, _, _ in places}):
        months = [y * 100 + m for v, y, m in places if v == version]
        rows = spark.read.schema(schema).parquet(f"{base}/version={version}")
        out = out.unionByName(rows.where((F.col(PARTITIONS[0]) * 100 + F.col(PARTITIONS[1])).isin(months)))
    return out


def stored_totals(spark: SparkSession, path: str, found: list[Entry]) -> DataFrame:
    """The account totals of the entries that have them, each month from its own version."""
    schema = T.StructType([*MONTH_TOTALS, *[T.StructField(name, T.IntegerType()) for name in PARTITIONS]])
    return read_months(spark, f"{path}/totals", schema, {(e.totals, e.year, e.month) for e in found if e.totals})


def read_performance(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored rows; of a date range only the months it touches are read."""
    def month(day: str) -> Month:
        return int(day[:4]), int(day[5:7])

    months = [(e.year, e.month) for e in entries(spark, path) if (start is None or (e.year, e.month) >= month(start))
              and (end is None or (e.year, e.month) <= month(end))]
    df = stored_rows(spark, path, months)
    if start:
        df = df.where(F.col("as_of_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("as_of_date") <= F.lit(end).cast("date"))
    return df.drop(*PARTITIONS)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Has a write to the table ever been completed?"""
    return bool(_manifests(spark, path))


# ---- changing --------------------------------------------------------------

def touched_months(df: DataFrame) -> list[Month]:
    """The distinct months in df: a calendar-bounded list, not data-sized.

    A row without date belongs to no month and could never be rewritten: it is refused.
    """
    rows = with_partitions(df.select("as_of_date")).select(*PARTITIONS).distinct().collect()
    if any(r[0] is None for r in rows):
        raise ValueError("rows without as_of_date cannot be stored; set them apart before")
    return sorted((r[0], r[1]) for r in rows)


def rewrite_months(
    spark: SparkSession, path: str, months: list[Month], change: Callable[[DataFrame], DataFrame],
    keep_totals: bool = False,
) -> None:
    """Apply `change` to the rows of some months and put the result in their place; only these are read.

    keep_totals says that `change` leaves flows and returns alone, so that the account totals still hold.
    """
    if not months:
        return
    before = {(e.year, e.month): e.totals for e in entries(spark, path)} if keep_totals else {}
    version, written = write_version(change(stored_rows(spark, path, months).drop(*PARTITIONS)), path)
    commit(spark, path, [Entry(*m, version, before.get(m)) for m in written], months)


def upsert_performance(spark: SparkSession, path: str, incoming: DataFrame, newest: tuple[str, ...]) -> None:
    """Insert or replace by (account_id, as_of_date), touching only its months.

    Rows without a date are refused, and nothing is changed. The incoming rows are staged,
    so that their plan runs once. Running values are taken as they come; plans.carry keeps them right.
    """
    folder = fresh_dir(spark, "incoming")
    incoming.write.parquet(folder)
    rows = spark.read.schema(incoming.schema).parquet(folder)
    rewrite_months(spark, path, touched_months(rows), lambda known: upsert(known, rows, newest=newest))


def set_file_status(spark: SparkSession, path: str, file_name: str, vendor: str, status: str, now) -> None:
    """Status update of one file, rewriting only the months it has rows in."""
    hit = stored_rows(spark, path).where((F.col("file_name") == file_name) & (F.col("data_source") == vendor))
    rewrite_months(
        spark, path, touched_months(hit), lambda rows: update_status(rows, file_name, vendor, status, now), keep_totals=True
    )


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int = 64) -> None:
    """df as a table bucketed and sorted by (account_id, as_of_date), one file for each bucket.

    Two such tables with as many buckets join, aggregate and rank by that key without a
    shuffle. The files lie at path; the name is in the session's catalog.
    """
    (df.repartition(buckets, *PERFORMANCE_KEY).write.mode("overwrite").bucketBy(buckets, *PERFORMANCE_KEY)
     .sortBy(*PERFORMANCE_KEY).option("path", path).saveAsTable(name))


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int = 64) -> DataFrame:
    """A table that write_bucketed wrote, also in a session whose catalog does not know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(PERFORMANCE_KEY)}) "
              f"SORTED BY ({', '.join(PERFORMANCE_KEY)}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_part(df: DataFrame, path: str, part: str) -> None:
    """One load's rows of a growing table (check results, issues, rejected rows, log): a rerun replaces them."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/load_id={part}")


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All loads' rows; a table that nothing was written to is empty."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Append over JDBC. Spark opens one connection per partition."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    column: str | None = None, bounds: tuple[str, str] | None = None, parts: int = 1,
) -> DataFrame:
    """JDBC scan, split on a date or number column when bounds are given."""
    if column and bounds:
        return (
            spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
            .options(partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
            .load()
        )
    return spark.read.jdbc(url, table, properties=properties)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. A sorted df stays in order across its numbered parts;
    one file is made only on request."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
