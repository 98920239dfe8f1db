"""Vendor file readers. Values arrive as text; casting is a later, checked step."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.schemas import ARRIVAL_PREFIX, ARRIVAL_SUFFIXES, VENDOR_C

# Where each standard field sits in vendor C's nested record.
VENDOR_C_PATHS = {
    "account_id": "account.id",
    "account_name": "account.name",
    "portfolio_id": "account.portfolio",
    "as_of_date": "reporting.period_end",
    "beginning_market_value": "reporting.market_values.beginning",
    "contributions": "reporting.cash_flows.contributions",
    "distributions": "reporting.cash_flows.distributions",
    "income": "reporting.performance.income_earned",
    "appreciation": "reporting.performance.capital_appreciation",
    "fees": "reporting.performance.fees_paid",
    "other_adjustments": "reporting.performance.other_adjustments",
    "ending_market_value": "reporting.market_values.ending",
    "benchmark_return": "reporting.returns.benchmark",
    "vendor_twrr": "reporting.returns.time_weighted",
}


def header_names(line: str) -> list[str]:
    """Column names of a header line; a missing or repeated name gets its place as a suffix."""
    names = next(csv.reader([line.removeprefix("\ufeff")]), [])
    seen = [n.lower() for n in names]
    return [n if n and seen.count(n.lower()) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def csv_layouts(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> dict[str, list[str]]:
    """Header line to the files that have it, by one scan however many files there are.

    A file's header is its first line that is not blank, in the part of it that begins at
    byte 0; only that line of each file comes to the driver, as many as the listing has.
    """
    lines = spark.read.option("recursiveFileLookup", True)
    if glob:
        lines = lines.option("pathGlobFilter", glob)
    first = (
        lines.text(path if isinstance(path, str) else list(path))
        .select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
        .where((F.col("file_block_start") == 0) & (F.trim("value") != ""))
        .groupBy("file_path").agg(F.min_by("value", "at").alias("header")))
    layouts: dict[str, list[str]] = {}
    for row in sorted(first.collect()):
        layouts.setdefault(row.header, []).append(unquote(row.file_path))
    return layouts


def read_csv(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, malformed: str | None = None,
    quoted_breaks: bool = False, lineage: bool = False,
) -> DataFrame:
    """CSV files with a header row, all values as text; columns are found by name in every file.

    Spark would take one file's header for all files of a scan. Files are therefore
    grouped by their header, and each group is a scan of its own; a column that a group
    lacks is null. With `malformed`, that column holds the raw line of a row with more or
    fewer fields than its header, else null; without it such rows are filled up or cut. Spark
    refuses queries of that column alone: use it beside another one, or stage the rows.
    A line break in quotes makes two malformed lines; quoted_breaks=True reads it right,
    at the price of one task per file. lineage adds the column _path.
    """
    out = None
    for header, group in csv_layouts(spark, path, glob).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header_names(header)])
        reader = spark.read.option("header", True).option("multiLine", quoted_breaks)
        if malformed:
            schema = schema.add(malformed, T.StringType())
            # Fields are counted only where all of them are parsed, whatever a query goes on to use.
            reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
        rows = reader.schema(schema).csv(group)
        rows = rows.select("*", F.col("_metadata.file_path").alias("_path")) if lineage else rows
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is not None:
        return out
    return spark.createDataFrame([], T.StructType([
        T.StructField(n, T.StringType()) for n in (malformed, "_path" if lineage else None) if n]))


def decoded(column: Column | str) -> Column:
    """URL decoding; a name that is no valid encoding stays as it is."""
    return F.coalesce(F.try_url_decode(column), F.col(column) if isinstance(column, str) else column)


def read_json(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, lines: bool = False,
    malformed: str | None = None, lineage: bool = False,
) -> DataFrame:
    """Nested JSON records of vendor C, flattened. The schema is fixed, so no
    inference pass. An indented array is one task per file; with lines=True the
    file holds one record per line and is split. With `malformed`, that column holds
    the text of a record that cannot be read. lineage adds the column _path."""
    schema = T.StructType([*VENDOR_C, T.StructField(malformed, T.StringType())]) if malformed else VENDOR_C
    reader = spark.read.schema(schema).option("multiLine", not lines)
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.json(path if isinstance(path, str) else list(path))
    rows = rows.select("*", F.col("_metadata.file_path").alias("_path")) if lineage else rows
    return flatten_nested(rows, [*([malformed] if malformed else []), *(["_path"] if lineage else [])])


def read_vendor_file(
    spark: SparkSession, path: str | Sequence[str], lines: bool = False, malformed: str | None = None, lineage: bool = False,
) -> DataFrame:
    """Reader by suffix of the path or paths. Other formats are refused when the plan is built.
    lines: JSON with a record per line."""
    paths = [path] if isinstance(path, str) else list(path)
    if all(p.endswith(".csv") for p in paths):
        return read_csv(spark, paths, malformed=malformed, lineage=lineage)
    if all(p.endswith(".json") for p in paths):
        return read_json(spark, paths, lines=lines, malformed=malformed, lineage=lineage)
    raise ValueError(f"unsupported file format: {', '.join(p for p in paths if not p.endswith(('.csv', '.json')))}")


def flatten_nested(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Nested record to the flat standard record."""
    return df.select(*extra, *[F.col(path).alias(name) for name, path in VENDOR_C_PATHS.items()])


def arrival_glob() -> str:
    """Glob of accepted arrivals for pathGlobFilter, below the arrival folder."""
    return "*.{" + ",".join(ARRIVAL_SUFFIXES) + "}"


def list_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Keys and sizes of arrived files, from file metadata only (no content is read)."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", arrival_glob()).load(f"{root.rstrip('/')}/{ARRIVAL_PREFIX}")
    )
    # The path keeps a name's own characters, a plus or a percent sign too, so nothing is decoded here.
    key = F.concat(F.lit(ARRIVAL_PREFIX), F.substring_index("path", f"/{ARRIVAL_PREFIX}", -1))
    return found.select(key.alias("file_key"), F.col("length").alias("file_size"), "modificationTime")
