"""From a vendor layout to the standard record: names, types, dates, columns."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.functions.text import parse_date
from navrecon.schemas import (
    FIELD_ALIASES, MONEY, MONEY_FIELDS, PENDING, PERFORMANCE, RATE, RATE_FIELDS,
)


def load_settings(spark: SparkSession, path: str) -> dict:
    """A small JSON document (mapping or configuration) from any Spark file system."""
    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0])


def resolve_names(columns: list[str], aliases: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Standard field to source column. The standard name wins, then the first
    listed alias that is present; case does not matter."""
    present: dict[str, str] = {}
    for column in columns:
        present.setdefault(column.lower(), column)
    chosen = {}
    for field, names in (aliases or FIELD_ALIASES).items():
        match = next((present[n.lower()] for n in [field, *names] if n.lower() in present), None)
        if match is not None:
            chosen[field] = match
    return chosen


def normalize_columns(
    df: DataFrame, aliases: dict[str, list[str]] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Project the source columns under their standard names; others are dropped
    unless listed in keep. One select, so unused columns are never read."""
    chosen = resolve_names([c for c in df.columns if c not in keep], aliases)
    return df.select(*keep, *[F.col(f"`{source}`").alias(field) for field, source in chosen.items()])


def field_type(name: str) -> T.DataType | None:
    return MONEY if name in MONEY_FIELDS else RATE if name in RATE_FIELDS else None


def cast_field(name: str, formats: list[str] | None = None) -> Column:
    """Checked cast: what cannot be read becomes null and is left to the rules."""
    if name == "as_of_date":
        return parse_date(name, formats).alias(name)
    kind = field_type(name)
    return (F.col(name).try_cast(kind) if kind else F.col(name).cast("string")).alias(name)


def cast_types(df: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Cast the standard fields that are present; other columns pass through."""
    return df.select(*[
        cast_field(name, formats) if name in FIELD_ALIASES else F.col(name) for name in df.columns
    ])


def with_defaults(df: DataFrame) -> DataFrame:
    """Column defaults of the table: flows, income and adjustments 0, status pending."""
    zero = ["contributions", "distributions", "income", "appreciation", "fees", "other_adjustments"]
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast(MONEY)) for c in zero if c in df.columns}
    if "reconciliation_status" in df.columns:
        filled["reconciliation_status"] = F.coalesce("reconciliation_status", F.lit(PENDING))
    return df.withColumns(filled)


def with_audit(
    df: DataFrame, vendor: Column | str, file_name: Column | str, now: Column, processed_by: str = "navrecon"
) -> DataFrame:
    """Lineage and audit columns; the time is an argument so reruns are equal."""
    return df.withColumns({
        "data_source": vendor if isinstance(vendor, Column) else F.lit(vendor),
        "file_name": file_name if isinstance(file_name, Column) else F.lit(file_name),
        "processed_by": F.lit(processed_by), "created_at": now, "updated_at": now,
        "reconciliation_status": F.lit(PENDING),
    })


def conform(df: DataFrame, target: T.StructType = PERFORMANCE) -> DataFrame:
    """Exactly the target columns in order; a missing one is a typed null."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in target
    ])


def union_standard(*frames: DataFrame) -> DataFrame:
    """Union of standardised vendor frames by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
