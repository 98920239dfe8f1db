"""Data-quality rules, profiles and rates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navrecon.functions.checks import value_equation_holds
from navrecon.functions.text import parse_date
from navrecon.schemas import NUMERIC_FIELDS, REQUIRED_FIELDS
from navrecon.sources.mapping import field_type


def number(name: str) -> Column:
    return F.col(name).try_cast("decimal(28,8)")


def has_required(fields: list[str] | None = None) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in fields or REQUIRED_FIELDS])


def flag_required(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return df.withColumn("has_required_fields", has_required(fields))


def missing_counts(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Nulls per field in one pass, turned into one row per field."""
    fields = fields or REQUIRED_FIELDS
    wide = df.agg(F.count("*").alias("total_records"), *[F.count_if(F.col(f).isNull()).alias(f) for f in fields])
    return wide.unpivot("total_records", fields, "field_name", "missing_count")


def _issue(kind: str, field: str, severity: str, bad: Column, text: str, expected: str) -> Column:
    return F.when(bad, F.struct(
        F.lit(kind).alias("issue_type"), F.lit(text).alias("issue_description"),
        F.lit(field).alias("field_name"), F.lit(expected).alias("expected_value"),
        F.col(field).cast("string").alias("actual_value"), F.lit(severity).alias("severity"),
    ))


def record_rules() -> list[Column]:
    """Business rules on a raw text record; each is null when it holds."""
    blank = F.col("account_id").isNull() | (F.trim("account_id") == "")
    return [
        _issue("missing_account_id", "account_id", "HIGH", blank, "account id is blank", "non-blank"),
        *[
            _issue(f"negative_{name}", name, "HIGH", number(name) < 0, "value is below zero", ">= 0")
            for name in ("beginning_market_value", "ending_market_value")
        ],
        _issue("unrealistic_twrr", "vendor_twrr", "MEDIUM", F.abs(number("vendor_twrr")) > 1,
               "return is beyond 100 percent", "between -1 and 1"),
        *[
            _issue(f"null_{name}", name, "LOW", F.col(name).isNull(), "flow is missing", "not null")
            for name in ("contributions", "distributions")
        ],
    ]


def type_rules(formats: list[str] | None = None) -> list[Column]:
    """Fields whose text is present but cannot be read as the type that the load casts it to."""
    return [
        *[
            _issue(f"invalid_{name}_type", name, "HIGH",
                   F.col(name).isNotNull() & F.col(name).try_cast(field_type(name)).isNull(),
                   "value is not a number", "number")
            for name in NUMERIC_FIELDS
        ],
        _issue("invalid_date_format", "as_of_date", "HIGH",
               F.col("as_of_date").isNotNull() & parse_date("as_of_date", formats).isNull(),
               "date matches no known format", "date"),
    ]


def issue_array(rules: list[Column]) -> Column:
    return F.array_compact(F.array(*rules))


def issues(raw: DataFrame, rules: list[Column] | None = None, formats: list[str] | None = None) -> DataFrame:
    """One row per broken rule; a clean row yields none. Narrow, no shuffle."""
    rules = rules or record_rules() + type_rules(formats)
    keep = [c for c in ("period_id", "data_source", "file_name") if c in raw.columns]
    return raw.select(
        *keep, "account_id", parse_date("as_of_date", formats).alias("as_of_date"), "created_at",
        F.explode(issue_array(rules)).alias("_issue"),
    ).select(*keep, "account_id", "as_of_date", "_issue.*", "created_at")


def orphan_accounts(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Rows whose account is unknown."""
    return rows.join(accounts.select("account_id"), "account_id", "left_anti")


def issues_without_log(found: DataFrame, log: DataFrame) -> DataFrame:
    """Issues of files that no processing-log row knows. One log row per file
    is kept before the join."""
    return found.join(log.select("file_name").distinct(), "file_name", "left_anti")


def orphan_issues(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    return orphan_accounts(rows, accounts).select(
        "period_id", "data_source", "file_name", "account_id", "as_of_date",
        F.lit("unknown_account").alias("issue_type"),
        F.lit("account is not in the account table").alias("issue_description"),
        F.lit("account_id").alias("field_name"), F.lit("known account").alias("expected_value"),
        F.col("account_id").alias("actual_value"), F.lit("HIGH").alias("severity"), "created_at",
    )


def outlier_issues(found: DataFrame) -> DataFrame:
    return found.select(
        "period_id", "data_source", "file_name", "account_id", "as_of_date",
        F.lit("twrr_outlier").alias("issue_type"),
        F.lit("return is far from its portfolio").alias("issue_description"),
        F.lit("calculated_twrr").alias("field_name"), F.lit("within 3 deviations").alias("expected_value"),
        F.col("calculated_twrr").cast("string").alias("actual_value"), "severity", "created_at",
    )


def route_rows(raw: DataFrame, rules: list[Column] | None = None) -> DataFrame:
    """Tag each row for the valid or the quarantine sink."""
    count = F.size(issue_array(rules or record_rules() + type_rules()))
    return raw.withColumn("issue_count", count.cast("long")).withColumn(
        "destination", F.when(F.col("issue_count") == 0, "valid").otherwise("quarantine")
    )


def beyond_bound(df: DataFrame, bound: float, value: str = "calculated_twrr") -> DataFrame:
    return df.where(F.abs(F.col(value)) > F.lit(str(bound)).cast("decimal(12,8)"))


def valid_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_records"), F.count_if(has_required()).alias("valid_records"))


def quality_rates(performance: DataFrame, raw: DataFrame, by: str = "data_source") -> DataFrame:
    """Completeness, validity, accuracy and consistency in percent, and the score.

    completeness: required cells present / required cells
    validity:     rows without type or range issue / rows (also the score)
    accuracy:     returns within tolerance / comparable returns
    consistency:  rows whose value equation holds / rows
    """
    def share(part: Column, whole: Column) -> Column:
        return F.try_divide(part * F.lit(100.0), whole)

    present = sum((F.count(name) for name in REQUIRED_FIELDS), F.lit(0))
    stored = performance.groupBy(by).agg(
        share(present, F.count("*") * len(REQUIRED_FIELDS)).alias("completeness_rate"),
        share(F.count_if("twrr_tolerance_check"), F.count("twrr_tolerance_check")).alias("accuracy_rate"),
        share(F.count_if(value_equation_holds()), F.count("*")).alias("consistency_rate"),
    )
    arrived = route_rows(raw).groupBy(by).agg(
        share(F.count_if(F.col("issue_count") == 0), F.count("*")).alias("validity_rate")
    )
    rates = ["completeness_rate", "validity_rate", "accuracy_rate", "consistency_rate"]
    # Compared as they are, rounded for display. A group that is only stored or only arrived stays, with nulls.
    good = reduce(and_, [F.coalesce(F.col(r), F.lit(0.0)) >= 95 for r in rates])
    other = arrived.withColumnRenamed(by, "_by")
    return stored.join(other, stored[by].eqNullSafe(other["_by"]), "full").select(
        F.coalesce(by, "_by").alias(by), *[F.round(r, 4).alias(r) for r in rates], good.alias("all_at_least_95"))


def profile(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Per column: type, rows, null share, distinct values, smallest, largest, mean.

    Exact mode counts each (column, value) pair once, aggregated before the
    shuffle, then folds the pairs per column; a value held by a third of all
    rows is one partial row per task. approximate=True replaces the pairs by a
    sketch and needs no shuffle of values at all.
    """
    types = dict(df.dtypes)
    numbers = ("decimal", "double", "float", "tinyint", "smallint", "int", "bigint")
    numeric = {c for c in columns if types[c].split("(")[0] in numbers}
    cells = df.select(F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c].split("(")[0]).alias("column_type"),
            F.col(c).cast("string").alias("text"),
            (F.col(c).try_cast("decimal(28,8)") if c in numeric else F.lit(None).cast("decimal(28,8)")).alias("num"),
        ) for c in columns
    ])).alias("cell")).select("cell.*")
    if approximate:
        counted = cells.groupBy("column_name", "column_type").agg(
            F.count("*").alias("total_records"), F.count("text").alias("_known"),
            F.approx_count_distinct("text").alias("distinct_values"),
            F.min("num").alias("_low"), F.max("num").alias("_high"),
            F.min("text").alias("_first"), F.max("text").alias("_last"),
            F.sum(F.col("num").cast("double")).alias("_sum"), F.count("num").alias("_numbers"),
        )
    else:
        pairs = cells.groupBy("column_name", "column_type", "text", "num").agg(F.count("*").alias("_rows"))
        counted = pairs.groupBy("column_name", "column_type").agg(
            F.sum("_rows").alias("total_records"),
            F.coalesce(F.sum(F.when(F.col("text").isNotNull(), F.col("_rows"))), F.lit(0)).alias("_known"),
            F.count("text").alias("distinct_values"),
            F.min("num").alias("_low"), F.max("num").alias("_high"),
            F.min("text").alias("_first"), F.max("text").alias("_last"),
            F.sum(F.col("num").cast("double") * F.col("_rows")).alias("_sum"),
            F.sum(F.when(F.col("num").isNotNull(), F.col("_rows"))).alias("_numbers"),
        )
    return counted.select(
        "column_name", "column_type", "total_records",
        F.round((F.col("total_records") - F.col("_known")) / F.col("total_records"), 6).alias("null_share"),
        "distinct_values",
        F.coalesce(F.col("_low").cast("string"), F.col("_first")).alias("min_value"),
        F.coalesce(F.col("_high").cast("string"), F.col("_last")).alias("max_value"),
        F.round(F.try_divide(F.col("_sum"), F.col("_numbers")), 4).alias("mean_value"),
    )


def schema_issues(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Missing or wrongly typed columns, read from the schema only."""
    actual = dict(df.dtypes)
    rows = [
        (name, kind, actual.get(name, "missing"))
        for name, kind in expected.items()
        if actual.get(name, "missing").split("(")[0] != kind
    ]
    return df.sparkSession.createDataFrame(rows, "field_name string, expected_value string, actual_value string")
