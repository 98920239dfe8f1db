"""Running sums and products per account that do not put a hot account in one task.

A window over account_id sends all rows of an account to one task. That is the
cheapest plan for accounts of ordinary size and keeps being used for them. The
accounts above a row limit are found first by a count (folded before the shuffle,
one column read); their number is bounded by rows / limit. Their rows are dealt by
ranges of (account, date, tie-break) into chunks of about equal size, however sparse
the tie-break is and however many rows a day has, and staged, so that both readers
see the same chunks. Each chunk has one total for each account in it; a window over
those totals, one for about chunk_rows rows, gives every chunk its opening balance,
which enters the chunk as its first row, so one window over chunks yields the exact
running value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from navrecon.functions.finance import growth_factor
from navrecon.session import broadcast_if_small, fresh_dir

CHUNK_ROWS = 1 << 20
HOT_ROWS = 1 << 22


def running_metrics(
    df: DataFrame,
    sums: dict[str, Column] | None = None,
    products: dict[str, Column] | None = None,
    account: str = "account_id",
    date: str = "as_of_date",
    tie: str = "period_id",
    chunk_rows: int = CHUNK_ROWS,
    hot_above: int | None = HOT_ROWS,
) -> DataFrame:
    """Add running sums and running products over (date, tie) within an account.

    tie must be unique within an account's day. Product inputs must not be null; sum
    inputs may be. The accounts with more than hot_above rows are counted, and their rows
    staged, when the plan is built; None skips the count, for rows already unique per
    account and date.
    """
    sums, products = sums or {}, products or {}
    inputs = df.select(
        "*", *[value.alias(f"_in_{name}") for name, value in {**sums, **products}.items()])
    folds = {name: (F.product if name in products else F.sum) for name in [*sums, *products]}

    hot = None if hot_above is None else hot_accounts(df, account, hot_above)
    if hot is None:
        out = _whole_accounts(inputs, folds, account, date, tie)
    else:
        same = inputs[account].eqNullSafe(hot["_hot"])
        whole = _whole_accounts(inputs.join(hot, same, "left_anti"), folds, account, date, tie)
        rows = hot.agg(F.sum("_n")).first()[0]
        chunked = _in_chunks(inputs.join(hot, same, "left_semi"), folds, account, date, tie, -(-rows // chunk_rows))
        # A sum of sums is a wider decimal; the result has the type that it has without hot accounts.
        out = whole.unionByName(chunked.withColumns({
            name: F.col(name).cast(whole.schema[name].dataType) for name in folds}))
    return out.drop(*[f"_in_{name}" for name in folds])


def hot_accounts(df: DataFrame, account: str, above: int) -> DataFrame | None:
    """Accounts with more than `above` rows, ready for broadcast, or None.

    Null counts as an account. The list is counted once and kept on shared
    storage, so both halves of the split see the same list.
    """
    found = df.groupBy(F.col(account).alias("_hot")).agg(F.count("*").alias("_n")).where(F.col("_n") > above)
    kept = broadcast_if_small(found, max_rows=1_000_000)
    return None if kept.isEmpty() else kept


def _fold(fold, name: str, over: WindowSpec) -> Column:
    return fold(F.col(f"_in_{name}")).over(over).alias(name)


def _whole_accounts(inputs: DataFrame, folds: dict, account: str, date: str, tie: str) -> DataFrame:
    upto = (
        Window.partitionBy(account).orderBy(date, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return inputs.select("*", *[_fold(fold, name, upto) for name, fold in folds.items()])


def _in_chunks(
    inputs: DataFrame, folds: dict, account: str, date: str, tie: str, chunks: int
) -> DataFrame:
    folder = fresh_dir(inputs.sparkSession, "hot-rows")
    dealt = inputs.repartitionByRange(chunks, account, date, tie).withColumn("_chunk", F.spark_partition_id())
    dealt.write.parquet(folder)
    inputs = inputs.sparkSession.read.schema(dealt.schema).parquet(folder)
    chunk = [account, "_chunk"]
    totals = inputs.groupBy(*chunk).agg(
        *[fold(F.col(f"_in_{name}")).alias(f"_in_{name}") for name, fold in folds.items()])
    before = (
        Window.partitionBy(account).orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    opening = totals.select(
        *chunk, F.lit(0).alias("_row"),
        *[fold(F.col(f"_in_{name}")).over(before).alias(f"_in_{name}") for name, fold in folds.items()])
    upto = (
        Window.partitionBy(*chunk).orderBy("_row", date, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stacked = inputs.withColumn("_row", F.lit(1)).unionByName(opening, allowMissingColumns=True)
    return (
        stacked.select("*", *[_fold(fold, name, upto) for name, fold in folds.items()])
        .where(F.col("_row") == 1)
        .drop("_chunk", "_row")
    )


def cumulative_metrics(
    df: DataFrame,
    period: str = "calculated_twrr",
    flow: str = "net_flow",
    mode: str = "product",
    **layout,
) -> DataFrame:
    """Add cumulative_twrr and cumulative_net_flow in one pass.

    mode="product" multiplies the factors. mode="log" is exp(sum(ln(factor))),
    in which a factor at or below zero has no logarithm and is passed over.
    """
    sums = {"cumulative_net_flow": F.coalesce(F.col(flow), F.lit(0))}
    if mode == "log":
        sums["_growth"] = F.coalesce(F.ln(growth_factor(period)), F.lit(0.0))
        out = running_metrics(df, sums, {}, **layout)
        growth = F.exp("_growth")
    else:
        out = running_metrics(df, sums, {"_growth": growth_factor(period)}, **layout)
        growth = F.col("_growth")
    return out.withColumn("cumulative_twrr", growth - F.lit(1.0)).drop("_growth")
