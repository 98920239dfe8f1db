"""Helpers of the corpus operators: reading, staging, and ranks that no single task holds."""

from __future__ import annotations

import ctypes
import sys
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navrecon.session import fresh_dir

#: The characters [\x20\x09-\x0D]: white space as the contracts mean it.
SPACE = " \t\n\x0b\x0c\r"
#: A null id counts as this one, larger than any real id.
NO_ID = 2**63 - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows that one ranked block may hold on average.
BLOCK_ROWS = 100_000
#: Bytes of texts that a Python worker is handed at a time.
BATCH_BYTES = 1 << 24
#: The same in operators of the pipeline, whose workers and executors keep memory from stage to stage.
SMALL_BATCH = 1 << 22


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends, a lost executor costs no recomputation."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_rows(docs: DataFrame, label: str) -> DataFrame:
    """docs with a unique long __row, staged, so that repeated rows stay apart and ids stay fixed."""
    return staged(docs.withColumn("__row", F.monotonically_increasing_id()), label)


def text_of(column: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def importable(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Python workers find this package where the driver found it, and get long texts a few at a time: sets the
    session's spark.sql.execution.arrow.maxBytesPerBatch to batch_bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def leave_room(own: str = "") -> None:
    """A reused Python worker gives up what operators other than own keep in it (vocabularies, word scores, models),
    and its memory goes back to the system."""
    held = [getattr(module, cache) for name, cache in (
        ("toxicity", "_scorer"), ("tokens", "encoder"), ("language", "_scratch"), ("language", "_unpacked"))
        if name != own and (module := sys.modules.get(f"navrecon.llm.{name}"))]
    held = [cache for cache in held if cache.cache_info().currsize]
    for cache in held:
        cache.cache_clear()
    if held:
        trim()


def trim() -> None:
    """Freed memory of this process goes back to the system: Arrow's, and that of its C library where it can do that (glibc)."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """run, a function for mapInArrow, whose worker gives freed memory back at the end of each task: workers stay,
    idle, beside the stages that follow."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return task


def carried(docs: DataFrame, *taken: str) -> Column:
    """The columns of docs that an operator passes through, as one column __doc, so that no name of theirs can
    clash with one of the operator's. A name in taken, which the operator makes itself, gives way."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in taken]).alias("__doc")


def running(df: DataFrame, keys: list[str], tie: list[str], name: str, value: Column | None = None) -> DataFrame:
    """df with column `name`: the sum of value (1: the rank from 0) over the rows before this one among equal keys.

    The order is that of a hash of the tie columns, then of these. It is cut into
    blocks by the hash's leading bits, so that a key with a third of all rows is many
    windows; block totals, a few numbers for each key, link them. keys must not be
    null; rows equal in tie may change places. df should be staged: it is read twice.
    """
    blocks = max(10, (df.count() // BLOCK_ROWS).bit_length())
    value = F.lit(1).cast("long") if value is None else value
    marked = (df.withColumn("__hash", F.xxhash64(*[F.col(c) for c in tie]))
                .withColumn("__block", F.shiftrightunsigned("__hash", 64 - blocks)).withColumn("__value", value))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (marked.groupBy(*keys, "__block").agg(F.sum("__value").alias("__total"))
                    .select(*keys, "__block", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__before")))
    within = (Window.partitionBy(*keys, "__block").orderBy("__hash", *tie)
                    .rowsBetween(Window.unboundedPreceding, -1))
    inner = marked.withColumn("__inner", F.coalesce(F.sum("__value").over(within), F.lit(0)))
    return (inner.join(totals, [*keys, "__block"])
                 .withColumn(name, F.col("__before") + F.col("__inner"))
                 .drop("__hash", "__block", "__value", "__inner", "__before"))


def finite(column: str) -> Column:
    """Is the vector there, with no null and no non-finite component?"""
    v = F.col(f"`{column}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))


def quantised(column: str, scale: float, limit: int) -> Column:
    """floor(scale * x) of each component as a long; what is beyond limit counts as limit."""
    return F.transform(F.col(f"`{column}`"), lambda x: F.floor(F.least(F.lit(float(limit)), F.greatest(
        F.lit(float(-limit)), F.lit(float(scale)) * x.cast("double")))))
