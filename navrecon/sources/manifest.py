"""Which arrived files to process, by which vendor rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navrecon.functions.text import base_name, suffix_of
from navrecon.schemas import DEFAULT_VENDOR, SKIPPED_PREFIXES, VENDOR_NAME_PARTS, VENDOR_SUFFIXES
from navrecon.sources.files import decoded


def vendor_of(name: Column | str) -> Column:
    """Vendor named in a file name; vendors are tried in order, first hit wins."""
    low = F.lower(F.col(name) if isinstance(name, str) else name)
    chain = F
    for vendor, parts in VENDOR_NAME_PARTS.items():
        hit = reduce(lambda a, b: a | b, [F.contains(low, F.lit(part)) for part in parts])
        chain = chain.when(hit, F.lit(vendor))
    return chain.otherwise(F.lit(DEFAULT_VENDOR))


def format_allowed(name: Column | str, vendor: Column | str) -> Column:
    """Does the suffix suit the vendor? Unknown vendors accept nothing."""
    vendor = F.col(vendor) if isinstance(vendor, str) else vendor
    chain = F
    for known, suffixes in VENDOR_SUFFIXES.items():
        chain = chain.when(vendor == known, suffix_of(name).isin(suffixes))
    return chain.otherwise(F.lit(False))


def route_files(files: DataFrame, encoded: bool = True) -> DataFrame:
    """Add the bare name and the vendor of each file key, as events name it: URL-encoded.

    A key that is no valid encoding is taken as it stands. For keys of list_arrivals,
    which are not encoded, set encoded=False.
    """
    named = files.withColumn("file_name", base_name(decoded("file_key") if encoded else F.col("file_key")))
    return named.withColumn("vendor", vendor_of("file_name"))


def validate_format(routed: DataFrame) -> DataFrame:
    return routed.withColumn("format_ok", format_allowed("file_name", "vendor"))


def ready_files(files: DataFrame) -> DataFrame:
    """Files outside the working folders that are not empty."""
    skipped = reduce(lambda a, b: a | b, [F.startswith("file_key", F.lit(p)) for p in SKIPPED_PREFIXES])
    return files.where(~skipped & (F.col("file_size") > 0))


def unprocessed_files(files: DataFrame, log: DataFrame, key: str = "file_name") -> DataFrame:
    """Files with no row in the processing log."""
    return files.join(log.select(key).distinct(), key, "left_anti")
