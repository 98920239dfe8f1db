"""Text, date and display helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navrecon.functions.finance import Name, as_col
from navrecon.schemas import DATE_FORMATS


def parse_date(text: Name, formats: list[str] | None = None) -> Column:
    """First listed format that reads the text; null when none does."""
    return F.coalesce(*[F.try_to_date(as_col(text), f) for f in formats or DATE_FORMATS])


def field_label(name: Name) -> Column:
    """net_flow becomes NET FLOW."""
    return F.upper(F.translate(as_col(name), "_", " "))


def suffix_of(name: Name) -> Column:
    return F.lower(F.substring_index(as_col(name), ".", -1))


def base_name(key: Name) -> Column:
    return F.substring_index(as_col(key), "/", -1)


def contains_text(value: Name, search: str | None) -> Column:
    """Case-insensitive plain-text search; an empty search keeps all rows."""
    return F.lit(True) if not search else F.contains(F.lower(as_col(value)), F.lit(search.lower()))


def ilike_text(value: Name, search: str | None) -> Column:
    """Case-insensitive pattern search: % and _ keep their SQL meaning."""
    return F.lit(True) if not search else as_col(value).ilike(f"%{search}%")


def currency(value: Name, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(as_col(value), digits))


def percent(rate: Name) -> Column:
    shown = (as_col(rate).cast("decimal(20,8)") * F.lit(100)).cast("decimal(20,2)")
    return F.concat(shown.cast("string"), F.lit("%"))


def basis_points(rate: Name) -> Column:
    shown = (as_col(rate).cast("decimal(20,8)") * F.lit(10000)).cast("decimal(20,1)")
    return F.concat(shown.cast("string"), F.lit(" bps"))


def rate_tier(rate: Name, good: float = 98, fair: float = 95) -> Column:
    """Dashboard colour band of a pass rate."""
    return (
        F.when(as_col(rate) >= good, "green").when(as_col(rate) >= fair, "amber").otherwise("red")
    )


def since(moment: Name, as_of: str, days: int) -> Column:
    """Look-back filter ending at an explicit date, never at the clock."""
    return as_col(moment) >= F.expr(f"CAST(DATE'{as_of}' - INTERVAL {int(days)} DAYS AS TIMESTAMP_NTZ)")


def surrogate_id(*keys: Name) -> Column:
    """Row id derived from the key: the same on every rerun, unlike a random one."""
    return F.sha2(F.concat_ws("~", *[F.coalesce(as_col(k).cast("string"), F.lit("")) for k in keys]), 256)
