import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from navrecon.session import build_session  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over named literals."""
    def value(expression, **inputs):
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or [F.lit(1)])
        return row.select(expression.alias("v")).first()["v"]
    return value


MONEY_COLUMNS = [
    "beginning_market_value", "ending_market_value", "contributions", "distributions", "income",
    "appreciation", "fees", "other_adjustments", "net_flow",
]


def money(value):
    return None if value is None else Decimal(str(value))


@pytest.fixture
def perf(spark):
    """Performance rows from short dictionaries; missing fields are null."""
    schema = "period_id long, account_id string, as_of_date date, portfolio_id string, " + ", ".join(
        f"{c} decimal(18,2)" for c in MONEY_COLUMNS
    ) + (", calculated_twrr decimal(12,8), vendor_twrr decimal(12,8), twrr_variance decimal(12,8), "
         "twrr_tolerance_check boolean, data_source string, file_name string, reconciliation_status string, "
         "created_at timestamp_ntz, updated_at timestamp_ntz")
    names = [part.split()[0] for part in schema.replace("(18,2)", "").replace("(12,8)", "").split(", ")]
    fixed = {"data_source": "vendor_a", "file_name": "f.csv", "reconciliation_status": "PENDING",
             "as_of_date": dt.date(2024, 1, 31), "account_id": "ACC001",
             "created_at": dt.datetime(2024, 2, 1), "updated_at": dt.datetime(2024, 2, 1)}
    decimals = {*MONEY_COLUMNS, "calculated_twrr", "vendor_twrr", "twrr_variance"}

    def build(*rows):
        out = []
        for number, row in enumerate(rows):
            full = {**fixed, "period_id": number, **row}
            out.append(tuple(money(full.get(n)) if n in decimals else full.get(n) for n in names))
        return spark.createDataFrame(out, schema)
    return build
