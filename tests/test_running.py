import datetime as dt
import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from navrecon.operators import running
from navrecon.operators.running import cumulative_metrics, hot_accounts, running_metrics
from navrecon.session import fresh_dir
from pyspark.sql import functions as F


def rows_with_hot_account(n=600, seed=7):
    """A third of all rows in one account, a third of those on one day."""
    rng = random.Random(seed)
    out = []
    for number in rng.sample(range(10 * n), n):
        account = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", "d", None])
        day = 5 if account == "hot" and rng.random() < 0.33 else rng.randrange(20)
        rate = rng.choice([None, Decimal("-1.5"), Decimal("-1"), Decimal(rng.randrange(-300, 300)) / 10000])
        flow = rng.choice([None, Decimal(rng.randrange(-99999, 99999)) / 100])
        out.append((number, account, dt.date(2024, 1, 1) + dt.timedelta(day), flow, rate))
    return out


SCHEMA = "period_id long, account_id string, as_of_date date, net_flow decimal(18,2), calculated_twrr decimal(12,8)"


def brute(rows, log=False):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    out = {}
    for group in groups.values():
        total, growth = Decimal(0), 1.0
        for row in sorted(group, key=lambda r: (r[2], r[0])):
            total += row[3] or 0
            factor = 1 + float(row[4] or 0)
            growth *= (factor if factor > 0 else 1.0) if log else factor
            out[row[0]] = (total, growth - 1)
    return out


@pytest.mark.parametrize("width", [1, 40, 1 << 20])
@pytest.mark.parametrize("hot_above", [0, 150, 10_000])
@pytest.mark.parametrize("mode", ["product", "log"])
def test_running_values_match_brute_force(spark, width, hot_above, mode):
    rows = rows_with_hot_account()
    df = spark.createDataFrame(rows, SCHEMA)
    out = cumulative_metrics(df, mode=mode, chunk_rows=width, hot_above=hot_above).collect()
    expected = brute(rows, log=mode == "log")
    assert len(out) == len(rows)
    for row in out:
        total, growth = expected[row.period_id]
        assert row.cumulative_net_flow == total
        assert math.isclose(row.cumulative_twrr, growth, rel_tol=1e-9, abs_tol=1e-9)


def test_golden_cumulative_return(spark):
    rates = ["0.01", "0.02", "-0.005", "0.015", "0.008"]
    rows = [(i, "a", dt.date(2024, 1, i + 1), None, Decimal(r)) for i, r in enumerate(rates)]
    out = cumulative_metrics(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(out, key=lambda r: r.period_id).cumulative_twrr == pytest.approx(0.048748, abs=1e-6)


def test_total_loss_stays_in_the_product_but_not_in_the_log(spark):
    rows = [(i, "a", dt.date(2024, 1, i + 1), None, Decimal(r)) for i, r in enumerate(["0.1", "-1.5", "1"])]
    df = spark.createDataFrame(rows, SCHEMA)
    values = {m: [r.cumulative_twrr for r in sorted(cumulative_metrics(df, mode=m).collect(), key=lambda r: r.period_id)]
              for m in ("product", "log")}
    assert values["product"] == pytest.approx([0.1, -1.55, -2.1])
    assert values["log"] == pytest.approx([0.1, 0.1, 1.2])


def test_hot_accounts_are_found_and_null_is_an_account(spark):
    rows = [(i, a, dt.date(2024, 1, 1), None, None) for i, a in enumerate(["a"] * 3 + ["b"] * 2 + [None] * 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r[0] for r in hot_accounts(df, "account_id", 2).collect()} == {"a", None}
    assert hot_accounts(df, "account_id", 4) is None


def test_a_hot_account_is_dealt_into_equal_chunks(spark, monkeypatch):
    """A third of all rows in one account, a third of those on one day, tie-breaks far apart: no task has many of them."""
    rows = [(i * 10**9 + 7, "hot" if i % 3 == 0 else f"a{i % 500}", dt.date(2024, 1, 1) + dt.timedelta(i % 7 if i % 9 else 0),
             Decimal(1), None) for i in range(30_000)]
    folders = []
    monkeypatch.setattr(running, "fresh_dir", lambda s, label: folders.append(fresh_dir(s, label)) or folders[-1])
    out = running_metrics(spark.createDataFrame(rows, SCHEMA), {"s": F.col("net_flow")}, hot_above=5000, chunk_rows=500)
    assert out.where("account_id = 'hot'").agg(F.max("s")).first()[0] == 10_000 and out.count() == 30_000
    sizes = [r[0] for r in spark.read.parquet(folders[0]).groupBy("account_id", "_chunk").count().select("count").collect()]
    assert sum(sizes) == 10_000 and len(sizes) >= 18 and max(sizes) < 1000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Ordinary accounts, hot chunks, and the totals of hot accounts, one for each chunk.
    assert len(windows) == 3 and sum("_chunk" in w.rsplit("], [", 1)[0] for w in windows) >= 1


@pytest.mark.parametrize("hot", [None, 0, 3, 10**6])
def test_types_do_not_depend_on_size(perf, hot):
    rows = perf(*[{"account_id": "A" if i % 2 else f"B{i}", "as_of_date": dt.date(2024, 1, 1) + dt.timedelta(i),
                   "net_flow": i} for i in range(12)])
    out = cumulative_metrics(rows, hot_above=hot, chunk_rows=4)
    assert dict(out.dtypes)["cumulative_net_flow"] == "decimal(28,2)" and dict(out.dtypes)["cumulative_twrr"] == "double"
    assert sum(r.cumulative_net_flow for r in out.where("account_id = 'A'").collect()) == sum(
        sum(range(1, i + 1, 2)) for i in range(1, 12, 2))
