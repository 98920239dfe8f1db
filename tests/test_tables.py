import datetime as dt
from decimal import Decimal

import pytest

from navrecon.operators import latest, reconcile, report
from navrecon.plans import carry, flows, summary
from navrecon.session import fresh_dir
from navrecon.sources import mapping, projection, store
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def test_keep_latest_prefers_the_newest_then_the_highest_id(perf):
    day = dt.datetime(2024, 3, 1)
    df = perf({"income": 1}, {"income": 2, "updated_at": day}, {"income": 3, "updated_at": day},
              {"account_id": "B", "income": 4})
    got = {(r.account_id, r.income) for r in latest.keep_latest(df).collect()}
    assert got == {("ACC001", Decimal("3.00")), ("B", Decimal("4.00"))}


def test_keep_latest_limits_each_map_task(perf):
    plan = latest.keep_latest(perf({}))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_insert_if_absent_twice_changes_nothing(spark):
    old = spark.createDataFrame([("A", "old", 1)], "account_id string, name string, n int")
    new = spark.createDataFrame([("A", "new", 1), ("B", "first", 1), ("B", "second", 2)], old.schema)
    once = latest.insert_if_absent(old, new, ("account_id",), ("n",))
    assert {(r[0], r[1]) for r in once.collect()} == {("A", "old"), ("B", "first")}
    assert sorted(latest.insert_if_absent(once, new, ("account_id",), ("n",)).collect()) == sorted(once.collect())


def test_update_status_touches_one_file(perf):
    df = perf({"file_name": "x.csv"}, {"file_name": "y.csv"})
    out = {r.file_name: (r.reconciliation_status, r.updated_at.year)
           for r in latest.update_status(df, "x.csv", "vendor_a", "COMPLETED", stamp("2030-01-01")).collect()}
    assert out == {"x.csv": ("COMPLETED", 2030), "y.csv": ("PENDING", 2024)}


def test_partitioned_store_upsert_and_status(spark, perf):
    path = fresh_dir(spark, "perf")
    first = perf({"as_of_date": dt.date(2024, 1, 31), "income": 1}, {"as_of_date": dt.date(2024, 2, 29), "income": 1})
    newest = ("updated_at", "period_id")
    store.upsert_performance(spark, path, first, newest)
    later = perf({"as_of_date": dt.date(2024, 2, 29), "income": 9, "updated_at": dt.datetime(2025, 1, 1)},
                 {"as_of_date": dt.date(2024, 3, 31), "income": 9})
    for _ in range(2):  # a rerun must not change the table
        store.upsert_performance(spark, path, later, newest)
        got = {(str(r.as_of_date), int(r.income)) for r in store.read_performance(spark, path).collect()}
        assert got == {("2024-01-31", 1), ("2024-02-29", 9), ("2024-03-31", 9)}
    store.set_file_status(spark, path, "f.csv", "vendor_a", "COMPLETED", stamp("2030-01-01"))
    assert {r.reconciliation_status for r in store.read_performance(spark, path).collect()} == {"COMPLETED"}
    assert store.read_performance(spark, path).count() == 3


def test_date_range_prunes_partitions(spark, perf):
    path = fresh_dir(spark, "prune")
    store.append_performance(perf(*[{"as_of_date": dt.date(2024, m, 1)} for m in range(1, 13)]), path)
    df = store.read_performance(spark, path, "2024-03-01", "2024-04-30")
    assert df.count() == 2
    assert {f.split("as_of_month=")[1].split("/")[0] for f in df.inputFiles()} == {"3", "4"}


def test_export_keeps_order(spark):
    path = fresh_dir(spark, "export")
    store.export_csv(spark.range(100).orderBy(F.desc("id")), path, single_file=True)
    got = [int(r.id) for r in spark.read.option("header", True).csv(path).collect()]
    assert got == list(range(99, -1, -1))


def test_log_counts_add_up(spark):
    rows = projection.performance(spark, DATA)
    log = flows.processing_log(rows)
    total = log.agg(F.sum("records_processed"), F.sum(F.col("records_inserted") + F.col("records_updated"))).first()
    assert total[0] == total[1] == rows.count()


def month_rows(perf, day, **values):
    return perf(*[{"as_of_date": dt.date(*day), **v} for v in ([values] if values else [{}])])


def test_a_write_that_fails_before_its_manifest_changes_nothing(spark, perf, monkeypatch):
    path = fresh_dir(spark, "perf")
    newest = ("updated_at",)
    store.upsert_performance(spark, path, month_rows(perf, (2024, 1, 31), income=1), newest)
    later = perf({"as_of_date": dt.date(2024, 1, 31), "income": 2, "updated_at": dt.datetime(2025, 1, 1)},
                 {"as_of_date": dt.date(2024, 2, 29), "income": 2})
    rows = lambda: {(r.as_of_date.month, int(r.income)) for r in store.read_performance(spark, path).collect()}

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "commit", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            store.upsert_performance(spark, path, later, newest)
    assert rows() == {(1, 1)}
    store.upsert_performance(spark, path, later, newest)
    assert rows() == {(1, 2), (2, 2)}


def test_two_writers_do_not_overwrite_each_other(spark, perf, monkeypatch):
    path = fresh_dir(spark, "perf")
    store.append_performance(month_rows(perf, (2024, 1, 31)), path)
    seen = store._manifests(spark, path)
    store.append_performance(month_rows(perf, (2024, 2, 29)), path)
    with monkeypatch.context() as patch:
        patch.setattr(store, "_manifests", lambda *_: seen)
        with pytest.raises(RuntimeError, match="another writer"):
            store.append_performance(month_rows(perf, (2024, 3, 31)), path)
    assert {r.as_of_date.month for r in store.read_performance(spark, path).collect()} == {1, 2}
    with pytest.raises(ValueError, match="without as_of_date"):
        store.append_performance(perf({"as_of_date": None}), path)
    assert store.read_performance(spark, path).count() == 2


def account_days(perf, days):
    return perf(*[{"account_id": a, "as_of_date": dt.date(2024, m, d), "net_flow": f, "calculated_twrr": r, "file_name": n}
                  for a, m, d, f, r, n in days])


def test_running_values_over_loads_in_any_order(spark, perf):
    days = [("A", 1, 5, 10, "0.1", "x"), ("A", 1, 20, 1, "-0.5", "y"), ("A", 3, 1, 5, None, "x"), ("A", 4, 2, 0, "2", "y"),
            ("B", 2, 2, 7, "0.3", "x"), ("B", 4, 1, None, "-1.5", "y"), ("C", 4, 9, 3, "0.01", "x")]
    found = []
    for order in (["xy"], ["x", "y"], ["y", "x"], ["y", "x", "y"]):
        path = fresh_dir(spark, "perf")
        for names in order:
            carry.upsert_running(spark, path, account_days(perf, [d for d in days if d[5] in names]), ("updated_at", "file_name"))
        found.append(sorted((r.account_id, r.as_of_date, r.cumulative_net_flow, round(r.cumulative_twrr, 12))
                            for r in store.read_performance(spark, path).collect()))
    assert found[0] == found[1] == found[2] == found[3]
    assert [(float(f), g) for a, _, f, g in found[0] if a == "A"] == [(10, 0.1), (11, -0.45), (16, -0.45), (16, 0.65)]


def test_only_months_of_the_loaded_accounts_are_restated(spark, perf):
    path, newest = fresh_dir(spark, "perf"), ("updated_at", "file_name")
    carry.upsert_running(spark, path, account_days(perf, [("A", 1, 5, 1, "0.1", "x"), ("B", 2, 5, 1, "0.1", "x"), ("A", 3, 5, 1, "0.1", "x")]), newest)
    before = {e[:2]: e.version for e in store.entries(spark, path)}
    done = carry.upsert_running(spark, path, account_days(perf, [("A", 1, 6, 1, "0.1", "y"), ("A", 1, 5, 9, "0.1", "z")]), newest)
    after = {e[:2]: e.version for e in store.entries(spark, path)}
    assert {m for m in after if after[m] != before[m]} == {(2024, 1), (2024, 3)}
    assert (done.inserted, done.updated) == (1, 1)
    assert [int(r.cumulative_net_flow) for r in store.read_performance(spark, path).where("account_id = 'A'").orderBy("as_of_date").collect()] == [9, 10, 11]
    # Totals outlive a status change, and are added up anew for months written without them.
    store.set_file_status(spark, path, "x", "vendor_a", "COMPLETED", stamp("2030-01-01"))
    assert all(e.totals for e in store.entries(spark, path))
    store.replace_partitions(store.stored_rows(spark, path, [(2024, 1)]).drop(*store.PARTITIONS), path)
    assert [e.totals is None for e in store.entries(spark, path)] == [True, False, False]
    carry.upsert_running(spark, path, account_days(perf, [("A", 4, 6, 1, "0.1", "y")]), newest)
    assert int(store.read_performance(spark, path, "2024-04-01").first().cumulative_net_flow) == 12


def same_rows(a, b):
    order = sorted(a.columns)
    assert sorted(b.columns) == order
    plain = lambda df: sorted(map(repr, df.select(*order).collect()))
    assert plain(a) == plain(b)


def test_summaries_from_parts_equal_full_scans(spark):
    """After a load, a rerun, a second file and a status change, whichever months were refreshed."""
    path, day = fresh_dir(spark, "perf"), "2001-08-02"
    rows = mapping.conform(latest.keep_latest(projection.performance(spark, DATA)))
    for change in (
        lambda: carry.upsert_running(spark, path, rows.where("data_source = 'vendor_a'"), ("updated_at", "file_name")),
        lambda: carry.upsert_running(spark, path, rows.where("data_source = 'vendor_a'"), ("updated_at", "file_name")),
        lambda: carry.upsert_running(spark, path, rows.where("data_source != 'vendor_a' and month(as_of_date) < 7"), ("updated_at", "file_name")),
        lambda: store.set_file_status(spark, path, "vendor_a_performance_1997.csv", "vendor_a", "COMPLETED", stamp(day)),
    ):
        change()
        whole = store.read_performance(spark, path)
        parts = summary.parts(spark, path)
        same_rows(summary.vendor_list(parts), report.vendor_list(whole))
        with pytest.raises(ValueError, match="refresh"):
            summary.account_bits(spark, path)
        summary.refresh(spark, path)
        parts, bits = summary.parts(spark, path), summary.account_bits(spark, path)
        assert "rows/version" not in "".join(parts.inputFiles() + bits.inputFiles())
        same_rows(summary.file_list(parts), report.file_list(whole))
        same_rows(summary.daily_volume(parts, day, 900), report.daily_volume(whole, day, 900))
        same_rows(summary.dashboard_metrics(parts, bits, day, 900), report.dashboard_metrics(whole, day, 900))
        same_rows(summary.file_details(parts, bits).withColumn("avg_twrr", F.round("avg_twrr", 9)),
                  report.file_details(whole).withColumn("avg_twrr", F.round("avg_twrr", 9)))
    assert len({e.summary for e in store.entries(spark, path)}) > 1


def test_bucketed_tables_join_without_a_shuffle(spark):
    root = fresh_dir(spark, "bucketed")
    rows = latest.keep_latest(projection.performance(spark, DATA))
    read = []
    for name, df in (("rows", mapping.conform(rows)), ("checks", reconcile.results(rows))):
        store.write_bucketed(df, f"{name}_{root[-8:]}", f"{root}/{name}", 4)
        spark.sql(f"DROP TABLE {name}_{root[-8:]}")  # another session: the files stay
        read.append(store.open_bucketed(spark, f"{name}_{root[-8:]}", f"{root}/{name}", df.schema, 4))
    joined = report.recon_results(read[1], read[0])
    # Even where neither side could be broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joined.count() == reconcile.results(rows).count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
