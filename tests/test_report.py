import datetime as dt

from navrecon.operators import latest, reconcile, report
from navrecon.sources import projection
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_page_info(spark):
    counts = spark.createDataFrame([(1000,), (10,)], "total long")
    rows = {r.total: r for r in report.page_info(counts, size=20, current=5).collect()}
    assert (rows[1000].pages, rows[1000].row_offset, rows[1000].has_prev, rows[1000].has_next) == (50, 80, True, True)
    assert (rows[1000].prev_num, rows[1000].next_num) == (4, 6)
    assert (rows[10].pages, rows[10].has_next, rows[10].next_num) == (1, False, None)
    assert report.estimated_total(7, 20, 3) == 47 and report.estimated_total(20, 20, 3) == 61


def test_keyset_pages_equal_offset_pages(spark):
    rows = report.account_rows(latest.keep_latest(projection.performance(spark, DATA)))
    order = [F.col("account_id"), F.col("as_of_date").desc()]
    seen, last = [], None
    for _ in range(3):
        got = report.next_page(rows, last, size=25).collect()
        seen += [(r.account_id, r.as_of_date) for r in got]
        last = (seen[-1][0], str(seen[-1][1]))
    assert seen == [(r.account_id, r.as_of_date) for r in report.page(rows, order, size=75).collect()]


def test_a_page_is_a_top_k(spark):
    rows = report.account_rows(projection.performance(spark, DATA))
    plan = report.page(rows, [F.col("account_id"), F.col("as_of_date")], 10, 20)._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_status_rollup(perf):
    def status(*values):
        return report.file_list(perf(*[{"reconciliation_status": v} for v in values])).first().overall_status
    assert status("COMPLETED", "COMPLETED") == "COMPLETED"
    assert status("COMPLETED", "COMPLETED_WITH_ISSUES", "PENDING") == "COMPLETED_WITH_ISSUES"
    assert status("COMPLETED", "PENDING") == "PROCESSING"


def test_result_filters_and_one_match_per_check(perf):
    rows = perf({"account_id": "A", "calculated_twrr": "0.1", "vendor_twrr": "0.2"},
                {"account_id": "B", "file_name": "g.csv", "calculated_twrr": "0.1", "vendor_twrr": "0.1"})
    results = reconcile.results(rows)
    assert report.recon_results(results, rows).count() == 6
    assert report.recon_results(results, rows, file_name="g.csv", field_name="twrr").count() == 1
    assert report.recon_results(results, rows, failures_only=True).count() == 1
    assert report.recon_results(results, rows, account_search="b").count() == 3
    assert report.recon_results(results, rows, date_range=("2025-01-01", "2025-12-31")).count() == 0


def test_missing_verdicts_count_in_the_total_only(perf):
    rows = perf({"calculated_twrr": "0.1"}, {"account_id": "B", "calculated_twrr": "0.1", "vendor_twrr": "0.1"})
    got = {r.field_name: r for r in report.recon_summary(reconcile.results(rows), rows, "2024-02-10").collect()}
    twrr = got["twrr"]
    assert (twrr.total_checks, twrr.passed_checks, twrr.failed_checks, twrr.pass_rate) == (2, 1, 0, 50.0)
    assert twrr.field_label == "TWRR" and twrr.tier == "red"
    assert report.recon_summary(reconcile.results(rows), rows, "2024-04-10", 30).count() == 0


def test_empty_totals_give_null_rates(perf):
    none = perf({}).where("1 = 0")
    assert report.recon_overall(reconcile.results(none), "2024-02-10").first().overall_pass_rate is None
    assert report.dashboard_metrics(none, "2024-02-10").first().total_records == 0


def test_dashboard_counts_distinct_after_folding(perf):
    rows = perf({"account_id": "A"}, {"account_id": "A"}, {"account_id": "B", "file_name": "g.csv"})
    row = report.dashboard_metrics(rows, "2024-02-10", 30).first()
    assert (row.total_files_processed, row.total_vendors, row.total_accounts, row.total_records) == (2, 1, 2, 3)


def test_history_months_have_thirty_days(perf):
    rows = perf(*[{"as_of_date": d} for d in (dt.date(2024, 1, 31), dt.date(2024, 3, 1), dt.date(2024, 3, 31))])
    assert report.account_history(rows, "2024-03-31", 1).count() == 2


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet(f"{DATA}/orders.parquet").withColumnRenamed("o_orderstatus", "data_source")
    plan = report.where_equal(df, data_source="F").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan
