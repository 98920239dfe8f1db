import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from navrecon.operators import quality
from navrecon.plans import flows
from navrecon.schemas import FIELD_ALIASES, PERFORMANCE, QUALITY_ISSUES
from navrecon.session import fresh_dir
from navrecon.sources import files, manifest, mapping, store
from pyspark.sql import functions as F

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")

CSV = """acct_id,acct_name,port_id,report_date,beginning_mv,deposits,withdrawals,dividend,unrealized_gl,management_fee,adjustments,ending_mv,bmk_return,twr
ACC001,One,P1,01/31/2024,100000,5000,2000,1200,800,300,300,105000,0.01,0.0345
ACC001,One,P1,2024-02-29,105000,0,0,0,0,0,0,106050,0.01,0.0100
ACC002,Two,P1,2024-01-31,,0,0,0,0,0,0,oops,0.01,
"""


def write(spark, name, text):
    folder = fresh_dir(spark, "in")
    os.makedirs(folder)
    with open(f"{folder}/{name}", "w") as out:
        out.write(text)
    return f"{folder}/{name}"


def test_csv_values_stay_text(spark):
    df = files.read_vendor_file(spark, write(spark, "vendor_a_1.csv", CSV))
    assert {kind for _, kind in df.dtypes} == {"string"} and df.count() == 3


def test_json_array_is_flattened(spark):
    record = {"account": {"id": "ACC001", "name": "Test Account"}, "reporting": {
        "period_end": "2024-01-31", "market_values": {"beginning": 100000, "ending": 105000},
        "returns": {"time_weighted": 0.0234}}}
    df = files.read_vendor_file(spark, write(spark, "vendor_c_1.json", json.dumps([record, record], indent=2)))
    assert df.columns == list(FIELD_ALIASES)
    row = mapping.cast_types(df).first()
    assert (row.account_id, row.beginning_market_value, row.vendor_twrr, row.fees) == (
        "ACC001", Decimal("100000.00"), Decimal("0.02340000"), None)
    assert df.count() == 2


def test_other_suffixes_are_refused(spark):
    with pytest.raises(ValueError, match="unsupported"):
        files.read_vendor_file(spark, "/nowhere/x.xlsx")


def test_names_resolve_case_free_and_standard_first():
    assert mapping.resolve_names(["ACCT_ID", "interest", "Dividend"]) == {
        "account_id": "ACCT_ID", "income": "Dividend"}
    assert mapping.resolve_names(["beginning_mv", "beginning_market_value"]) == {
        "beginning_market_value": "beginning_market_value"}


def test_settings_load(spark):
    path = write(spark, "m.json", json.dumps({"field_mappings": {"fees": ["cost"]}}))
    aliases = mapping.load_settings(spark, path)["field_mappings"]
    assert mapping.resolve_names(["Cost"], aliases) == {"fees": "Cost"}


def test_conform_orders_and_types(spark):
    df = mapping.conform(spark.createDataFrame([("x", "A")], "extra string, account_id string"))
    assert df.schema.names == PERFORMANCE.names and len(df.columns) == 24
    assert [f.dataType for f in df.schema] == [f.dataType for f in PERFORMANCE]


def test_defaults(perf):
    row = mapping.with_defaults(perf({"reconciliation_status": None})).first()
    assert (row.contributions, row.fees, row.reconciliation_status) == (0, 0, "PENDING")


@pytest.mark.parametrize("name, vendor", [
    ("vendor_a_performance_2024.csv", "vendor_a"), ("vendorb_data_january.xlsx", "vendor_b"),
    ("vc_monthly_report.json", "vendor_c"), ("unknown_file.txt", "vendor_a"),
    ("va_vb_.csv", "vendor_a"), ("VENDOR_C_X.JSON", "vendor_c"),
])
def test_vendor_of(one, name, vendor):
    assert one(manifest.vendor_of("x"), x=name) == vendor


@pytest.mark.parametrize("name, vendor, ok", [
    ("file.csv", "vendor_a", True), ("file.xlsx", "vendor_b", True), ("file.json", "vendor_c", True),
    ("file.txt", "vendor_a", False), ("file.xlsx", "vendor_a", False), ("file.csv", "vendor_x", False),
])
def test_format_allowed(one, name, vendor, ok):
    assert one(manifest.format_allowed("n", "v"), n=name, v=vendor) is ok


def test_ready_and_unprocessed(spark):
    found = spark.createDataFrame([
        ("incoming/va_1.csv", 5), ("incoming/va_2.csv", 0), ("archive/va_3.csv", 5), ("incoming/a%20b+c.csv", 5),
    ], "file_key string, file_size long")
    ready = manifest.ready_files(manifest.route_files(found))
    assert {r.file_name for r in ready.collect()} == {"va_1.csv", "a b c.csv"}
    log = spark.createDataFrame([("va_1.csv",)], "file_name string")
    assert [r.file_name for r in manifest.unprocessed_files(ready, log).collect()] == ["a b c.csv"]


def test_arrivals_are_listed_by_suffix(spark):
    folder = fresh_dir(spark, "arrivals")
    os.makedirs(f"{folder}/incoming/deep")
    for name in ("va_1.csv", "vc_1.json", "notes.txt", "deep/vb_1.xlsx"):
        with open(f"{folder}/incoming/{name}", "w") as out:
            out.write("x")
    got = {r.file_key: r.file_size for r in files.list_arrivals(spark, folder).collect()}
    assert got == {"incoming/va_1.csv": 1, "incoming/vc_1.json": 1, "incoming/deep/vb_1.xlsx": 1}


def test_process_file_end_to_end(spark):
    path, target = write(spark, "vendor_a_1.csv", CSV), fresh_dir(spark, "table")
    for _ in range(2):  # loading the same file again changes nothing
        result = flows.process_file(spark, path, "vendor_a", target, now())
        assert (result.status, result.total_records, result.valid_records) == ("SUCCESS", 3, 2)
        rows = {(r.account_id, str(r.as_of_date)): r for r in store.read_performance(spark, target).collect()}
        assert len(rows) == 2 and (result.stored, result.rejected, result.duplicates) == (2, 1, 0)
    assert (result.inserted, result.updated) == (0, 2)
    first, second = rows["ACC001", "2024-01-31"], rows["ACC001", "2024-02-29"]
    assert first.calculated_twrr == Decimal("0.03448276") and first.net_flow == 3000
    assert first.twrr_tolerance_check is True
    assert second.cumulative_twrr == pytest.approx(1.03448276 * 1.01 - 1)
    left = spark.read.parquet(f"{target}-rejected").collect()
    assert [(r.account_id, r.ending_market_value, r.reject_reason) for r in left] == [("ACC002", "oops", "invalid_value")]
    found = {r.issue_type for r in store.read_parts(spark, f"{target}-issues", QUALITY_ISSUES).collect()}
    assert found == {"invalid_ending_market_value_type"}
    log = flows.log_row(spark, result, path, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1, 0, 5)).first()
    assert (log.records_processed, log.records_updated, log.records_failed) == (3, 2, 1)
    assert log.status == "COMPLETED_WITH_WARNINGS"


def test_repeated_rows_of_a_file_are_counted_but_stored_once(spark):
    first = CSV.splitlines()[1]
    path, target = write(spark, "vendor_a_2.csv", CSV + first + "\n" + first + "\n"), fresh_dir(spark, "table")
    result = flows.process_file(spark, path, "vendor_a", target, now())
    assert (result.total_records, result.valid_records, result.stored, result.duplicates) == (5, 4, 2, 2)
    issues = [r.issue_type for r in store.read_parts(spark, f"{target}-issues", QUALITY_ISSUES).collect()]
    assert issues.count("duplicate_key") == 2
    rows = {(r.account_id, str(r.as_of_date)): r for r in store.read_performance(spark, target).collect()}
    assert len(rows) == 2
    assert rows["ACC001", "2024-02-29"].cumulative_twrr == pytest.approx(1.03448276 * 1.01 - 1)


HEAD = CSV.splitlines()[0]


def test_bad_dates_change_no_earlier_row(spark):
    """Rows without a readable date are kept apart; later loads, even of such rows only, lose and change nothing."""
    target = fresh_dir(spark, "table")
    good = write(spark, "vendor_a_1.csv", HEAD + "\nB,,P1,2024-01-31,1,0,0,0,0,0,0,2,0.01,\nC,,P1,bad,1,0,0,0,0,0,0,2,0.01,\n"
                 "C,,P1,worse,1,0,0,0,0,0,0,3,0.01,\n,,P1,2024-01-31,1,0,0,0,0,0,0,2,0.01,\n")
    first = flows.process_file(spark, good, "vendor_a", target, now())
    assert (first.status, first.stored, first.rejected) == ("SUCCESS", 1, 3)
    before = store.read_performance(spark, target).collect()
    bad = write(spark, "vendor_a_2.csv", HEAD + "\nB,,P1,31/31/2024,1,0,0,0,0,0,0,2,0.01,\n")
    second = flows.process_file(spark, bad, "vendor_a", target, now())
    assert (second.status, second.total_records, second.stored, second.rejected) == ("SUCCESS", 1, 0, 1)
    assert store.read_performance(spark, target).collect() == before
    assert spark.read.parquet(f"{target}-rejected").count() == 4
    with pytest.raises(ValueError, match="without as_of_date"):
        store.upsert_performance(spark, target, store.stored_rows(spark, target).drop(*store.PARTITIONS).withColumn(
            "as_of_date", F.lit(None).cast("date")), newest=("updated_at",))


def test_values_beyond_their_type_are_issues(spark):
    path = write(spark, "vendor_a_1.csv", HEAD + "\nB,,P1,2024-01-31,99999999999999999,0,0,0,0,0,0,2,0.01,20000\n")
    target = fresh_dir(spark, "table")
    assert flows.process_file(spark, path, "vendor_a", target, now()).rejected == 1
    found = {r.issue_type for r in store.read_parts(spark, f"{target}-issues", QUALITY_ISSUES).collect()}
    assert {"invalid_beginning_market_value_type", "invalid_vendor_twrr_type"} <= found


def test_settings_of_a_vendor(spark):
    given = {"field_mappings": {"account_id": ["konto"], "as_of_date": ["tag"], "ending_market_value": ["ende"]},
             "date_formats": ["dd.MM.yyyy"], "required_fields": ["account_id"], "twrr_tolerance": "0.5"}
    settings = flows.LoadSettings.read(spark, write(spark, "m.json", json.dumps(given)))
    path, target = write(spark, "vendor_a_1.csv", "konto,tag,ende\nB,31.01.2024,5\n"), fresh_dir(spark, "table")
    result = flows.process_file(spark, path, "vendor_a", target, now(), settings)
    assert (result.stored, result.valid_records, settings.twrr_tolerance) == (1, 1, Decimal("0.5"))
    assert str(store.read_performance(spark, target).first().as_of_date) == "2024-01-31"


def test_csv_files_with_other_headers_are_read_by_name(spark):
    one = write(spark, "a.csv", "account_id,ending_mv,beginning_mv\nX,2,1\n")
    two = write(spark, "b.csv", "beginning_mv,account_id,ending_mv\n1,Y,2\n")
    none = write(spark, "c.csv", "")
    rows = files.read_csv(spark, [one, two, none]).collect()
    assert {(r.account_id, r.beginning_mv, r.ending_mv) for r in rows} == {("X", "1", "2"), ("Y", "1", "2")}


DAMAGED = HEAD + """
A,,P1,2024-01-31,1,0,0,0,0,0,0,2,0.01,
B,,P1,2024-01-31,1,0,0,0
C,,P1,2024-01-31,1,0,0,0,0,0,0,2,0.01,,more
D,"two
lines",P1,2024-01-31,1,0,0,0,0,0,0,2,0.01,
E,"a, b",P1,2024-01-31,1,0,0,0,0,0,0,2,0.01,
"""


def test_lines_that_do_not_fit_their_header_are_rejected(spark):
    path, target = write(spark, "vendor_a_1.csv", DAMAGED), fresh_dir(spark, "table")
    result = flows.process_file(spark, path, "vendor_a", target, now())
    assert (result.total_records, result.valid_records, result.stored, result.rejected) == (6, 2, 2, 4)
    left = spark.read.parquet(f"{target}-rejected").collect()
    assert {r.reject_reason for r in left} == {"malformed_line"}
    lines = DAMAGED.splitlines()
    assert sorted(r.raw_line for r in left) == sorted([*lines[2:4], *lines[4:6]])
    issues = store.read_parts(spark, f"{target}-issues", QUALITY_ISSUES).where("issue_type = 'malformed_line'").collect()
    assert sorted(r.actual_value for r in issues) == sorted(r.raw_line for r in left)
    # Whatever columns are used, and with quoted breaks read right.
    read = files.read_csv(spark, path, malformed="raw")
    assert sum(r.raw is not None for r in read.select("acct_id", "raw").collect()) == 4
    whole = files.read_csv(spark, path, malformed="raw", quoted_breaks=True).collect()
    assert [(r.acct_id, r.acct_name) for r in whole if r.raw is None] == [("A", None), ("D", "two\nlines"), ("E", "a, b")]
    bad = write(spark, "vendor_c_1.json", '{"account": {"id": "A"}}\n{"account": {"id"\n')
    rows = files.read_vendor_file(spark, bad, lines=True, malformed="raw").collect()
    assert [(r.account_id, r.raw is not None) for r in rows] == [("A", False), (None, True)]


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup(fresh_dir(spark, "g"), "counted")
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_many_files_take_a_constant_number_of_jobs(spark):
    counts = []
    for n in (3, 400):
        folder = fresh_dir(spark, "many")
        os.makedirs(folder)
        for i in range(n):
            with open(f"{folder}/f{i}.csv", "w") as out:
                out.write("a,b\n1,2\n" if i % 2 else "\n\ufeffb,a\n2,1\n")
        counts.append(jobs_of(spark, lambda: files.csv_layouts(spark, folder)))
        rows = files.read_csv(spark, folder, glob="*.csv").collect()
        assert len(rows) == n and {(r.a, r.b) for r in rows} == {("1", "2")}
    assert counts[0] <= 2 and counts[1] <= 3  # listing many files is a job of its own


def test_a_load_counts_what_it_writes(spark):
    """Counts are observed on the writes: no job only counts rows."""
    path, target = write(spark, "vendor_a_1.csv", CSV), fresh_dir(spark, "table")
    found = []
    taken = jobs_of(spark, lambda: found.append(flows.process_file(spark, path, "vendor_a", target, now())))
    assert found[0].stored == 2 and taken <= 24


def test_names_that_are_no_encoding(spark):
    found = spark.createDataFrame([("incoming/va_100%.csv", 5), ("incoming/vb_1%20a.csv", 5)], "file_key string, file_size long")
    assert {(r.file_name, r.vendor) for r in manifest.route_files(found).collect()} == {
        ("va_100%.csv", "vendor_a"), ("vb_1 a.csv", "vendor_b")}
    assert {r.file_name for r in manifest.route_files(found, encoded=False).collect()} == {"va_100%.csv", "vb_1%20a.csv"}


def test_a_failed_first_write_is_no_table(spark):
    target = fresh_dir(spark, "table")
    os.makedirs(f"{target}/_temporary/0")
    assert not store.table_exists(spark, target)
    path = write(spark, "vendor_a_1.csv", CSV)
    assert flows.process_file(spark, path, "vendor_a", target, now()).status == "SUCCESS"


def test_process_file_failure_is_reported(spark):
    result = flows.process_file(spark, "/nowhere/x.csv", "vendor_a", fresh_dir(spark, "t"), now())
    assert result.status == "FAILED" and "PATH_NOT_FOUND" in result.error


def test_schema_issues(spark):
    df = spark.createDataFrame([("x", 1)], "account_id string, as_of_date int")
    got = {(r[0], r[2]) for r in quality.schema_issues(
        df, {"account_id": "string", "as_of_date": "date", "fees": "decimal"}).collect()}
    assert got == {("as_of_date", "int"), ("fees", "missing")}
