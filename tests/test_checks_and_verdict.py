import pytest
from pyspark.sql import functions as F

from tablecheck.model import RESULT_SCHEMA, RunInfo, TableRules
from tablecheck.operators.checks import check_not_null, check_unique, duplicate_keys, run_checks
from tablecheck.operators.verdict import latest_run, overall_verdict, verdict
from tablecheck.plans.reconcile import TableJob, logged_tables, run_logged_suite, run_suite
from tablecheck.sources.tables import append_results, export_results, read_results

RUN = RunInfo("20240131", "2024-02-01 08:30:00")


def log_row(table, kind, column, status, stamp):
    values = {
        "type": kind, "table_name": table, "column_name": column, "overall_Status": status,
        "last_insert_timestamp": stamp, "as_of_date": "20240131",
    }
    return tuple(values.get(f.name) for f in RESULT_SCHEMA)


@pytest.fixture
def log(spark):
    rows = [
        log_row("a", "Regression", "x", "FAIL", "1"),
        log_row("a", "Regression", "x", "PASS", "2"),
        log_row("a", "Count", "", "FAIL(Count Check)", "3"),
        log_row("a", "Null", "x", "PASS", "3"),
        log_row("b", "Regression", "x", "FAIL", "2"),
        log_row("b", "Regression", "y", "PASS", "2"),
        log_row("b", "Duplicate", "x", "PASS", "3"),
        log_row("c", "Regression", "x", "PASS", "3"),
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def test_latest_run_keeps_tables_apart(log):
    got = {(r.table_name, r.type, r.last_insert_timestamp) for r in latest_run(log, ["a"]).collect()}
    assert got == {("a", "Regression", "2"), ("a", "Count", "3"), ("a", "Null", "3")}


def test_verdict_counts_every_kind_of_failure(log):
    got = dict((r.table_name, r.overall_status) for r in verdict(latest_run(log)).collect())
    assert got == {"a": "FAIL", "b": "FAIL", "c": "PASS"}
    assert overall_verdict(latest_run(log, ["c"])).first()[0] == "PASS"


def test_ignored_columns_only_concern_the_comparison(log):
    got = dict((r.table_name, r.overall_status) for r in verdict(latest_run(log), ["x", ""]).collect())
    assert got == {"a": "FAIL", "b": "PASS"}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b"), (None, "c")], "k int, v string")
    rules = TableRules("t", pk_col=("k",), non_nullable_col=("k", "v"))
    rows = {r.type: r for r in run_checks(df.limit(3), df, rules, RUN).collect()}
    assert (rows["Count"].overall_Status, rows["Count"].src_count, rows["Count"].tgt_count) == ("FAIL", 3, 5)
    assert (rows["Null"].overall_Status, rows["Null"].null_count, rows["Null"].column_name) == ("FAIL", 4, "k,v")
    assert (rows["Duplicate"].fail_count, rows["Duplicate"].column_name) == (2, "k")
    assert {tuple(r) for r in duplicate_keys(df, ["k"]).collect()} == {(1, 2), (None, 2)}


def test_checks_are_skipped_without_rules(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert check_not_null(df, TableRules("t"), RUN) is None
    assert check_unique(df, TableRules("t"), RUN) is None
    assert check_unique(df, TableRules("t", pk_col=("k",), dupe_check_flag=False), RUN) is None
    assert [r.type for r in run_checks(df, df, TableRules("t"), RUN).collect()] == ["Count"]


def test_suite_and_log(spark, tmp_path):
    df = spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    jobs = [
        TableJob(df, df, TableRules("same", pk_col=("k",))),
        TableJob(df, df.filter("k < 19"), TableRules("short", pk_col=("k",))),
        TableJob(df.select("v"), df.select("v"), TableRules("bag")),
    ]
    path = str(tmp_path / "log")
    append_results(run_suite(jobs, RUN), path)
    append_results(run_suite(jobs[:1], RunInfo("20240131", "2024-03-01 00:00:00")), path)
    log = read_results(spark, path)
    assert log.schema == RESULT_SCHEMA
    got = dict((r.table_name, r.overall_status) for r in verdict(latest_run(log)).collect())
    assert got == {"same": "PASS", "short": "FAIL", "bag": "PASS"}
    export_results(verdict(log), str(tmp_path / "verdict"))
    back = spark.read.csv(str(tmp_path / "verdict"), header=True, sep="|")
    assert {tuple(r) for r in back.collect()} == {("same", "PASS"), ("short", "FAIL"), ("bag", "PASS")}


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_a_run_logged_twice_is_there_once(spark, tmp_path):
    df = spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    path, rules = str(tmp_path / "log"), TableRules("a:b/c", pk_col=("k",))
    append_results(run_suite([TableJob(df, df.limit(3), rules)], RUN), path)
    other = RunInfo("20240131", "2024-03-01 00:00:00")
    append_results(run_suite([TableJob(df, df, rules)], other), path)
    append_results(run_suite([TableJob(df, df, rules)], RUN), path)
    once = run_suite([TableJob(df, df, rules)], RUN)
    log = read_results(spark, path)
    assert rows_of(log.filter(F.col("last_insert_timestamp") == RUN.run_ts)) == rows_of(once)
    assert log.count() == 2 * once.count()


def test_a_stopped_suite_goes_on(spark, tmp_path):
    df = spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    broken = df.withColumn("v", F.when(F.col("k") < 5, "x").otherwise(F.raise_error(F.lit("stopped"))))
    jobs = [TableJob(df, df.filter(f"k < {n}"), TableRules(f"t{n}", pk_col=("k",))) for n in (20, 19, 18)]
    path = str(tmp_path / "log")
    stopped = [*jobs[:2], TableJob(df, broken, TableRules("t18", pk_col=("k",)))]
    with pytest.raises(Exception, match="stopped"):
        run_logged_suite(spark, stopped, RUN, path, at_once=2)
    assert logged_tables(spark, path, RUN) == {"t20", "t19"}
    # tables that are logged are not run again: these would fail now
    left = [TableJob(df, broken, jobs[0].rules), TableJob(df, broken, jobs[1].rules), jobs[2]]
    found = run_logged_suite(spark, left, RUN, path)
    assert rows_of(found) == rows_of(run_suite(jobs, RUN))
    with pytest.raises(ValueError, match="once only"):
        run_logged_suite(spark, [jobs[0], jobs[0]], RUN, path)


def test_an_empty_log_is_no_pass(spark):
    from tablecheck.model import RESULT_SCHEMA
    from tablecheck.operators.verdict import overall_verdict

    assert overall_verdict(spark.createDataFrame([], RESULT_SCHEMA)).first().overall_status == "FAIL"


def test_null_keys_of_a_delivered_file_fail(spark):
    from tablecheck.model import ExtractRules, RunInfo
    from tablecheck.plans import extracts as E

    one = {c: "1" for c in E.POSITION_COLUMNS if c != "strkpx"} | {"occ_strkprice_report": "1"}
    report = spark.createDataFrame([one])
    delivered = E.position_extract(report).withColumn("bor_client_id", E.F.lit(None).cast("string"))
    run = RunInfo("20240131", "2024-02-01 08:30:00")
    rows = E.reconcile_extract("1", report, delivered, ExtractRules("x", "psv"), run)
    null = rows.filter("type = 'Null'").first()
    assert (null.overall_Status, int(null.null_count)) == ("FAIL", 1)
