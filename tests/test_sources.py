import json

import pytest
from pyspark.sql import functions as F

from tablecheck.functions import columns as C
from tablecheck.functions import dates as D
from tablecheck.model import TableRules
from tablecheck.sources import rules as R
from tablecheck.sources import snapshots as S
from tablecheck.sources import tables as T


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, qa_B int, c int")
    assert C.prefix_source(df).columns == ["qa_a", "qa_b", "qa_c"]
    assert C.strip_prefix(C.prefix_source(df)).columns == ["a", "b", "c"]
    assert C.lower_names(df).columns == ["a", "qa_b", "c"]
    assert C.rename(df, {"c": "d"}).columns == ["A", "qa_B", "d"]


def test_coverage():
    found = C.coverage(["k", "a", "old"], ["a", "k", "skip", "new"], ["skip", "gone"])
    assert found.compared == ("a", "k")
    assert found.ignored == ("skip",)
    assert found.tgt_only == ("new",)
    assert found.src_only == ("old",)
    assert found.absent_ignored == ("gone",)


def test_rules_from_json(spark, tmp_path):
    entries = [
        {"table_name": "t_s", "pk_col": "a, b", "threshold_val_perc": "0.5", "dupe_check_flag": "0"},
        {"table_name": "t", "pk_col": "a"},
    ]
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(entries))
    rules = R.load_table_rules(str(path), "t", "_s")
    assert rules == TableRules("t_s", pk_col=("a", "b"), threshold_val_perc=0.5, dupe_check_flag=False)
    with pytest.raises(LookupError):
        R.load_table_rules(str(path), "t", "_other")
    frame = R.read_rules(spark, str(path))
    assert {r.table_name: r.pk_col for r in frame.collect()} == {"t_s": ["a", " b"], "t": ["a"]}


def test_extract_rules_fall_back():
    entries = [
        {"table_name": "x", "file_format": "psv", "first_header": ["H", "N"], "second_header": "", "first_trailer": ["T{count}", "Y"]},
        {"table_name": "x_2", "file_format": "fwf", "fixed_widths": ["3", 4], "primary_key": ["a", "b"]},
    ]
    bare = R.extract_rules(entries, "x", "_9")
    assert (bare.file_format, len(bare.headers), bare.trailers[0].is_pattern) == ("psv", 1, True)
    assert not bare.headers[0].is_pattern
    suffixed = R.extract_rules(entries, "x", "_2")
    assert suffixed.fixed_widths == (3, 4)
    assert suffixed.table_rules().non_nullable_col == ("a", "b")
    assert suffixed.table_rules(with_not_null=False).non_nullable_col == ()
    with pytest.raises(LookupError):
        R.extract_rules(entries, "y")


def test_history_must_have_a_current_side(spark, tmp_path):
    df = spark.createDataFrame([(1, "20240101000000")], "k int, ifw_effective_date string")
    df.write.parquet(str(tmp_path / "only" / "history"))
    with pytest.raises(ValueError, match="current"):
        S.read_history(spark, str(tmp_path / "only"))
    df.write.parquet(str(tmp_path / "cur" / "current"))
    parts = S.read_history(spark, str(tmp_path / "cur"))
    assert S.snapshot(parts, "FULL").count() == 1
    assert parts.current.columns == ["k", "ifw_effective_date", "ifw_effective_end_date", "ifw_transaction_type"]


def test_read_history_does_not_hide_other_errors(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t" / "current"))
    with pytest.raises(Exception, match="no_such_format"):
        S.read_history(spark, str(tmp_path / "t"), fmt="no_such_format")


def test_partition_filter_does_not_change_its_argument(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01")], "k int, d string")
    df = df.withColumn("d", F.to_date("d"))
    assert [r.k for r in S.partition_filter(df, "d").collect()] == [2]
    assert S.partition_filter(df, "other", "LATEST").select("other").distinct().first()[0] == "FULL"
    assert [r.k for r in S.partition_filter(df, "d").collect()] == [2]
    assert [r.k for r in S.partition_filter(df, "d", "<= '2024-01-15'").collect()] == [1]
    with pytest.raises(ValueError):
        S.partition_filter(df, "d", "<= '2024-01-15' or d >= 'x'; drop")


def test_partition_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", (F.col("id") % 3).alias("p")).write.parquet(path)
    plan = S.partition_filter(spark.read.parquet(path), "p", ">= 2").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(p,2)" in text


@pytest.mark.parametrize(
    "as_of,policy,previous",
    [("20240129", "weekdays", "20240126"), ("20240128", "weekdays", "20240127"), ("20240129", None, "20240128"), ("20240301", "alldays", "20240229")],
)
def test_previous_day(spark, as_of, policy, previous):
    df = spark.createDataFrame([(as_of,)], "as_of_date string")
    row = D.with_previous_params(df, previous=policy).first()
    assert row.previous_as_of_date == previous
    assert row.previous_podium_delivery_date == previous + "000000"


def test_date_params(spark):
    row = D.with_date_params(spark.createDataFrame([("20240331",)], "as_of_date string")).first()
    assert row.process_date == "2024-03-31"
    assert row.as_of_date_wca == "20240401"
    assert row.as_of_date_currmonth_firstday == "20240301"
    assert row.process_date_prevmonth_lastday == "2024-02-29"
    assert row.podium_delivery_date_twoprevmonth_firstday == "20240101000000"


def test_explicit_previous_date(spark):
    df = spark.createDataFrame([("20240131", "2024-01-05"), ("20240131", "20240105"), ("20240131", "")], "as_of_date string, p string")
    got = [r.previous_as_of_date for r in D.with_previous_params(df, previous=F.col("p")).collect()]
    assert got == ["20240105", "20240105", ""]


def test_jdbc_options():
    got = T.jdbc_options("jdbc:x", "db.v", ["a", "b"], {"user": "u"}, ("a", "0", "9", 4))
    assert got["dbtable"] == "(select a, b from db.v) t"
    assert (got["partitionColumn"], got["numPartitions"], got["fetchsize"], got["user"]) == ("a", "4", "10000", "u")


def test_tables_and_views(spark, tmp_path):
    df = spark.range(5).withColumnRenamed("id", "k")
    T.create_database(spark, "checks_db")
    T.create_database(spark, "checks_db")
    table = T.replace_table(df, "checks_db.t", path=str(tmp_path / "t"))
    table = T.replace_table(df.filter("k < 3"), "checks_db.t", path=str(tmp_path / "t"))
    assert table.count() == 3
    assert T.read_table(spark, "checks_db.t", where="k > 1").count() == 1
    T.publish(df, "everyone", everywhere=True)
    assert T.read_table(spark, "global_temp.everyone").count() == 5
    assert T.read_query(spark, "select max(k) as m from {t}", t=df).first().m == 4
    spark.sql("drop database checks_db cascade")


def failing(df):
    stop = F.raise_error(F.lit("stopped")).cast("bigint")
    return df.withColumn("k", F.when(F.col("k") < 3, F.col("k")).otherwise(stop))


@pytest.mark.parametrize("catalog", [False, True])
def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path, catalog):
    df = spark.range(5).withColumnRenamed("id", "k")
    root = str(tmp_path / "stage")
    replace = lambda rows: T.replace_table(rows, "stage_t", path=root) if catalog else T.replace_table(rows, root)
    read = lambda: T.read_table(spark, "stage_t" if catalog else root)
    first = replace(df)
    for _ in range(2):  # a write that died leaves a folder that the next one replaces
        with pytest.raises(Exception, match="stopped"):
            replace(failing(df))
        assert read().count() == first.count() == 5
    second = replace(df.filter("k < 2").withColumn("more", F.lit("x")))
    assert second.columns == read().columns == ["k", "more"]
    assert (second.count(), read().count()) == (2, 2)
    if not catalog:
        assert first.count() == 5  # a frame that reads the old version goes on
    replace(df.filter("k < 1").withColumn("more", F.lit("y")))
    assert read().count() == 1
    assert T.published_versions(spark, root) == [2, 3]
    spark.sql("drop table if exists stage_t")


def test_of_two_writers_one_publishes(spark, tmp_path, monkeypatch):
    root, df = str(tmp_path / "stage"), spark.range(3)
    T.replace_table(df, root)
    seen = T.published_versions(spark, root)
    T.replace_table(df.limit(1), root)
    monkeypatch.setattr(T, "published_versions", lambda *_: seen)  # this one began before the other published
    with pytest.raises(Exception, match="exists"):
        T.replace_table(df.limit(2), root)


def test_unreadable_dates_raise(spark):
    from tablecheck.functions.dates import with_previous_params

    days = spark.createDataFrame([("20240131", "")], "as_of_date string, prev string")
    assert with_previous_params(days, previous=F.col("prev")).first()["previous_as_of_date"] == ""
    odd = spark.createDataFrame([("20240131", "soon")], "as_of_date string, prev string")
    with pytest.raises(Exception, match="no date: soon"):
        with_previous_params(odd, previous=F.col("prev")).collect()
