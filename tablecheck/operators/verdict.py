"""From the results log to one verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_KINDS = ("Count", "Null", "Duplicate")


def latest_run(log: DataFrame, tables: Sequence[str] | None = None) -> DataFrame:
    """Per table, the rows of its latest regression run and of its latest checks."""
    rows = log.filter(F.col("type").isin("Regression", *CHECK_KINDS))
    if tables:
        rows = rows.filter(F.col("table_name").isin(list(tables)))
    rows = rows.withColumn("_kind", F.when(F.col("type") == "Regression", "Regression").otherwise("Checks"))
    newest = rows.groupBy("table_name", "_kind").agg(F.max("last_insert_timestamp").alias("last_insert_timestamp"))
    return rows.join(newest, ["table_name", "_kind", "last_insert_timestamp"], "left_semi").drop("_kind")


def counted_rows(results: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Leaves out the regression rows of ignored columns; checks always count."""
    skipped = (F.col("type") == "Regression") & F.col("column_name").isin(list(ignore))
    return results.filter(~skipped) if ignore else results


def verdict(results: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """(table_name, overall_status): FAIL when any counted status is a failure."""
    failed = F.max(F.col("overall_Status").startswith("FAIL"))
    return (
        counted_rows(results, ignore)
        .groupBy("table_name")
        .agg(F.when(failed, "FAIL").otherwise("PASS").alias("overall_status"))
    )


def overall_verdict(results: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """One row for all tables together; a log without results is a failure, as nothing was checked."""
    failed = F.max(F.col("overall_Status").startswith("FAIL"))
    status = F.when(failed | failed.isNull(), "FAIL").otherwise("PASS")
    return counted_rows(results, ignore).agg(status.alias("overall_status"))
