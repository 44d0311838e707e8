"""Row-count, not-null and duplicate-key checks of a target table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.columns import any_null
from tablecheck.model import RunInfo, TableRules
from tablecheck.operators.summary import result_rows, row_counts


def check_count(src: DataFrame, tgt: DataFrame, rules: TableRules, run: RunInfo) -> DataFrame:
    status = F.when(F.col("src_count") == F.col("tgt_count"), "PASS").otherwise("FAIL")
    rows = row_counts(src, tgt).withColumns({"overall_Status": status, "column_name": F.lit("")})
    return result_rows(rows, "Count", rules, run)


def check_not_null(tgt: DataFrame, rules: TableRules, run: RunInfo) -> DataFrame | None:
    """Rows with NULL in any of the columns; None when there is nothing to check."""
    if not rules.non_nullable_col:
        return None
    found = tgt.agg(F.count_if(any_null(rules.non_nullable_col)).alias("null_count"))
    rows = found.withColumns(
        {
            "overall_Status": F.when(F.col("null_count") == 0, "PASS").otherwise("FAIL"),
            "column_name": F.lit(",".join(rules.non_nullable_col)),
        }
    )
    return result_rows(rows, "Null", rules, run)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their `n`."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_unique(tgt: DataFrame, rules: TableRules, run: RunInfo) -> DataFrame | None:
    """Number of duplicated keys; None without a key or with the check turned off."""
    if not rules.pk_col or not rules.dupe_check_flag:
        return None
    found = duplicate_keys(tgt, rules.pk_col).agg(F.count(F.lit(1)).alias("fail_count"))
    rows = found.withColumns(
        {
            "overall_Status": F.when(F.col("fail_count") == 0, "PASS").otherwise("FAIL"),
            "column_name": F.lit(",".join(rules.pk_col)),
        }
    )
    return result_rows(rows, "Duplicate", rules, run)


def run_checks(src: DataFrame, tgt: DataFrame, rules: TableRules, run: RunInfo) -> DataFrame:
    parts = [check_count(src, tgt, rules, run), check_not_null(tgt, rules, run), check_unique(tgt, rules, run)]
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])
