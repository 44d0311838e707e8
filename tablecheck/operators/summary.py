"""Result rows of a comparison: status per column and percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.model import CELL_COUNT, PREFIX, RESULT_SCHEMA, TESTCASES, RunInfo, TableRules
from tablecheck.operators.compare import CellRule


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2)


def column_status(nullable: Column) -> Column:
    """First match wins."""
    return (
        F.when(F.col("src_count") != F.col("tgt_count"), "FAIL(Count Check)")
        .when(~nullable & (F.col("null_count") != 0), "FAIL(Null Check)")
        .when(F.col("src_count") != F.col("pass_count") + F.col("fail_count"), "FAIL(Duplicate Check)")
        .when(F.col("fail_count") == 0, "PASS")
        .otherwise("FAIL")
    )


def row_counts(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """One row (src_count, tgt_count), from two counts put together as rows."""
    zero = F.lit(0).cast("bigint")
    s = src.agg(F.count(F.lit(1)).alias("src_count")).withColumn("tgt_count", zero)
    t = tgt.agg(F.count(F.lit(1)).alias("tgt_count")).withColumn("src_count", zero)
    return s.unionByName(t).agg(F.sum("src_count").alias("src_count"), F.sum("tgt_count").alias("tgt_count"))


def result_rows(df: DataFrame, kind: str, rules: TableRules, run: RunInfo) -> DataFrame:
    """Fills the fixed columns and casts to the result schema."""
    testcase, description = TESTCASES[kind]
    fixed = {
        "testcase_id": testcase,
        "testcase_description": description,
        "type": kind,
        "database_name": run.database_name,
        "table_name": rules.table_name,
        "process_date": run.process_date,
        "last_insert_timestamp": run.run_ts,
        "as_of_date": run.as_of_date,
    }
    present = set(df.columns)
    columns = []
    for f in RESULT_SCHEMA:
        value = F.col(f.name) if f.name in present else F.lit(fixed.get(f.name))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def regression_rows(
    cells: DataFrame, src: DataFrame, tgt: DataFrame, rules: TableRules, run: RunInfo, tgt_only: Sequence[str] = ()
) -> DataFrame:
    """Counts per column with percentages and the status ladder."""
    n_src = src.agg(F.count(F.lit(1))).scalar()
    n_tgt = tgt.agg(F.count(F.lit(1))).scalar()
    counted = cells.withColumns({"src_count": n_src, "tgt_count": n_tgt})
    nullable = ~F.col("column_name").isin(list(rules.non_nullable_col))
    status = column_status(nullable)
    if tgt_only:
        status = F.when(F.col("column_name").isin(list(tgt_only)), "FAIL").otherwise(status)
    rated = counted.withColumns(
        {
            "overall_Status": status,
            "src_pass_percentage": percent(F.col("pass_count"), F.col("src_count")),
            "tgt_pass_percentage": percent(F.col("pass_count"), F.col("tgt_count")),
            "tgt_null_percentage": percent(F.col("null_count"), F.col("tgt_count")),
        }
    )
    return result_rows(rated, "Regression", rules, run)


def bag_cells(src: DataFrame, tgt: DataFrame, rules: Sequence[CellRule]) -> DataFrame:
    """Counts per column when whole rows are matched as a bag: a row passes in every column or
    in none. Cells are grouped by the text that is equal exactly when they pass. A target
    column that the source lacks has no part in the matching; all its cells fail."""
    compared = [r for r in rules if r.kind != "absent"]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def side(df: DataFrame, prefix: str) -> DataFrame:
        cells = [r.canonical(F.col(prefix + r.column)).alias(f"_c{i}") for i, r in enumerate(compared)]
        empty = [F.col(r.column).isNull().cast("bigint") if not prefix else none for r in rules]
        sides = (one, none) if prefix else (none, one)
        return df.select(
            *cells, sides[0].alias("_s"), sides[1].alias("_t"), *[e.alias(f"_n{i}") for i, e in enumerate(empty)]
        )

    both = side(src, PREFIX).unionByName(side(tgt, ""))
    counts = both.groupBy(*[f"_c{i}" for i in range(len(compared))]).agg(
        F.sum("_s").alias("_s"), F.sum("_t").alias("_t"), *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(rules))]
    )
    matched = F.least("_s", "_t")
    total = counts.agg(
        F.coalesce(F.sum(matched), none).alias("_pass"),
        F.coalesce(F.sum(F.greatest("_s", "_t") - matched), none).alias("_fail"),
        *[F.coalesce(F.sum(f"_n{i}"), none).alias(f"_n{i}") for i in range(len(rules))],
    )
    rows = []
    for i, r in enumerate(rules):
        absent = r.kind == "absent"
        rows.append(
            F.struct(
                F.lit(r.column).alias("column_name"),
                (none if absent else F.col("_pass")).cast(CELL_COUNT).alias("pass_count"),
                (F.col("_pass") + F.col("_fail") if absent else F.col("_fail")).cast(CELL_COUNT).alias("fail_count"),
                F.col(f"_n{i}").cast(CELL_COUNT).alias("null_count"),
            )
        )
    return total.select(F.inline(F.array(*rows)))
