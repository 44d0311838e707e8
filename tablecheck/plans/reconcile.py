"""Whole runs: compare one table, run its checks, do so for many tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tablecheck.functions.columns import lower_names, prefix_source
from tablecheck.model import PREFIX, RunInfo, TableRules
from tablecheck.operators.align import (
    Pairing,
    pair_by_important,
    pair_by_key,
    pair_by_ordinal,
)
from tablecheck.operators.checks import run_checks
from tablecheck.operators.compare import cell_rules, compare_cells, count_cells
from tablecheck.operators.summary import bag_cells, regression_rows
from tablecheck.sources.tables import append_results, read_results


def pair(
    src: DataFrame,
    tgt: DataFrame,
    rules: TableRules,
    align: str,
    how: str = "full",
    unique: bool = False,
) -> Pairing:
    if align == "key":
        return pair_by_key(src, tgt, rules.pk_col, how, unique)
    if align == "important":
        return pair_by_important(src, tgt, rules.important_col, how)
    if align == "ordinal":
        return pair_by_ordinal(src, tgt, how)
    raise ValueError(f"unknown alignment: {align}")


def choose_alignment(rules: TableRules, align: str | None) -> str:
    if align:
        return align
    return "key" if rules.pk_col else "important" if rules.important_col else "bag"


def detail(
    src: DataFrame, tgt: DataFrame, rules: TableRules, align: str | None = None, how: str = "full",
    compare: str = "typed", signed: bool = False, unique: bool = False,
) -> DataFrame:
    """The wide comparison, one row per pair of rows; see `Pairing.rows` for repeated keys."""
    s, t = prefix_source(src), lower_names(tgt)
    paired = pair(s, t, rules, choose_alignment(rules, align), how, unique)
    found, cells = _rules_for(paired, s, t, rules, compare, signed)
    return compare_cells(paired, found, cells)


def _rules_for(paired: Pairing, s: DataFrame, t: DataFrame, rules: TableRules, compare: str, signed: bool):
    """Keyless pairing adds a row number to both sides; it is compared as well."""
    added = [c for c in paired.joined.columns if c not in {*s.columns, *t.columns, "_in_src", "_in_tgt"}]
    both = paired.joined
    s = both.select(*s.columns, *[c for c in added if c.startswith(PREFIX)])
    t = both.select(*t.columns, *[c for c in added if not c.startswith(PREFIX)])
    return cell_rules(s, t, rules, compare, signed)


def reconcile(
    src: DataFrame,
    tgt: DataFrame,
    rules: TableRules,
    run: RunInfo,
    align: str | None = None,
    how: str = "full",
    compare: str = "typed",
    signed: bool = False,
    unique: bool = False,
) -> DataFrame:
    """One result row per compared column; one aggregate over one pairing, and one over the
    value counts of keys that both sides repeat.

    Without a key or important columns whole rows are matched as a bag, whatever their order.
    Rows within a tolerance are no equal rows, so rules with a tolerance ask for another
    alignment; nor does a bag know sides to leave out."""
    s, t = prefix_source(src), lower_names(tgt)
    align = choose_alignment(rules, align)
    if align == "bag":
        found, cell_list = cell_rules(s, t, rules, compare, signed)
        unfit = [r.column for r in cell_list if r.kind == "tolerance"]
        if unfit:
            raise ValueError(f"a bag has no tolerance ({', '.join(unfit)}): name a key or important columns, or use ordinal")
        if how != "full":
            raise ValueError("a bag compares all rows of both sides: how must be 'full'")
        cells = bag_cells(s, t, cell_list)
    else:
        paired = pair(s, t, rules, align, how, unique)
        found, cell_list = _rules_for(paired, s, t, rules, compare, signed)
        cells = count_cells(paired, cell_list)
    return regression_rows(cells, s, t, rules, run, found.tgt_only)


def run_table(src: DataFrame, tgt: DataFrame, rules: TableRules, run: RunInfo, **options) -> DataFrame:
    """Comparison and checks of one table, in one result frame."""
    s, t = prefix_source(src), lower_names(tgt)
    return reconcile(s, t, rules, run, **options).unionByName(run_checks(s, t, rules, run))


@dataclass(frozen=True)
class TableJob:
    src: DataFrame
    tgt: DataFrame
    rules: TableRules
    align: str | None = None


def run_suite(jobs: Sequence[TableJob], run: RunInfo) -> DataFrame:
    """The results of many tables; each is an independent branch of one plan."""
    return reduce(DataFrame.unionByName, [run_table(j.src, j.tgt, j.rules, run, align=j.align) for j in jobs])


def logged_tables(spark: SparkSession, path: str, run: RunInfo) -> set[str]:
    """The tables whose results of this run are in the log; at most one name per table."""
    try:
        log = read_results(spark, path)
    except AnalysisException:  # there is no log yet
        return set()
    own = log.filter((F.col("as_of_date") == run.as_of_date) & (F.col("last_insert_timestamp") == run.run_ts))
    return {r.table_name for r in own.select("table_name").distinct().collect()}


def run_logged_suite(
    spark: SparkSession, jobs: Sequence[TableJob], run: RunInfo, path: str, at_once: int = 4
) -> DataFrame:
    """Runs many tables into the log, `at_once` of them at a time, and returns the run's results.

    Each table is logged as soon as it is done, and a table that the log has from this run is
    left out. So a suite that was stopped goes on where it was, under the same stamp, and
    one table's failure (which is raised in the end) keeps no other from being logged."""
    names = [j.rules.table_name for j in jobs]
    if len(set(names)) < len(names):
        raise ValueError("a table can be in a logged suite once only")
    done = logged_tables(spark, path, run)

    def one(job: TableJob) -> None:
        append_results(run_table(job.src, job.tgt, job.rules, run, align=job.align), path)

    # job group, pool and the like go with the thread
    started = inheritable_thread_target(spark)(one)
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(started, j) for j in jobs if j.rules.table_name not in done]
    failed = [f.exception() for f in running if f.exception() is not None]
    if failed:
        raise failed[0]
    log = read_results(spark, path)
    own = (F.col("as_of_date") == run.as_of_date) & (F.col("last_insert_timestamp") == run.run_ts)
    return log.filter(own & F.col("table_name").isin(names))


def self_compare(df: DataFrame, rules: TableRules, run: RunInfo, **options) -> DataFrame:
    """A table against itself; everything must pass."""
    return reconcile(df, df, rules, run, **options)
