"""Delivered text extracts: lines, header and trailer, fixed-width and delimited
data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecheck.model import EdgeRule, ExtractRules, RunInfo, TableRules
from tablecheck.operators.summary import result_rows
from tablecheck.session import pin
from tablecheck.sources.xml import file_filter, flatten, flatten_with_root, flatten_xml
from tablecheck.sources.xsd import FILE, Checked, check_xml

PIPE_MARK = "~!~"


def read_lines(spark: SparkSession, path: str, file_ext: str = "") -> DataFrame:
    """(file, block, seq, value); (block, seq) gives the line order in a file and
    `seq` has no gaps inside a block.

    The lines are staged, so that everything derived from them refers to the
    same positions; later steps that need no text do not read it again."""
    lines = spark.read.options(**file_filter(file_ext)).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    return pin(lines, "lines")


def line_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))


def record_counts(lines: DataFrame, rules: ExtractRules) -> DataFrame:
    """Data rows per file: lines less header and trailer rows."""
    skipped = rules.skip_header_rows + rules.skip_trailer_rows
    return line_counts(lines).select("file", (F.col("lines") - skipped).alias("record_count"))


def _cuts(lines: DataFrame, rules: ExtractRules) -> DataFrame:
    """Per file the place of the last header line and of the first trailer line.

    Taken from the first and last position of each block, so no line is sorted.
    The result is staged: its size is then known, and Spark broadcasts it when
    it is small."""
    head, tail = rules.skip_header_rows, rules.skip_trailer_rows
    blocks = lines.groupBy("file", "block").agg(
        F.min("seq").alias("first"), F.max("seq").alias("last"), F.count(F.lit(1)).alias("n")
    )
    file = W.partitionBy("file")
    earlier = file.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    placed = blocks.withColumns(
        {"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "body": F.sum("n").over(file) - tail}
    )
    first, before = F.col("first"), F.col("before")
    header_end = F.struct("block", F.least("last", first + (F.lit(head - 1) - before)).alias("seq"))
    trailer_start = F.struct("block", F.greatest(first, first + (F.col("body") - before)).alias("seq"))
    cuts = placed.groupBy(F.col("file").alias("_file")).agg(
        F.max(F.when(before < head, header_end)).alias("_after"),
        F.min(F.when((before + F.col("n") > F.col("body")) & F.lit(tail > 0), trailer_start)).alias("_until"),
    )
    return pin(cuts, "cuts")


def split_lines(lines: DataFrame, rules: ExtractRules) -> tuple[DataFrame, DataFrame]:
    """(data lines, header and trailer lines); the latter as (file, part, line_no,
    value)."""
    place = F.struct("block", "seq")
    cut = lines.join(_cuts(lines, rules), F.col("file") == F.col("_file"), "left").withColumns(
        {
            "_header": F.coalesce(place <= F.col("_after"), F.lit(False)),
            "_trailer": F.coalesce(place >= F.col("_until"), F.lit(False)),
        }
    )
    data = cut.filter(~F.col("_header") & ~F.col("_trailer")).select(*lines.columns)
    few = cut.filter(F.col("_header") | F.col("_trailer"))
    parts = F.array_compact(F.array(F.when(F.col("_header"), "header"), F.when(F.col("_trailer"), "trailer")))
    number = F.row_number().over(W.partitionBy("file", "part").orderBy("block", "seq"))
    edges = few.withColumn("part", F.explode(parts)).withColumn("line_no", number)
    return data, edges.select("file", "part", "line_no", "value")


def _expected(rule: EdgeRule, run: RunInfo, run_stamp: str, count: Column) -> Column:
    """The pattern (or plain line) with dates and the record count filled in."""
    if not rule.is_pattern:
        return F.lit(rule.text)
    stamp = datetime.strptime(run_stamp, "%Y%m%d%H%M%S")
    dates = {
        "timestamp_yyyy_mm_dd": stamp.strftime("%Y-%m-%d"),
        "timestamp_yyyymmdd": stamp.strftime("%Y%m%d"),
        "process_date": run.process_date,
        "as_of_date": run.as_of_date,
    }
    text = rule.text.replace("!", r"\|").replace("//", "\\")
    for name, value in dates.items():
        text = text.replace("{" + name + "}", value)
    pieces = re.split(r"(\{count\})", text)
    return F.concat(*[count.cast("string") if p == "{count}" else F.lit(p) for p in pieces])


def check_edges(
    lines: DataFrame, rules: ExtractRules, run: RunInfo, run_stamp: str, mode: str = "prefix"
) -> DataFrame:
    """(file, part, line_no, expected, actual, status) per expected line.

    `mode="prefix"` lets text follow the pattern; `mode="full"` does not. A line
    the file does not have is a failure."""
    counts = record_counts(lines, rules)
    wanted = [("header", i, r) for i, r in enumerate(rules.headers, 1)]
    wanted += [("trailer", i, r) for i, r in enumerate(rules.trailers, 1)]
    end = "$" if mode == "full" else ""
    expected = F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                F.lit(i).alias("line_no"),
                _expected(rule, run, run_stamp, F.col("record_count")).alias("expected"),
                F.lit(rule.is_pattern).alias("is_pattern"),
            )
            for part, i, rule in wanted
        ]
    )
    plan = counts.select("file", F.inline(expected))
    _, edges = split_lines(lines, rules)
    edges = edges.withColumnRenamed("value", "actual")
    found = plan.join(edges, ["file", "part", "line_no"], "left")
    pattern = F.concat(F.lit("^(?:"), F.col("expected"), F.lit(")" + end))
    fits = F.when(F.col("is_pattern"), F.regexp_like("actual", pattern)).otherwise(
        F.col("actual") == F.col("expected")
    )
    status = F.when(F.coalesce(fits, F.lit(False)), "PASS").otherwise("FAIL")
    return found.select("file", "part", "line_no", "expected", "actual", status.alias("status"))


def validate_extract(
    lines: DataFrame, rules: ExtractRules, run: RunInfo, run_stamp: str, mode: str = "prefix"
) -> DataFrame:
    """Header and trailer checks as result rows, one per expected line and file."""
    checks = check_edges(lines, rules, run, run_stamp, mode)
    rows = checks.select(
        F.concat_ws(" ", "part", "line_no").alias("column_name"),
        F.col("status").alias("overall_Status"),
        (F.col("status") == "PASS").cast("int").alias("pass_count"),
        (F.col("status") == "FAIL").cast("int").alias("fail_count"),
    )
    return result_rows(rows, "Extract", TableRules(rules.table_name), run)


def parse_fixed_width(
    lines: DataFrame, widths: Sequence[int], names: Sequence[str], drop_commas: bool = False, pipe_escape: str = ","
) -> DataFrame:
    """Columns by width, trimmed, blank as NULL; pipes are replaced because the
    result goes to a pipe-separated file."""
    columns, start = [], 1
    for name, width in zip(names, widths, strict=True):
        cell = F.substring("value", start, width)
        if drop_commas:
            cell = F.replace(cell, F.lit(","), F.lit(""))
        cell = F.trim(F.replace(cell, F.lit("|"), F.lit(pipe_escape)))
        columns.append(F.when(cell != "", cell).alias(name))
        start += width
    return lines.select(*columns)


def parse_delimited(lines: DataFrame, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Quoted delimited lines to text columns."""
    schema = ", ".join(f"`{n}` string" for n in names)
    parsed = F.from_csv("value", schema, {"sep": sep, "quote": '"', "escape": '"'})
    return lines.select(parsed.alias("_row")).select("_row.*")


def has_pipe(df: DataFrame) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), F.lit("|")), F.lit(False)) for c in df.columns])


def pipe_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows hold a pipe already."""
    return df.agg(F.count_if(has_pipe(df)).alias("pipe_rows"))


def escape_pipes(df: DataFrame, mark: str = PIPE_MARK) -> DataFrame:
    return df.select([F.replace(F.col(c), F.lit("|"), F.lit(mark)).alias(c) for c in df.columns])


def header_names(edges: DataFrame, rules: ExtractRules, sep: str) -> list[str]:
    """Column names from the last header line, which all files must agree on."""
    last = edges.filter((F.col("part") == "header") & (F.col("line_no") == rules.skip_header_rows))
    found = [r.value for r in last.select("value").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{rules.table_name}: no column names, and {len(found) or 'no'} header lines to take them from")
    return [n.strip().strip('"') for n in found[0].split(sep)]


def read_extract(spark: SparkSession, path: str, rules: ExtractRules) -> DataFrame:
    """A delivered extract as a flat text table, whatever its format. Without column names the
    last header line names the columns of delimited files. Records that the rules' schema
    file rejects are left out; `read_checked` has them."""
    if rules.file_format == "xml":
        if rules.validator_file_name:
            return read_checked(spark, path, rules)[0]
        return flatten_xml(
            spark, path, rules.row_tag, rules.root_tag or None, rules.row_schema or None, rules.extract_file_ext
        )
    if rules.validator_file_name:
        raise ValueError(f"{rules.table_name}: only XML extracts have a schema file")
    data, edges = split_lines(read_lines(spark, path, rules.extract_file_ext), rules)
    names = rules.tbl_column_names
    if rules.file_format in ("csv", "psv"):
        sep = rules.delimiter or {"csv": ",", "psv": "|"}[rules.file_format]
        rows = parse_delimited(data, names or header_names(edges, rules, sep), sep)
        return rows if sep == "|" else escape_pipes(rows)
    if rules.file_format in ("fwf", "fw_csv"):
        return parse_fixed_width(data, rules.fixed_widths, names, drop_commas=rules.file_format == "fw_csv")
    raise ValueError(f"unknown extract format: {rules.file_format}")


def read_checked(spark: SparkSession, path: str, rules: ExtractRules) -> tuple[DataFrame, Checked]:
    """(flat rows of the records that conform, what was checked) of an XML extract, by the rules'
    schema file, which any path that Spark reads may name."""
    xsd = spark.read.text(rules.validator_file_name, wholetext=True).first()
    if xsd is None:
        raise ValueError(f"{rules.table_name}: the schema file {rules.validator_file_name} is empty")
    folders = rules.document_folders
    found = check_xml(spark, path, rules.row_tag, rules.row_schema or None, xsd.value, rules.extract_file_ext, folders)
    if rules.root_tag:
        return flatten_with_root(found.accepted, path, rules.row_tag, rules.root_tag, folders), found
    return flatten(found.accepted.drop(FILE), rules.row_tag), found
