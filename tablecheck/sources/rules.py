"""Finding the rules of a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.model import ExtractRules, TableRules, load_json

LIST_FIELDS = ("pk_col", "non_nullable_col", "important_col", "ignore_col", "threshold_col")


def table_rules(
    entries: Iterable[Mapping[str, Any]], table: str, suffix: str = "", second_suffix: str = ""
) -> TableRules | None:
    """The entry named exactly table + suffixes, if any."""
    wanted = f"{table}{suffix}{second_suffix}"
    found = next((e for e in entries if e["table_name"] == wanted), None)
    return TableRules.from_mapping(found) if found is not None else None


def extract_rules(entries: Iterable[Mapping[str, Any]], table: str, suffix: str = "") -> ExtractRules:
    """The suffixed entry, else the bare one; neither is an error."""
    by_name = {e["table_name"]: e for e in entries}
    found = by_name.get(f"{table}{suffix}", by_name.get(table))
    if found is None:
        raise LookupError(f"no extract rules for {table}{suffix}")
    return ExtractRules.from_mapping(found)


def load_table_rules(path: str, table: str, suffix: str = "", second_suffix: str = "") -> TableRules:
    """From a JSON file on the driver; absent rules are an error."""
    found = table_rules(load_json(path), table, suffix, second_suffix)
    if found is None:
        raise LookupError(f"no rules for {table}{suffix}{second_suffix} in {path}")
    return found


def load_extract_rules(path: str, table: str, suffix: str = "") -> ExtractRules:
    return extract_rules(load_json(path), table, suffix)


def read_rules(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Rules as rows, with the comma lists as arrays."""
    raw = spark.read.option("multiLine", str(multi_line).lower()).json(path)
    lists = {
        c: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))
        for c in LIST_FIELDS
        if c in raw.columns
    }
    return raw.withColumns(lists)


def lookup_rules(names: DataFrame, rules: DataFrame, suffix: str = "", fall_back: bool = False) -> DataFrame:
    """Adds the `rules_name` found for each `table_name`: the suffixed name, and
    with `fall_back` the bare name when the suffixed one has no entry."""
    known = rules.select(F.col("table_name").alias("rules_name")).distinct()
    exact = known.withColumnRenamed("rules_name", "_exact")
    out = names.join(exact, F.concat("table_name", F.lit(suffix)) == F.col("_exact"), "left")
    if not fall_back:
        return out.withColumnRenamed("_exact", "rules_name")
    bare = known.withColumnRenamed("rules_name", "_bare")
    out = out.join(bare, F.col("table_name") == F.col("_bare"), "left")
    return out.withColumn("rules_name", F.coalesce("_exact", "_bare")).drop("_exact", "_bare")
