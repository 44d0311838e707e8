"""Point-in-time reads of current and history partitions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START = "ifw_effective_date"
END = "ifw_effective_end_date"
KIND = "ifw_transaction_type"
FULL = "FULL"


def with_housekeeping(df: DataFrame) -> DataFrame:
    """Adds the end date and transaction type where they are absent."""
    return df.withColumns({c: F.lit("") for c in (END, KIND) if c not in df.columns})


@dataclass(frozen=True)
class History:
    current: DataFrame
    history: DataFrame

    @property
    def every(self) -> DataFrame:
        return self.current.unionByName(self.history)


def combine(current: DataFrame | None, history: DataFrame | None) -> History:
    """Lines up both sides. The history may be absent; the current side may not.

    A history that shows nothing but housekeeping columns counts as absent."""
    if current is None:
        raise ValueError("the current partition is missing")
    cur = with_housekeeping(current)
    if history is None or set(history.columns) <= {END, KIND}:
        return History(cur, cur.limit(0))
    return History(cur, with_housekeeping(history).select(cur.columns))


def read_history(spark: SparkSession, base_path: str, fmt: str = "parquet") -> History:
    """`<base>/current` and `<base>/history`; only a missing path is forgiven."""

    def load(name: str) -> DataFrame | None:
        try:
            return spark.read.format(fmt).load(f"{base_path.rstrip('/')}/{name}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    return combine(load("current"), load("history"))


def snapshot(parts: History, mode: str = "LATEST") -> DataFrame:
    """`LATEST`: the current side; `MAX`: rows at the largest effective date of
    both; `FULL`: everything; otherwise rows valid on the date given."""
    wanted = mode.upper()
    if wanted == "LATEST":
        return parts.current
    if wanted == FULL:
        return parts.every
    if wanted == "MAX":
        newest = parts.every.agg(F.max(START)).scalar()
        return parts.every.filter(F.col(START) == newest)
    still_open = F.col(END).isNull() | (F.col(END) == "")
    return parts.every.filter((F.col(START) <= mode) & (still_open | (F.col(END) > mode)))


def _typed(df: DataFrame, column: str, text: str) -> Column:
    return F.lit(text.strip().strip("'\"")).cast(df.schema[column].dataType)


def partition_filter(df: DataFrame, column: str, wanted: str = "LATEST") -> DataFrame:
    """`LATEST` (largest value), `FULL`, comparisons such as `<=2024-01-31` (may be
    joined by `and`), or a value. Without the column: all rows, marked `FULL`."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(FULL))
    if wanted.upper() == FULL:
        return df
    if wanted.upper() == "LATEST":
        return df.filter(F.col(column) == df.agg(F.max(column)).scalar())
    if "<=" in wanted or ">=" in wanted:
        kept = df
        for term in re.split(r"\s+and\s+", wanted.strip(), flags=re.IGNORECASE):
            found = re.fullmatch(rf"\s*(?:{re.escape(column)}\s*)?(<=|>=|<|>)\s*('[^']*'|\"[^\"]*\"|[^\s'\"]+)\s*", term)
            if not found:
                raise ValueError(f"cannot read the condition {term!r}")
            bound = _typed(df, column, found.group(2))
            value = F.col(column)
            tests = {"<=": value <= bound, ">=": value >= bound, "<": value < bound, ">": value > bound}
            kept = kept.filter(tests[found.group(1)])
        return kept
    return df.filter(F.col(column) == _typed(df, column, wanted))


def partition_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per partition value, newest first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(*[F.desc(c) for c in columns])
