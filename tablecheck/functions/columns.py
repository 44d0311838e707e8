"""Column naming, blanking and coverage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.model import PREFIX


def prefix_source(df: DataFrame) -> DataFrame:
    """Lower-cases names and adds the source prefix where it is missing."""
    names = [c.lower() for c in df.columns]
    return df.toDF(*[c if c.startswith(PREFIX) else PREFIX + c for c in names])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def strip_prefix(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.removeprefix(PREFIX) for c in df.columns])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def blank_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turns the columns into text with '' for NULL."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def as_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


def null_safe(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with more underscores until no column is called so, in any case."""
    held, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def any_null(columns: Sequence[str]) -> Column:
    found = F.lit(False)
    for name in columns:
        found = found | F.col(name).isNull()
    return found


@dataclass(frozen=True)
class Coverage:
    """Which columns take part in a comparison, in target order."""

    compared: tuple[str, ...]
    ignored: tuple[str, ...]
    src_only: tuple[str, ...]
    tgt_only: tuple[str, ...]
    absent_ignored: tuple[str, ...]


def coverage(src_columns: Sequence[str], tgt_columns: Sequence[str], ignore: Sequence[str] = ()) -> Coverage:
    """Both lists hold bare names, without the source prefix."""
    src, skip = set(src_columns), set(ignore)
    wanted = [c for c in tgt_columns if c not in skip]
    return Coverage(
        compared=tuple(c for c in wanted if c in src),
        ignored=tuple(c for c in tgt_columns if c in skip),
        src_only=tuple(c for c in src_columns if c not in wanted),
        tgt_only=tuple(c for c in wanted if c not in src),
        absent_ignored=tuple(c for c in ignore if c not in set(tgt_columns)),
    )


def coverage_report(src: DataFrame, tgt: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """One row per column: its role and how many values each side holds.

    Each side is read once; the two one-row aggregates are put side by side as
    rows, not joined."""
    found = coverage(src.columns, tgt.columns, ignore)
    roles = {c: "compared" for c in found.compared}
    roles |= {c: "ignored" for c in found.ignored}
    roles |= {c: "tgt_only" for c in found.tgt_only}
    roles |= {c: "src_only" for c in found.src_only if c not in roles}

    def filled(df: DataFrame, side: str) -> DataFrame:
        other = "tgt_values" if side == "src_values" else "src_values"
        columns = [c for c in df.columns if c in roles]
        one_row = df.agg(*[F.count(F.col(c)).alias(c) for c in columns])
        rows = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(roles[c]).alias("role"),
                F.col(c).alias(side),
                F.lit(0).cast("bigint").alias(other),
            )
            for c in columns
        ]
        return one_row.select(F.inline(F.array(*rows))).select("column_name", "role", "src_values", "tgt_values")

    both = filled(src, "src_values").unionByName(filled(tgt, "tgt_values"))
    return both.groupBy("column_name", "role").agg(
        F.sum("src_values").alias("src_values"), F.sum("tgt_values").alias("tgt_values")
    )
