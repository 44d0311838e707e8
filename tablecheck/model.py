"""Schemas and parameter records shared by every module."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import types as T

PREFIX = "qa_"

# Counts of joined cells: with duplicate keys these count pairs of rows, which
# pass 2^63 long before the row counts do.
CELL_COUNT = T.DecimalType(38, 0)

# The result columns, their order and the test case labels.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("testcase_id", T.StringType()),
        T.StructField("testcase_description", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("database_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("overall_Status", T.StringType()),
        T.StructField("src_count", T.LongType()),
        T.StructField("tgt_count", T.LongType()),
        T.StructField("pass_count", CELL_COUNT),
        T.StructField("fail_count", CELL_COUNT),
        T.StructField("null_count", CELL_COUNT),
        T.StructField("src_pass_percentage", T.DoubleType()),
        T.StructField("tgt_pass_percentage", T.DoubleType()),
        T.StructField("tgt_null_percentage", T.DoubleType()),
        T.StructField("process_date", T.StringType()),
        T.StructField("last_insert_timestamp", T.StringType()),
        T.StructField("as_of_date", T.StringType()),
    ]
)
TESTCASES = {
    "Regression": ("SF_REG_001", "To validate all the columns"),
    "Count": ("SF_CNT_001", "Record Count check for the table"),
    "Null": ("SF_NUL_001", "Null check for the table"),
    "Duplicate": ("SF_DUP_001", "Duplicate check for the table"),
    "Extract": ("SF_EXT_001", "Header and trailer check for the extract"),
}
# Fixed value: the tolerance that holds when the rules name none.
DEFAULT_TOLERANCE_PERCENT = 0.002


def name_list(value: str | Iterable[str] | None) -> tuple[str, ...]:
    """Accepts a comma string or a list; blanks are left out."""
    if value is None:
        return ()
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(p.strip() for p in parts if p and p.strip())


@dataclass(frozen=True)
class TableRules:
    """What to compare and check for one table."""

    table_name: str
    pk_col: tuple[str, ...] = ()
    non_nullable_col: tuple[str, ...] = ()
    important_col: tuple[str, ...] = ()
    ignore_col: tuple[str, ...] = ()
    threshold_col: tuple[str, ...] = ()
    threshold_val_perc: float = DEFAULT_TOLERANCE_PERCENT
    dupe_check_flag: bool = True

    def __post_init__(self) -> None:
        """Column names in lower case, as those of the tables are made."""
        for name in ("pk_col", "non_nullable_col", "important_col", "ignore_col", "threshold_col"):
            object.__setattr__(self, name, tuple(c.lower() for c in getattr(self, name)))

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> TableRules:
        def names(key: str) -> tuple[str, ...]:
            return name_list(raw.get(key))

        percent = raw.get("threshold_val_perc")
        flag = raw.get("dupe_check_flag")
        return cls(
            table_name=raw["table_name"],
            pk_col=names("pk_col"),
            non_nullable_col=names("non_nullable_col"),
            important_col=names("important_col"),
            ignore_col=names("ignore_col"),
            threshold_col=names("threshold_col"),
            threshold_val_perc=DEFAULT_TOLERANCE_PERCENT if percent in (None, "") else float(percent),
            dupe_check_flag=flag is None or str(flag) in ("1", "True", "true"),
        )


@dataclass(frozen=True)
class EdgeRule:
    """One expected header or trailer line; a template when `is_pattern`."""

    text: str
    is_pattern: bool = True

    @classmethod
    def from_raw(cls, raw: Any) -> EdgeRule | None:
        if not raw:
            return None
        return cls(text=raw[0], is_pattern=raw[1] == "Y")


@dataclass(frozen=True)
class ExtractRules:
    """Layout of a delivered extract file."""

    table_name: str
    file_format: str
    extract_file_ext: str = ""
    delimiter: str = ""  # '' is that of the format
    primary_key: tuple[str, ...] = ()
    skip_header_rows: int = 0
    skip_trailer_rows: int = 0
    headers: tuple[EdgeRule, ...] = ()
    trailers: tuple[EdgeRule, ...] = ()
    tbl_column_names: tuple[str, ...] = ()
    fixed_widths: tuple[int, ...] = ()
    validator_file_name: str = ""
    row_tag: str = ""
    root_tag: str = ""
    row_schema: str = ""
    document_folders: bool = False  # an XML document is a folder of part files, each with a root

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> ExtractRules:
        def edges(*keys: str) -> tuple[EdgeRule, ...]:
            found = (EdgeRule.from_raw(raw.get(k)) for k in keys)
            return tuple(e for e in found if e is not None)

        return cls(
            table_name=raw["table_name"],
            file_format=raw["file_format"],
            extract_file_ext=raw.get("extract_file_ext", ""),
            delimiter=raw.get("delimiter") or "",
            primary_key=name_list(raw.get("primary_key")),
            skip_header_rows=int(raw.get("skip_header_rows") or 0),
            skip_trailer_rows=int(raw.get("skip_trailer_rows") or 0),
            headers=edges("first_header", "second_header"),
            trailers=edges("first_trailer"),
            tbl_column_names=name_list(raw.get("tbl_column_names")),
            fixed_widths=tuple(int(w) for w in raw.get("fixed_widths") or ()),
            validator_file_name=raw.get("validator_file_name") or "",
            row_tag=raw.get("row_tag") or "",
            root_tag=raw.get("root_tag") or "",
            row_schema=raw.get("row_schema") or "",
        )

    def table_rules(self, with_not_null: bool = True) -> TableRules:
        """Key columns double as not-null columns unless told otherwise."""
        return TableRules(
            table_name=self.table_name,
            pk_col=self.primary_key,
            non_nullable_col=self.primary_key if with_not_null else (),
        )


@dataclass(frozen=True)
class RunInfo:
    """Identity of one run; the same stamp goes on every result row."""

    as_of_date: str
    run_ts: str = field(default_factory=lambda: datetime.now().strftime("%Y-%m-%d %H:%M:%S.%f"))
    database_name: str = ""

    @property
    def process_date(self) -> str:
        return datetime.strptime(self.as_of_date, "%Y%m%d").strftime("%Y-%m-%d")


def load_json(path: str) -> list[dict[str, Any]]:
    with open(path, encoding="utf8") as handle:
        return json.load(handle)
