"""Business-date parameters as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPACT = "yyyyMMdd"
DASHED = "yyyy-MM-dd"
DELIVERY_SUFFIX = "000000"


def parse_date(column: Column) -> Column:
    """Reads either date format. NULL and '' give NULL, any other text raises an error."""
    read = F.coalesce(F.try_to_date(column, DASHED), F.try_to_date(column, COMPACT))
    unread = F.raise_error(F.concat(F.lit("no date: "), column)).cast("date")
    return F.when(column.isNull() | (column == ""), F.lit(None).cast("date")).otherwise(F.coalesce(read, unread))


def _three_forms(day: Column, before: str, after: str) -> dict[str, Column]:
    compact = F.date_format(day, COMPACT)
    return {
        f"{before}as_of_date{after}": compact,
        f"{before}process_date{after}": F.date_format(day, DASHED),
        f"{before}podium_delivery_date{after}": F.concat(compact, F.lit(DELIVERY_SUFFIX)),
    }


def date_params(as_of: Column) -> dict[str, Column]:
    """All dates derived from one `yyyyMMdd` column."""
    day = F.to_date(as_of, COMPACT)
    month = F.trunc(day, "MM")
    params = _three_forms(day, "", "")
    del params["as_of_date"]
    params |= _three_forms(F.date_add(day, 1), "", "_wca")
    params |= _three_forms(month, "", "_currmonth_firstday")
    params |= _three_forms(F.date_sub(month, 1), "", "_prevmonth_lastday")
    params |= _three_forms(F.trunc(F.add_months(day, -2), "MM"), "", "_twoprevmonth_firstday")
    return params


def previous_day(as_of: Column, policy: str | None = None) -> Column:
    """`weekdays` goes from Monday back to Friday; anything else takes the day before."""
    day = F.to_date(as_of, COMPACT)
    if (policy or "").lower() == "weekdays":
        return F.when(F.dayofweek(day) == 2, F.date_sub(day, 3)).otherwise(F.date_sub(day, 1))
    return F.date_sub(day, 1)


def previous_params(as_of: Column, previous: Column | str | None = None) -> dict[str, Column]:
    """`previous` is a policy name, None, or a column holding an explicit date in
    either format ('' gives '' in every field)."""
    if not isinstance(previous, Column) and previous in (None, "weekdays", "alldays"):
        day, blank = previous_day(as_of, previous), F.lit(False)
    else:
        text = previous if isinstance(previous, Column) else F.lit(previous)
        day, blank = parse_date(text), text == ""
    params = _three_forms(day, "previous_", "") | _three_forms(F.date_add(day, 1), "previous_", "_wca")
    return {name: F.when(blank, F.lit("")).otherwise(value) for name, value in params.items()}


def with_date_params(df: DataFrame, as_of_col: str = "as_of_date") -> DataFrame:
    return df.withColumns(date_params(F.col(as_of_col)))


def with_previous_params(df: DataFrame, as_of_col: str = "as_of_date", previous: Column | str | None = None) -> DataFrame:
    return df.withColumns(previous_params(F.col(as_of_col), previous))
