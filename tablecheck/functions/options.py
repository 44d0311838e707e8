"""Fields derived from option names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that end the symbol inside an option name.
SYMBOL_BREAKS = r"[\d$'@+|]+"


def option_symbol(name: Column) -> Column:
    """The text between the first and the second run of break characters."""
    return F.trim(F.get(F.split(F.regexp_replace(name, SYMBOL_BREAKS, "|"), r"\|"), F.lit(1)))


def option_type(name: Column) -> Column:
    return F.trim(F.substring(name, 1, 4))


def put_call(kind: Column) -> Column:
    return F.substring(kind, 1, 1)


def compact_date(text: Column) -> Column:
    """`yyyy-MM-dd` to `yyyyMMdd`."""
    return F.replace(text, F.lit("-"), F.lit(""))


def contract_date(text: Column) -> Column:
    """`yyyy-MM-dd` to `MMddyyyy`."""
    return F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "MMddyyyy")
