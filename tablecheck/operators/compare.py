"""Cell-by-cell comparison of paired rows, and its counts per column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.columns import Coverage, coverage, is_text
from tablecheck.model import CELL_COUNT, PREFIX, TableRules
from tablecheck.operators.align import Pairing, common_type, comparable
from tablecheck.operators.windows import running_total

TOLERANCE_TYPE = T.DecimalType(31, 6)


@dataclass(frozen=True)
class CellRule:
    """How one column is compared. `kind`: text, typed, tolerance or absent."""

    column: str
    kind: str
    wide: T.DataType | None = None
    percent: float = 0.0
    signed: bool = False

    def amount(self, column: Column) -> Column:
        value = F.coalesce(column.cast(TOLERANCE_TYPE), F.lit(0).cast(TOLERANCE_TYPE))
        return (value if self.signed else F.abs(value)).cast("double")

    def bounds(self, amount: Column) -> tuple[Column, Column]:
        low, high = amount * F.lit(1 - self.percent / 100), amount * F.lit(1 + self.percent / 100)
        return (F.least(low, high), F.greatest(low, high)) if self.signed else (low, high)

    def canonical(self, column: Column) -> Column:
        """Text that is equal exactly when two cells pass; NULL cells give ''."""
        if isinstance(self.wide, (T.DoubleType, T.FloatType)):
            column = column.cast(self.wide) + F.lit(0.0).cast(self.wide)
        elif self.wide is not None:
            column = column.cast(self.wide)
        return F.coalesce(column.cast("string"), F.lit(""))

    def passes(self) -> Column:
        src, tgt = F.col(PREFIX + self.column), F.col(self.column)
        if self.kind == "absent":
            return F.lit(False)
        if self.kind == "tolerance":
            return self.amount(tgt).between(*self.bounds(self.amount(src)))
        if self.kind == "typed":
            return src.eqNullSafe(tgt)
        return self.canonical(tgt) == self.canonical(src)


def cell_rules(
    src: DataFrame, tgt: DataFrame, rules: TableRules, compare: str = "typed", signed: bool = False
) -> tuple[Coverage, list[CellRule]]:
    """`compare="typed"` compares values as they are, with '' and NULL text alike;
    `compare="text"` compares everything as text."""
    found = coverage([c.removeprefix(PREFIX) for c in src.columns], tgt.columns, rules.ignore_col)
    out = []
    for name in tgt.columns:
        if name in found.tgt_only:
            out.append(CellRule(name, "absent"))
        elif name not in found.compared:
            continue
        elif name in rules.threshold_col:
            out.append(CellRule(name, "tolerance", percent=rules.threshold_val_perc, signed=signed))
        else:
            s, t = src.schema[PREFIX + name].dataType, tgt.schema[name].dataType
            if compare == "text" or is_text(s) or is_text(t) or not comparable(s, t):
                out.append(CellRule(name, "text"))
            else:
                out.append(CellRule(name, "typed", wide=common_type(src.sparkSession, s, t)))
    return found, out


def row_status() -> Column:
    return (
        F.when(F.col("_in_src") & F.col("_in_tgt"), "matched").when(F.col("_in_src"), "src_only").otherwise("tgt_only")
    )


def compare_cells(pairing: Pairing, found: Coverage, rules: Sequence[CellRule]) -> DataFrame:
    """`x, qa_x, status_x, x_null` per column, then ignored and source-only
    columns, then `row_status`; one projection.

    Rows of keys that both sides repeat are paired by what they have in common, then by
    occurrence, see `Pairing.rows`."""
    columns: list[Column] = []
    for rule in rules:
        source = F.lit(None).cast("string") if rule.kind == "absent" else F.col(PREFIX + rule.column)
        columns += [
            F.col(rule.column),
            source.alias(PREFIX + rule.column),
            F.when(rule.passes(), "PASS").otherwise("FAIL").alias(f"status_{rule.column}"),
            F.col(rule.column).isNull().cast("int").alias(f"{rule.column}_null"),
        ]
    compared = {rule.column for rule in rules}
    columns += [F.col(c) for c in found.ignored]
    columns += [F.col(PREFIX + c) for c in found.src_only if c not in compared]
    return pairing.rows(found.ignored).select(*columns, row_status().alias("row_status"))


def long_cells(pairing: Pairing, rules: Sequence[CellRule], ignored: Sequence[str] = ()) -> DataFrame:
    """(key columns, column_name, src_value, tgt_value, status), one row per cell."""
    keys = [
        F.coalesce(F.col(k).cast("string"), F.col(PREFIX + k).cast("string")).alias(f"key_{k}") for k in pairing.keys
    ]
    cells = [
        F.struct(
            F.lit(r.column).alias("column_name"),
            (F.lit(None) if r.kind == "absent" else F.col(PREFIX + r.column)).cast("string").alias("src_value"),
            F.col(r.column).cast("string").alias("tgt_value"),
            F.when(r.passes(), "PASS").otherwise("FAIL").alias("status"),
        )
        for r in rules
    ]
    return pairing.rows(ignored).select(*keys, F.inline(F.array(*cells)))


def unmatched_counts(pairing: Pairing) -> DataFrame:
    """One row: `src_only` and `tgt_only` rows, and how many of them have a blank
    key. Of a key that both sides repeat it is what one side has more of, as in `Pairing.rows`;
    the surplus follows from counts by key."""

    def blank(values: Sequence[Column]) -> Column:
        found = F.lit(False)
        for value in values:
            found = found | (F.coalesce(value.cast("string"), F.lit("")) == "")
        return found

    src_only, tgt_only = F.col("_in_src") & ~F.col("_in_tgt"), F.col("_in_tgt") & ~F.col("_in_src")
    no_key = blank([F.coalesce(F.col(k).cast("string"), F.col(PREFIX + k).cast("string")) for k in pairing.keys])
    found = pairing.joined.agg(
        F.count_if(src_only).alias("src_only"),
        F.count_if(tgt_only).alias("tgt_only"),
        F.count_if((src_only | tgt_only) & no_key).alias("blank_keys"),
    )
    if pairing.many_src is None or pairing.many_tgt is None:
        return found
    k, one, none = _key_names(pairing), F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    if pairing.bag is not None:
        sides = pairing.bag.rows.select(*k, F.col("n_src").alias("_s"), F.col("n_tgt").alias("_t"))
    else:
        sides = pairing.many_src.select(*k, one.alias("_s"), none.alias("_t"))
        sides = sides.unionAll(pairing.many_tgt.select(*k, none.alias("_s"), one.alias("_t")))
    counts = sides.groupBy(*k).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    more_src = F.greatest(F.col("_s") - F.col("_t"), none) if pairing.how in ("full", "left") else none
    more_tgt = F.greatest(F.col("_t") - F.col("_s"), none) if pairing.how in ("full", "right") else none
    surplus = counts.select(
        more_src.alias("src_only"),
        more_tgt.alias("tgt_only"),
        F.when(blank([F.col(c) for c in k]), more_src + more_tgt).otherwise(none).alias("blank_keys"),
    )
    names = ("src_only", "tgt_only", "blank_keys")
    return found.unionByName(surplus).agg(*[F.sum(c).alias(c) for c in names])


def _count_joined(joined: DataFrame, rules: Sequence[CellRule]) -> DataFrame:
    """All counters in one aggregate over one pass, then one row per column."""
    counters = [F.count(F.lit(1)).alias("_rows")]
    for i, rule in enumerate(rules):
        counters.append(F.count_if(rule.passes()).alias(f"_p{i}"))
        counters.append(F.count_if(F.col(rule.column).isNull()).alias(f"_n{i}"))
    per_column = [
        F.struct(
            F.lit(rule.column).alias("column_name"),
            F.col(f"_p{i}").cast(CELL_COUNT).alias("pass_count"),
            (F.col("_rows") - F.col(f"_p{i}")).cast(CELL_COUNT).alias("fail_count"),
            F.col(f"_n{i}").cast(CELL_COUNT).alias("null_count"),
        )
        for i, rule in enumerate(rules)
    ]
    return joined.agg(*counters).select(F.inline(F.array(*per_column)))


def _key_names(pairing: Pairing) -> list[str]:
    return [f"_k{i}" for i in range(len(pairing.keys))]


def _value_counts(pairing: Pairing, rules: Sequence[CellRule]) -> DataFrame:
    """(key, column_name, value, amount, n_src, n_tgt, n_tgt_null)."""
    k = _key_names(pairing)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def unpivot(df: DataFrame, prefix: str, n_src: Column, n_tgt: Column) -> DataFrame:
        cells = []
        for r in rules:
            cell = F.lit(None).cast("string") if r.kind == "absent" and prefix else F.col(prefix + r.column)
            banded = r.kind == "tolerance"
            cells.append(
                F.struct(
                    F.lit(r.column).alias("column_name"),
                    (F.lit(None).cast("string") if banded else r.canonical(cell)).alias("value"),
                    (r.amount(cell) if banded else F.lit(None).cast("double")).alias("amount"),
                    cell.isNull().alias("_null"),
                )
            )
        long = df.select(*k, n_src.alias("_s"), n_tgt.alias("_t"), F.inline(F.array(*cells)))
        nulls = F.when(F.col("_null"), F.col("_t")).otherwise(none) if not prefix else none
        return long.select(*k, "column_name", "value", "amount", "_s", "_t", nulls.alias("_n"))

    if pairing.bag is not None:  # a distinct row is one for both sides
        both = unpivot(pairing.bag.rows, "", F.col("n_src"), F.col("n_tgt"))
    else:
        both = unpivot(pairing.many_src, PREFIX, one, none).unionAll(unpivot(pairing.many_tgt, "", none, one))
    return both.groupBy(*k, "column_name", "value", "amount").agg(
        F.sum("_s").alias("n_src"), F.sum("_t").alias("n_tgt"), F.sum("_n").alias("n_tgt_null")
    )


def many_cells(pairing: Pairing, rules: Sequence[CellRule]) -> DataFrame | None:
    """For keys that both sides repeat: how often each value occurs per key
    and column on either side. Every pair follows from it, but it only has as
    many rows as there are different cells."""
    if pairing.many_src is None or pairing.many_tgt is None:
        return None
    named = {c: f"key_{name}" for c, name in zip(_key_names(pairing), pairing.keys, strict=True)}
    return _value_counts(pairing, rules).withColumnsRenamed(named)


def _product(a: Column, b: Column) -> Column:
    return (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(CELL_COUNT)


def _cell_total(column: str) -> Column:
    return F.sum(F.col(column).cast(CELL_COUNT)).cast(CELL_COUNT)


def _count_many(pairing: Pairing, rules: Sequence[CellRule]) -> list[DataFrame]:
    """The counters of the pairs of repeated keys, without making the pairs; their sums by column
    are what counts. All pairs first count as failed, those that pass are then taken off."""
    if pairing.many_src is None or pairing.many_tgt is None:
        return []
    exact = [r for r in rules if r.kind not in ("tolerance", "absent")]
    banded = [r for r in rules if r.kind == "tolerance"]
    parts = [_count_all(pairing, rules)]
    parts += [_count_exact(pairing, exact)] if exact else []
    return parts + ([_count_band(pairing, banded)] if banded else [])


def _count_all(pairing: Pairing, rules: Sequence[CellRule]) -> DataFrame:
    """A key's pairs are its source rows times its target rows, and those with a NULL target cell
    its source rows times such targets; no values are needed."""
    k, one, none = _key_names(pairing), F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def nulls(n_tgt: Column) -> list[Column]:
        return [F.when(F.col(r.column).isNull(), n_tgt).otherwise(none).alias(f"_n{i}") for i, r in enumerate(rules)]

    if pairing.bag is not None:
        sides = pairing.bag.rows.select(*k, F.col("n_src").alias("_s"), F.col("n_tgt").alias("_t"), *nulls(F.col("n_tgt")))
    else:
        empty = [none.alias(f"_n{i}") for i in range(len(rules))]
        sides = pairing.many_src.select(*k, one.alias("_s"), none.alias("_t"), *empty)
        sides = sides.unionAll(pairing.many_tgt.select(*k, none.alias("_s"), one.alias("_t"), *nulls(one)))
    sums = ["_t", *[f"_n{i}" for i in range(len(rules))]]
    per_key = sides.groupBy(*k).agg(*[F.sum(c).alias(c) for c in ("_s", *sums)])
    zero = F.lit(0).cast(CELL_COUNT)
    totals = per_key.agg(*[F.coalesce(F.sum(_product(F.col("_s"), F.col(c))).cast(CELL_COUNT), zero).alias(c) for c in sums])
    counters = [
        F.struct(F.lit(r.column).alias("column_name"), zero.alias("pass_count"), F.col("_t").alias("fail_count"), F.col(f"_n{i}").alias("null_count"))
        for i, r in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*counters)))


def _passed(pairs: DataFrame, passing: Column) -> DataFrame:
    """The passing pairs by column, taken off the failed ones."""
    found = pairs.groupBy("column_name").agg(F.sum(passing).cast(CELL_COUNT).alias("pass_count"))
    return found.select("column_name", "pass_count", (-F.col("pass_count")).cast(CELL_COUNT).alias("fail_count"), F.lit(0).cast(CELL_COUNT).alias("null_count"))


def _count_exact(pairing: Pairing, rules: Sequence[CellRule]) -> DataFrame:
    """A key's passing pairs are the sum over its values of source copies times
    target copies."""
    counts = _value_counts(pairing, rules).filter("n_src > 0 and n_tgt > 0")
    return _passed(counts, _product(F.col("n_src"), F.col("n_tgt")))


def _count_band(pairing: Pairing, rules: Sequence[CellRule]) -> DataFrame:
    """A key's passing pairs are, over its source values, the targets up to the
    upper bound less the targets below the lower bound. Both are running totals
    along the key's sorted values; `place` puts a target between the two bounds
    of an equal value. One sort serves all columns."""
    k = [*_key_names(pairing), "column_name"]
    zero = F.lit(0).cast("bigint")
    low = high = F.lit(None).cast("double")
    for rule in rules:
        here = F.col("column_name") == rule.column
        bounds = rule.bounds(F.col("amount"))
        low, high = F.when(here, bounds[0]).otherwise(low), F.when(here, bounds[1]).otherwise(high)

    def mark(point: Column, place: int, targets: Column, weight: Column) -> Column:
        return F.struct(
            point.alias("point"), F.lit(place).alias("place"), targets.alias("targets"), weight.alias("weight")
        )

    marks = F.array(
        mark(low, 0, zero, -F.col("n_src")),
        mark(F.col("amount"), 1, F.col("n_tgt"), zero),
        mark(high, 2, zero, F.col("n_src")),
    )
    counts = _value_counts(pairing, rules)
    placed = counts.select(*k, F.inline(marks)).filter((F.col("targets") != 0) | (F.col("weight") != 0))
    run = running_total(placed, k, ["point", "place"], "targets", "_below")
    return _passed(run, _product(F.col("weight"), F.col("_below")))


def count_cells(pairing: Pairing, rules: Sequence[CellRule]) -> DataFrame:
    """(column_name, pass_count, fail_count, null_count)."""
    parts = _count_joined(pairing.joined, rules)
    many = _count_many(pairing, rules)
    if not many:
        return parts
    for part in many:
        parts = parts.unionByName(part)
    counters = ("pass_count", "fail_count", "null_count")
    return parts.groupBy("column_name").agg(*[_cell_total(c).alias(c) for c in counters])
