"""Offsetting of long and short option positions.

Long and short positions of one client, option type and symbol offset each
other: first where a maturity nets to nothing, then along the maturities by a
balance that never rises above zero. Short quantities are negative."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tablecheck.functions.options import compact_date, contract_date, option_symbol, option_type, put_call
from tablecheck.model import RunInfo, TableRules
from tablecheck.operators.align import occurrence_number
from tablecheck.operators.windows import Order, capped_running_balance, numbered_groups, whole_groups
from tablecheck.plans.reconcile import run_table
from tablecheck.session import pin

GROUP = ("bor_client_id", "option_type", "underlying_symbol")
MATURITY = ("underlying", "option_maturitydate")
MATURITY_KEY = (*GROUP, *MATURITY)
LONG_KEY = (*MATURITY_KEY, "underlying_sec_name", "strikepriceamount")
HOME = "_home"
STRIKE = "decimal(30,6)"
QUANTITY = "decimal(30,0)"
REPORT_KEY = ("bor_client_id", "option_type", "symbol")
REPORT_ORDER = ("underlying", "expiry_maturity_date", "occ_qty_reported", "occ_strkprice_report")

# The constant fields of the report.
REPORT_CONSTANTS = {
    "txntyp": "4",
    "actn": "1",
    "id_clr": "00615",
    "id_acct": "C",
    "typ": "26",
    "txt": "Spreads",
    "typ_ias": "IAS",
}
# The report columns in their order.
REPORT_COLUMNS = (
    "bor_client_id", "underlying", "symbol", "underlying_sec_name", "option_type", "expiry_maturity_date",
    "occ_strkprice_report", "occ_qty_reported", "mmy", "series_contract_date", "p_c", "txntyp", "actn", "id_clr",
    "id_acct", "typ", "txt", "cfi", "typ_ias", "process_date", "run_date",
)

# What the report takes from the rows it reports.
REPORTED = (*GROUP, "underlying", "long_option_maturitydate", "occ_qty_reported", "occ_strkprice_report")

# Sort orders inside a group; all end in the same full tie break, so that the
# result does not depend on how rows arrive.
TIE_BREAK = (
    "underlying", "short_option_maturitydate", "underlying_sec_name", "source", "strikepriceamount",
    "short_quantity", "long_quantity",
)


def sequence_order(policy: str = "ordered", newest_first: bool = False) -> list[str | Column]:
    """`ordered`: maturity, strike. `ordered_alterix`: maturity, place of the long
    row that carries the short quantity, rows without one last. `unordered`:
    maturity."""
    maturity = F.desc("long_option_maturitydate") if newest_first else F.asc("long_option_maturitydate")
    between: dict[str, list[str | Column]] = {
        "ordered": [F.asc("strikepriceamount")],
        "ordered_alterix": [
            F.asc(F.col("carrier").isNull()),
            F.asc("underlying"),
            F.asc("carrier.underlying_sec_name"),
            F.asc("carrier.strikepriceamount"),
        ],
        "unordered": [],
    }
    return [maturity, *between[policy], *TIE_BREAK]


def enrich(positions: DataFrame) -> DataFrame:
    """Blank names fall back to the option name, absent symbols are derived."""
    name = F.col("underlying_sec_name")
    return positions.withColumns(
        {
            "underlying_sec_name": F.when(name.isNull() | (name == ""), F.col("option_name")).otherwise(name),
            "underlying_symbol": F.coalesce("underlying_symbol", option_symbol(F.col("option_name"))),
        }
    )


def aggregate(enriched: DataFrame) -> DataFrame:
    """Quantity per position; zero and NULL totals are dropped."""
    keys = [*GROUP, "underlying", "underlying_sec_name", "option_maturitydate", "short_or_long", "strikepriceamount"]
    return (
        enriched.withColumn("option_type", option_type(F.col("option_name")))
        .groupBy(*keys)
        .agg(F.sum(F.col("option_tradeqty").cast("decimal(20,0)")).cast(QUANTITY).alias("quantity"))
        .filter(F.col("quantity") != 0)
    )


def _blank_group() -> list[Column]:
    return [F.coalesce(F.col(g), F.lit("")) for g in GROUP]


def at_home(totals: DataFrame, blanks_meet: bool = True) -> DataFrame:
    """Rows with a home: a hash of their group, NULL and '' being alike. Every later key has the group,
    so rows that are dealt by it once need no other shuffle; the steps from `both_sides` to `settle`
    then look for what they need by windows, not by joins. For groups that fit in one piece.
    `blanks_meet`: a group column may have both NULL and '', so the group goes along without NULLs."""
    blank = _blank_group()
    values = {f"{HOME}{i}": b for i, b in enumerate(blank)} if blanks_meet else {}
    home = F.xxhash64(*blank)
    return totals.repartition(home).withColumns({HOME: home} | values)  # the hash itself is not moved


def _home(rows: DataFrame) -> list[str]:
    """The columns of `at_home`, or none."""
    return [c for c in rows.columns if c.startswith(HOME)]


def _of_group(home: Sequence[str], order: Order) -> WindowSpec:
    """The whole group of a row; `order` is the one that rows are sorted by anyway."""
    return W.partitionBy(*home, *GROUP).orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def _alike(home: Sequence[str], found: Column) -> Column:
    """Whether `found` holds for a group or for one that is alike."""
    return F.max(found).over(W.partitionBy(*home)) if len(home) > 1 else found


def _in_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows whose group is listed, NULL and '' being alike."""
    listed = groups.select(*[b.alias(f"_g{i}") for i, b in enumerate(_blank_group())])
    match = [F.coalesce(F.col(g), F.lit("")) == F.col(f"_g{i}") for i, g in enumerate(GROUP)]
    return rows.join(listed.hint("shuffle_hash"), match, "left_semi")


def both_sides(totals: DataFrame) -> DataFrame:
    """Positions of the groups that hold long and short ones."""
    side = F.col("short_or_long")
    if home := _home(totals):
        group = _of_group(home, MATURITY)
        found = totals.withColumn("_mixed", F.min(side).over(group) != F.max(side).over(group))
        kept = found.withColumn("_mixed", _alike(home, F.col("_mixed"))).filter("_mixed").drop("_mixed")
    else:
        groups = totals.groupBy(*GROUP).agg(F.min(side).alias("_low"), F.max(side).alias("_high"))
        kept = _in_groups(totals, groups.filter(F.col("_low") != F.col("_high")))
    return kept.withColumn("strikepriceamount", F.col("strikepriceamount").cast(STRIKE))


def side_totals(sided: DataFrame) -> DataFrame:
    """Quantity per maturity, side and name; long rows by strike as well, short
    rows over all strikes. One shuffle for both sides."""
    return side_sums(sided.filter(F.col("short_or_long").isin("Long", "Short")))


def side_sums(rows: DataFrame) -> DataFrame:
    """`side_totals` of rows of any side."""
    strike = F.col("strikepriceamount").cast(STRIKE)
    return (
        rows.withColumn("strikepriceamount", F.when(F.col("short_or_long") == "Long", strike))
        .groupBy(*_home(rows), *LONG_KEY, "short_or_long")
        .agg(F.sum("quantity").cast(QUANTITY).alias("quantity"))
    )


def sides_at_home(homed: DataFrame) -> DataFrame:
    """What `side_totals` gives of `both_sides`. Summed first, as sums have the sides of their group, so
    that fewer rows are sorted, and once for this and for `place`."""
    return both_sides(side_sums(homed)).filter(F.col("short_or_long").isin("Long", "Short"))


def long_rows(totals: DataFrame) -> DataFrame:
    return totals.filter(F.col("short_or_long") == "Long")


def maturities(sides: DataFrame) -> DataFrame:
    """Per maturity: the first long row by name and strike, which takes the whole short quantity,
    the long quantity, and whether there are short rows. Found by minima and maxima, so a large
    group combines before the shuffle. `maturity` has the key as one value."""
    quantity = F.sum(F.when(F.col("short_or_long") == "Long", F.col("quantity"))).cast(QUANTITY)
    first, with_short = _found()
    return sides.groupBy(_maturity("maturity")).agg(
        first.alias("carrier"), quantity.alias("quantity"), with_short.alias("with_short")
    )


def _found() -> tuple[Column, Column]:
    """The carrier of a maturity, and whether it has short rows."""
    long = F.col("short_or_long") == "Long"
    return F.min(F.when(long, F.struct("underlying_sec_name", "strikepriceamount", "quantity"))), F.max(~long)


def carriers(longs: DataFrame) -> DataFrame:
    """Per maturity with long rows, its carrier and their quantity."""
    return maturities(longs).select("maturity.*", "carrier", "quantity", "maturity")


def numbered_long_rows(longs: DataFrame) -> DataFrame:
    """Long rows numbered inside their maturity; number 1 is the carrier."""
    return numbered_groups(longs, MATURITY_KEY, ["underlying_sec_name", "strikepriceamount"], "row_id")


def short_rows(totals: DataFrame, by_name: bool = True) -> DataFrame:
    """One row per maturity and name; with `by_name=False` one row per maturity,
    under its first name."""
    shorts = totals.filter(F.col("short_or_long") == "Short").drop("strikepriceamount")
    if by_name:
        return shorts
    return shorts.groupBy(*_home(totals), *MATURITY_KEY, "short_or_long").agg(
        F.min("underlying_sec_name").alias("underlying_sec_name"), F.sum("quantity").cast(QUANTITY).alias("quantity")
    )


def _maturity(name: str) -> Column:
    """The maturity key as one value, whose NULLs are equal."""
    return F.struct(*MATURITY_KEY).alias(name)


def place_sides(longs: DataFrame, shorts: DataFrame) -> DataFrame:
    """Every long and short row with the carrier of its maturity and whether that has short rows.

    The one join of the two sides. A maturity is one row on its right side and may have very many
    rows on its left one, which adaptive execution can split; the right one is dealt by the
    maturity already."""
    return place(longs.unionByName(shorts, allowMissingColumns=True))


def place(sides: DataFrame) -> DataFrame:
    """`place_sides` of rows of both sides; at home a window has what the join looks up."""
    home = _home(sides)
    names = [
        *home, _maturity("maturity"), "underlying_sec_name", "strikepriceamount", F.col("quantity").alias("own"), "short_or_long",
    ]
    if home:
        of = W.partitionBy(*home, *GROUP, *MATURITY)
        carrier, with_short = (c.over(of) for c in _found())
        return sides.withColumns({"carrier": carrier, "with_short": with_short}).select(*names, "carrier", "with_short")
    rows = sides.select(*names)
    found = maturities(sides).select(F.col("maturity").alias("of"), "carrier", "with_short")
    return rows.join(found, F.col("maturity") == F.col("of")).drop("of")


PAIRED = (
    *GROUP, "underlying", "long_option_maturitydate", "short_option_maturitydate", "short_quantity",
    "underlying_sec_name", "carrier",
)
ATTACHED = (
    *GROUP, "underlying", "underlying_sec_name", "long_option_maturitydate", "short_option_maturitydate",
    "short_quantity", "long_quantity", "strikepriceamount", "source", "carrier",
)


def pair_sides(placed: DataFrame) -> DataFrame:
    """Full outer pairing of carriers and short rows on the maturity key: every short row with the
    carrier, if there is one, and the carriers of maturities without a short row."""
    return attach_rest(placed).filter(F.col("source") == "step4").select(*PAIRED)


def attach_rest(placed: DataFrame) -> DataFrame:
    """The pairs (`step4`), and the long rows that carry no short quantity (`step3.1`); one projection."""
    short, carrier = F.col("short_or_long") == "Short", F.col("carrier")
    first = [F.col(c).eqNullSafe(F.col(f"carrier.{c}")) for c in ("underlying_sec_name", "strikepriceamount")]
    carries = ~short & first[0] & first[1]
    paired, none = short | carries, F.lit(0).cast(QUANTITY)
    columns = {
        "underlying_sec_name": F.when(~carries, F.col("underlying_sec_name")),
        "long_option_maturitydate": F.col("maturity.option_maturitydate"),
        "short_option_maturitydate": F.when(short, F.col("maturity.option_maturitydate")),
        "short_quantity": F.when(short, F.col("own")).when(carries, none),
        "long_quantity": F.when(paired, F.coalesce("carrier.quantity", none)).otherwise(F.col("own")),
        "strikepriceamount": F.when(paired, F.coalesce("carrier.strikepriceamount", F.lit(0).cast(STRIKE))).otherwise(
            F.col("strikepriceamount")
        ),
        "source": F.when(paired, "step4").otherwise("step3.1"),
        "carrier": F.when(paired, carrier),
    }
    # a carrier that short rows have is in their rows
    kept = placed.filter(~(carries & F.col("with_short")))
    names = [columns[c].alias(c) if c in columns else F.col(f"maturity.{c}").alias(c) for c in ATTACHED]
    return kept.select(*_home(placed), *names)


def exact_offset(attached: DataFrame) -> DataFrame:
    """Rows whose short and long quantity cancel out are reported in full."""
    even = _even()
    return attached.withColumns(
        {
            "occ_qty_reported": F.when(even, F.col("long_quantity")).otherwise(F.lit(0).cast(QUANTITY)),
            "occ_strkprice_report": F.when(even, F.col("strikepriceamount")).otherwise(F.lit(0).cast(STRIKE)),
            "row_processed": F.when(even, "Yes").otherwise("No"),
        }
    )


def _even() -> Column:
    return F.col("short_quantity") + F.col("long_quantity") == 0


def processed(offset: DataFrame) -> DataFrame:
    return offset.filter(F.col("row_processed") == "Yes")


def unprocessed(offset: DataFrame) -> DataFrame:
    return offset.filter(F.col("row_processed") == "No")


def unpivot_sides(open_rows: DataFrame) -> DataFrame:
    """One row per side that is not zero."""
    kept = [c for c in open_rows.columns if c not in ("short_quantity", "long_quantity", "carrier")]
    sides = open_rows.select(
        *kept, F.col("short_quantity").alias("Short"), F.col("long_quantity").alias("Long")
    ).unpivot(kept, ["Short", "Long"], "short_or_long", "quantity")
    quantity = F.coalesce("quantity", F.lit(0).cast(QUANTITY))
    return sides.withColumn("quantity", quantity).filter(F.col("quantity") != 0)


def still_both_sides(open_rows: DataFrame) -> DataFrame:
    """Open rows of the groups that still have both sides; NULL becomes 0."""
    zero = F.lit(0).cast(QUANTITY)
    filled = {c: F.coalesce(c, zero) for c in ("short_quantity", "long_quantity")}
    groups = open_rows.groupBy(*GROUP).agg(
        F.max(F.coalesce(F.col("short_quantity") != 0, F.lit(False))).alias("_short"),
        F.max(F.coalesce(F.col("long_quantity") != 0, F.lit(False))).alias("_long"),
    )
    return _in_groups(open_rows, groups.filter(F.col("_short") & F.col("_long"))).withColumns(filled)


def sequence(open_rows: DataFrame, policy: str = "ordered", newest_first: bool = False) -> DataFrame:
    """Numbers the rows of each group and runs the capped balance over them."""
    return capped_running_balance(
        still_both_sides(open_rows),
        GROUP,
        sequence_order(policy, newest_first),
        F.col("long_quantity") + F.col("short_quantity"),
        number="row_seqno",
    )


def sequence_at_home(attached: DataFrame, policy: str = "ordered", newest_first: bool = False) -> DataFrame:
    """`exact_offset`, and `sequence` of the open rows beside the processed ones, which add nothing to
    the balance and all stay.

    One sort serves the balance and the search for open rows of both sides, which leaves out
    whole groups and may as well come after it, as may what is reported of processed rows: less goes
    through the windows. Rows are not numbered."""
    home, order, none = _home(attached), sequence_order(policy, newest_first), F.lit(0).cast(QUANTITY)
    filled = {c: F.coalesce(c, none) for c in ("short_quantity", "long_quantity")}
    is_open = ~F.coalesce(_even(), F.lit(False))
    amount = F.when(is_open, filled["long_quantity"] + filled["short_quantity"]).otherwise(none)
    group = _of_group(home, order)
    sides = {f"_{c}": F.max(is_open & (q != 0)).over(group) for c, q in filled.items()}
    run = capped_running_balance(attached, [*home, *GROUP], order, amount, whole=True, beside=sides)
    kept = run.withColumn("_both", F.col("_short_quantity") & F.col("_long_quantity"))
    kept = kept.withColumn("_both", _alike(home, F.col("_both"))).filter(~is_open | F.col("_both"))
    return exact_offset(kept.drop("_both", *sides)).withColumns(filled)


def allocate(sequenced: DataFrame) -> DataFrame:
    """What each row may report, given the short balance before it."""
    calc, reported = _allocation()
    out = sequenced.withColumns({"short_balance_calc": calc, "occ_qty_reported": reported})
    out = out.withColumn("occ_strkprice_report", F.when(F.col("occ_qty_reported") > 0, F.col("strikepriceamount")))
    return out.filter(F.col("occ_qty_reported") > 0)


def settle(sequenced: DataFrame) -> DataFrame:
    """Rows offset exactly, as they are, and rows that are allocated something, in one pass: what
    `processed` and `allocate` give, of rows at home."""
    done, given = F.col("row_processed") == "Yes", F.col("_given")
    rows = sequenced.withColumn("_given", _allocation()[1]).filter(done | (given > 0))
    strike = F.when(done, F.col("occ_strkprice_report")).otherwise(F.col("strikepriceamount"))
    quantity = F.when(done, F.col("occ_qty_reported")).otherwise(given)
    return rows.withColumns({"occ_strkprice_report": strike, "occ_qty_reported": quantity}).drop("_given")


def _allocation() -> tuple[Column, Column]:
    """The balance with the row, and what the row may report."""
    before, short, long = F.col("short_balance_prev"), F.col("short_quantity"), F.col("long_quantity")
    calc = before + short + long
    none = F.lit(0).cast(QUANTITY)
    reported = (
        F.when((calc < 0) & (long > 0), long)
        .when(calc < 0, none)
        .when((calc > 0) & (long > 0), F.when(before == 0, -short).otherwise(-before))
        .when(calc > 0, none)
        .otherwise(-before)
    )
    return calc, reported.cast(QUANTITY)


def the_one_value(seen: Observation, column: str) -> Column:
    """The single value of a column, from its least and greatest; more than one is an error."""
    low, high = seen.get["low"], seen.get["high"]
    if low != high:
        raise ValueError(f"{column} has more than one value: {low} and {high}")
    return F.lit(high).cast("string")


def report_rows(offset: DataFrame, allocated: DataFrame, process_date: str, run_date: Column) -> DataFrame:
    """The 21-column report: rows offset exactly and rows allocated."""
    rows = processed(offset).select(*REPORTED).unionByName(allocated.select(*REPORTED))
    return report_fields(rows, process_date, run_date)


def report_fields(rows: DataFrame, process_date: str, run_date: Column) -> DataFrame:
    """The columns of the report."""
    kind, maturity = F.col("option_type"), F.col("long_option_maturitydate")
    derived = {
        "symbol": F.col("underlying_symbol"),
        "underlying_sec_name": F.lit(""),
        "expiry_maturity_date": maturity,
        "mmy": compact_date(maturity),
        "series_contract_date": contract_date(maturity),
        "p_c": put_call(kind),
        "cfi": F.concat(F.lit("O"), put_call(kind), F.lit("XXXX")),
        "process_date": F.lit(process_date),
        "run_date": run_date,
    }
    constants = {name: F.lit(value) for name, value in REPORT_CONSTANTS.items()}
    return rows.withColumns(derived | constants).select(*REPORT_COLUMNS)


class Stages:
    """The stages of one run, each built once and only when asked for."""

    def __init__(
        self,
        positions: DataFrame,
        process_date: str,
        policy: str = "ordered",
        newest_first: bool = False,
        by_name: bool = True,
    ) -> None:
        self.positions = positions.filter(F.col("process_date") == process_date)
        self.process_date = process_date
        self._policy, self._newest_first = policy, newest_first
        self._by_name = by_name
        self._run_dates, self._blanks = Observation(), Observation()

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.positions)

    @cached_property
    def totals(self) -> DataFrame:
        return aggregate(self.enriched)

    @cached_property
    def sided(self) -> DataFrame:
        return both_sides(self.totals)

    @cached_property
    def pinned_totals(self) -> DataFrame:
        """Written once, as it is read for the groups and for their rows. The run dates are seen on
        the way, and whether a group column has NULL as well as '', so nothing is read for them again."""
        least, greatest = F.min("run_date").alias("low"), F.max("run_date").alias("high")
        seen = self.positions.observe(self._run_dates, least, greatest)
        kinds = [F.max(c).alias(f"{g}{i}") for g in GROUP for i, c in enumerate((F.col(g).isNull(), F.col(g) == ""))]
        return pin(aggregate(enrich(seen)).observe(self._blanks, *kinds), "totals")

    @cached_property
    def homed(self) -> DataFrame | None:
        """The totals at home, if all groups fit in one piece; later steps have no more rows of a group."""
        if not whole_groups(self.pinned_totals, _blank_group()):
            return None
        kinds = self._blanks.get
        return at_home(self.pinned_totals, any(kinds[f"{g}0"] and kinds[f"{g}1"] for g in GROUP))

    @cached_property
    def pinned_sides(self) -> DataFrame:
        """Written once: what needs both sides reads it, and the short rows."""
        return pin(side_totals(both_sides(self.pinned_totals)))

    @cached_property
    def longs(self) -> DataFrame:
        """Written once: the carriers and the numbering read it. Short rows are left out before the
        joins and sums, where only their groups count."""
        return pin(long_rows(side_totals(both_sides(self.pinned_totals))), "longs")

    @cached_property
    def carried(self) -> DataFrame:
        return carriers(self.longs)

    @cached_property
    def shorts(self) -> DataFrame:
        return short_rows(self.pinned_sides, self._by_name)

    @cached_property
    def placed(self) -> DataFrame:
        return place_sides(long_rows(self.pinned_sides), self.shorts)

    @cached_property
    def paired(self) -> DataFrame:
        return pair_sides(self.placed)

    @cached_property
    def attached(self) -> DataFrame:
        return attach_rest(self.placed)

    @cached_property
    def offset(self) -> DataFrame:
        return exact_offset(self.attached)

    @cached_property
    def pinned_offset(self) -> DataFrame:
        """Written once: the allocation and the report both read it."""
        return pin(self.offset)

    @cached_property
    def unpivoted(self) -> DataFrame:
        return unpivot_sides(unprocessed(self.pinned_offset))

    @cached_property
    def sequenced(self) -> DataFrame:
        rows = unprocessed(self.pinned_offset)
        if self._policy != "ordered_alterix":  # the one order that looks at the carrier
            rows = rows.drop("carrier")
        return sequence(rows, self._policy, self._newest_first)

    @cached_property
    def allocated(self) -> DataFrame:
        return allocate(self.sequenced)

    @cached_property
    def settled(self) -> DataFrame | None:
        """What is reported, from one shuffle of the totals; None if a group is too large for that."""
        if self.homed is None:
            return None
        sides = sides_at_home(self.homed)
        placed = place(sides) if self._by_name else place_sides(long_rows(sides), short_rows(sides, False))
        rows = attach_rest(placed)
        if self._policy != "ordered_alterix":
            rows = rows.drop("carrier")
        return settle(sequence_at_home(rows, self._policy, self._newest_first))

    @cached_property
    def report(self) -> DataFrame:
        if self.settled is not None:
            run_date = the_one_value(self._run_dates, "run_date")
            return report_fields(self.settled.select(*REPORTED), self.process_date, run_date)
        offset = self.pinned_offset  # has been written, and the positions read
        return report_rows(offset, self.allocated, self.process_date, the_one_value(self._run_dates, "run_date"))


def netting_report(positions: DataFrame, process_date: str, **options) -> DataFrame:
    return Stages(positions, process_date, **options).report


def report_for_compare(report: DataFrame) -> DataFrame:
    """Report rows with an occurrence number, which makes their key unique."""
    rows = report.withColumn("occ_strkprice_report", F.col("occ_strkprice_report").cast("string"))
    return occurrence_number(rows, REPORT_KEY, REPORT_ORDER, "rnm")


def reconcile_report(report: DataFrame, target: DataFrame, run: RunInfo, ignore: Sequence[str] = ()) -> DataFrame:
    """The report against the delivered table: comparison and checks."""
    rules = TableRules(
        "reporting_occ", pk_col=(*REPORT_KEY, "rnm"), non_nullable_col=REPORT_KEY, ignore_col=tuple(ignore)
    )
    src, tgt = report_for_compare(report), report_for_compare(target)
    return run_table(src, tgt, rules, run, unique=True)
