"""Ordered window operators that hold up when one group has most of the rows.

Rows are sorted by (group, order) over all tasks, whatever the sizes of the groups, so a group
may be cut anywhere. Each piece is windowed on its own. Only the group that a piece begins with
can have rows before it, so a piece needs one carry at most: what the pieces before it
have of that group, which is their last one. The carry table has at most one row per piece
and is what is broadcast. Nothing is counted and no group is set apart by its size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecheck.functions.columns import fresh, null_safe
from tablecheck.session import pin

Order = Sequence[str | Column]
#: Rows up to which a group is worked on in one piece; any value gives the same results.
WHOLE_GROUP_ROWS = 1_000_000
#: Shares of all groups that are counted before the groups themselves.
SHARES = 1 << 16


def whole_groups(df: DataFrame, group: Sequence[str | Column]) -> bool:
    """Whether no group of these staged rows has more than WHOLE_GROUP_ROWS rows.

    Counted by a hash of the group: should two meet in one hash, that count is too high, never too
    low. All hashes are first counted in SHARES shares, which hardly shuffles anything."""
    of_group = F.xxhash64(*group)
    for share in (F.pmod(of_group, F.lit(SHARES)), of_group):
        counts = df.groupBy(share.alias("share")).agg(F.count(F.lit(1)).alias("rows"))
        if (counts.agg(F.max("rows")).first()[0] or 0) <= WHOLE_GROUP_ROWS:
            return True
    return False


def ordered_pieces(df: DataFrame, group: Sequence[str], order: Order, piece: str = "_piece", pos: str = "_pos") -> DataFrame:
    """Sorts by (group, order) over all tasks and adds `piece` (the task) and
    `pos` (the place in it, from 0), both increasing along the order.

    Equal rows may fall on both sides of a cut, so a group of copies is cut as
    well; a tie number is what tells them apart. Sorting by (group, order) and hash before handing
    it out makes it the same when a task is rerun, and like rows go through the shuffle side by
    side, so it is compressed well. The staged copy keeps the cuts the same for every later reader."""
    hashed_as, tie = fresh(df.columns, "_hash", "_tie")
    hashed = df.withColumn(hashed_as, F.xxhash64(*df.columns)).sortWithinPartitions(*group, *order, hashed_as)
    ready = hashed.withColumn(tie, F.monotonically_increasing_id()).drop(hashed_as)
    laid = ready.repartitionByRange(*group, *order, tie).sortWithinPartitions(*group, *order, tie)
    place = F.monotonically_increasing_id()
    marks = {piece: F.shiftright(place, 33).cast("int"), pos: place.bitwiseAND(F.lit((1 << 33) - 1))}
    return pin(laid.drop(tie).withColumns(marks), "pieces")


def edge_rows(pieces: DataFrame, group: Sequence[str], piece: str, pos: str) -> DataFrame:
    """The rows that `border_carry` looks at: the first one of each piece, and all of its last group.
    What is windowed to find the carries is these rows only, not the table."""
    at, end = fresh(pieces.columns, "_at", "_end")
    ends = pieces.groupBy(F.col(piece).alias(at)).agg(F.max(pos).alias(end))
    last = pieces.join(F.broadcast(ends), (F.col(piece) == F.col(at)) & (F.col(pos) == F.col(end)))
    last = last.select(at, *[F.col(g).alias(f"{at}{i}") for i, g in enumerate(group)])
    same = null_safe([(F.col(g), F.col(f"{at}{i}")) for i, g in enumerate(group)])
    found = pieces.join(F.broadcast(last), F.col(piece) == F.col(at)).filter((F.col(pos) == 0) | same)
    return found.select(*pieces.columns)


def border_carry(local: DataFrame, group: Sequence[str], piece: str, pos: str, ends: dict[str, Column]) -> DataFrame:
    """(_at, _head, ends...): for each piece whose first group goes back over its border, the piece,
    that group and the `ends` of all pieces before that have it, each as a list in their order.

    `ends` are taken at the last row of a piece, where running values of its last group are complete.
    From here on there are two rows per piece, whatever the table's size."""
    of_group = F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)])
    values = F.struct(*[e.alias(n) for n, e in ends.items()])
    edges = local.groupBy(F.col(piece).alias("_at")).agg(
        F.min_by(of_group, pos).alias("_head"), F.max_by(F.struct(of_group.alias("g"), values.alias("v")), pos).alias("_tail")
    )
    heads = edges.select("_at", F.lit(0).alias("_end"), F.col("_head").alias("_g"), F.lit(None).cast(edges.schema["_tail"].dataType["v"].dataType).alias("_v"))
    tails = edges.select("_at", F.lit(1).alias("_end"), F.col("_tail.g").alias("_g"), F.col("_tail.v").alias("_v"))
    before = W.partitionBy("_g").orderBy("_at", "_end").rowsBetween(W.unboundedPreceding, -1)
    events = heads.unionByName(tails)
    return events.select("_at", "_end", F.col("_g").alias("_head"), "_v.*", F.count("_v").over(before).alias("_pieces"))


def _carried(events: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The carry of each piece: `columns` over what comes before it."""
    return events.withColumns(columns).filter("_end = 0 AND _pieces > 0").select("_at", "_head", *columns)


def _before(name: str = "_head"):
    return W.partitionBy(name).orderBy("_at", "_end").rowsBetween(W.unboundedPreceding, -1)


def _with_carry(local: DataFrame, carry: DataFrame, group: Sequence[str], piece: str) -> tuple[DataFrame, Column]:
    """The rows with the carry of their piece, and whether it is for their group."""
    joined = local.join(F.broadcast(carry), F.col(piece) == F.col("_at"), "left")
    same = null_safe([(F.col(g), F.col(f"_head.g{i}")) for i, g in enumerate(group)])
    return joined, F.col("_at").isNotNull() & same


def numbered(df: DataFrame, group: Sequence[str], order: Order, name: str = "row_id") -> DataFrame:
    """`row_number() over (partition by group order by order)`.

    Without a group, sorted pieces need no window: a row's number is the size of the
    pieces before its own plus its place there."""
    group = list(group)
    piece, pos, local_number = fresh([*df.columns, name], "_piece", "_pos", "_number")
    pieces = ordered_pieces(df, group, order, piece, pos)
    if not group:
        sizes = pieces.groupBy(F.col(piece).alias("_at")).agg(F.count(F.lit(1)).alias("_size"))
        rows_before = F.sum("_size").over(W.orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
        carry = sizes.select("_at", F.coalesce(rows_before, F.lit(0)).alias("_start"))
        counted = pieces.join(F.broadcast(carry), F.col(piece) == F.col("_at"))
        return counted.select(*df.columns, (F.col("_start") + F.col(pos) + 1).alias(name))
    w = W.partitionBy(piece, *group).orderBy(pos)
    place = {local_number: F.row_number().over(w).cast("bigint")}
    edges = edge_rows(pieces, group, piece, pos).withColumns(place)
    events = border_carry(edges, group, piece, pos, {"_rows": F.col(local_number)})
    carry = _carried(events, {"_skip": F.sum("_rows").over(_before())})
    counted, same = _with_carry(pieces.withColumns(place), carry, group, piece)
    number = F.col(local_number) + F.when(same, F.col("_skip")).otherwise(F.lit(0))
    return counted.select(*df.columns, number.alias(name))


def numbered_groups(df: DataFrame, group: Sequence[str], order: Order, name: str = "row_id") -> DataFrame:
    """As `numbered`, for staged rows whose groups are mostly small, at one shuffle of the rows.

    Groups of up to WHOLE_GROUP_ROWS rows are windowed as they are. Larger ones, of which there can
    only be few, are cut into pieces: that is the exact way for groups of any size."""
    group = list(group)
    whole = F.row_number().over(W.partitionBy(*group).orderBy(*order)).cast("bigint").alias(name)
    key, of = fresh([*df.columns, name], "_key", "_of")
    if whole_groups(df, group):
        return df.select("*", whole)
    large = df.groupBy(F.struct(*group).alias(of)).agg(F.count(F.lit(1)).alias("rows"))  # one value, whose NULLs are equal
    large = pin(large.filter(F.col("rows") > WHOLE_GROUP_ROWS).select(of), "large-groups")
    keyed, listed = df.withColumn(key, F.struct(*group)), F.broadcast(large)
    found = [keyed.join(listed, F.col(key) == F.col(of), how).drop(key) for how in ("left_anti", "left_semi")]
    return found[0].select("*", whole).unionByName(numbered(found[1], group, order, name))


def running_total(df: DataFrame, group: Sequence[str], order: Order, value: str, name: str) -> DataFrame:
    """Running sum along (group, order), which starts anew in every group."""
    group = list(group)
    piece, pos, run = fresh([*df.columns, name], "_piece", "_pos", "_run")
    pieces = ordered_pieces(df, group, order, piece, pos)
    upto = W.partitionBy(piece, *group).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    edges = edge_rows(pieces, group, piece, pos).withColumn(run, F.sum(value).over(upto))
    events = border_carry(edges, group, piece, pos, {"_sum": F.col(run)})
    carry = _carried(events, {"_start": F.sum("_sum").over(_before())})
    placed, same = _with_carry(pieces.withColumn(run, F.sum(value).over(upto)), carry, group, piece)
    total = F.col(run) + F.coalesce(F.when(same, F.col("_start")), F.lit(0))
    return placed.select(*df.columns, total.alias(name))


def capped_running_balance(
    df: DataFrame,
    group: Sequence[str],
    order: Order,
    amount: Column,
    balance: str = "short_balance",
    previous: str = "short_balance_prev",
    number: str | None = None,
    whole: bool = False,
    beside: dict[str, Column] | None = None,
) -> DataFrame:
    """Balance that never rises above zero: b = min(0, b_before + amount).

    Closed form: running sum minus the largest running sum so far (not below
    zero). `order` must leave no ties. `number` also adds the row number. `whole`: no group has more
    than WHOLE_GROUP_ROWS rows, so groups are windowed as they are, without pieces; `beside` are more
    columns over the same groups and order then, which share the window."""
    group, beside = list(group), beside or {}
    taken = [*df.columns, balance, previous, number or "", *beside]
    piece, pos, value, total, top, place, total_prev, top_prev = fresh(
        taken, "_piece", "_pos", "_amount", "_sum", "_top", "_number", "_sum_prev", "_top_prev"
    )
    zero = F.lit(0)
    valued = df.withColumn(value, F.coalesce(amount, zero))
    w = W.partitionBy(*group).orderBy(*order) if whole else W.partitionBy(piece, *group).orderBy(pos)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)

    # what is before a row has a frame of its own, which needs no pass over the group of its own
    earlier = w.rowsBetween(W.unboundedPreceding, -1)

    if whole:
        # the sum before a row is 0 at first, so the highest one so far is never below zero
        place_of = {place: F.row_number().over(w).cast("bigint")} if number else {}
        sums = valued.withColumns({total: F.sum(value).over(upto)} | place_of | beside)
        sums = sums.withColumn(total_prev, F.col(total) - F.col(value))
        high_prev = F.max(total_prev).over(upto)
        highs = sums.withColumn(top_prev, high_prev).withColumn(top, F.greatest(top_prev, total))
        numbers = [F.col(place).alias(number)] if number else []
        now, before = (F.col(t) - F.col(h) for t, h in ((total, top), (total_prev, top_prev)))
        return highs.select(*df.columns, *numbers, *beside, now.alias(balance), before.alias(previous))

    pieces = ordered_pieces(valued, group, order, piece, pos)

    def running(rows: DataFrame) -> DataFrame:
        number = F.row_number().over(w).cast("bigint")
        sums = rows.withColumns({total: F.sum(value).over(upto), total_prev: F.sum(value).over(earlier), place: number})
        return sums.withColumns({top: F.max(total).over(upto), top_prev: F.max(total).over(earlier)})

    local = running(pieces)
    events = border_carry(running(edge_rows(pieces, group, piece, pos)), group, piece, pos, {"_whole": F.col(total), "_peak": F.col(top), "_rows": F.col(place)})
    starts = {"_start": F.coalesce(F.sum("_whole").over(_before()), zero), "_skip": F.sum("_rows").over(_before())}
    carry = _carried(events.withColumns(starts), {"_start": F.col("_start"), "_skip": F.col("_skip"), "_high": F.max(F.col("_start") + F.col("_peak")).over(_before())})
    placed, same = _with_carry(local, carry, group, piece)
    start, skip = (F.coalesce(F.when(same, F.col(c)), zero) for c in ("_start", "_skip"))
    # the highest sum so far, never below zero, with the row and before it
    high = F.greatest(F.when(same, F.col("_high")), start + F.col(top), zero)
    high_prev = F.greatest(F.when(same, F.col("_high")), start + F.col(top_prev), zero)
    numbers = [(skip + F.col(place)).alias(number)] if number else []
    now = start + F.col(total) - high
    # 0 before the first row of a group; before the first of a piece it is what the carry leaves
    before = start + F.coalesce(F.col(total_prev), zero) - high_prev
    return placed.select(*df.columns, *numbers, now.alias(balance), before.alias(previous))
