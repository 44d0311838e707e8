"""Pairing the rows of a source and a target table.

Source columns carry the `qa_` prefix, target columns bare names. A joined
frame also has `_in_src` and `_in_tgt`."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.columns import is_text, null_safe, prefix_source
from tablecheck.model import PREFIX
from tablecheck.operators.windows import numbered, whole_groups
from tablecheck.session import pin

ROW_ID = "row_id"


def common_type(spark: SparkSession, left: T.DataType, right: T.DataType) -> T.DataType:
    """The type Spark itself would compare the two in."""
    if left == right:
        return left
    both = F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right))
    return spark.range(0).select(both.alias("x")).schema[0].dataType


def comparable(left: T.DataType, right: T.DataType) -> bool:
    """Whether the two can be compared as they are, without going through text."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return (
        left == right
        or (is_text(left) and is_text(right))
        or (isinstance(left, T.NumericType) and isinstance(right, T.NumericType))
        or (isinstance(left, times) and isinstance(right, times))
    )


def key_columns(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> list[tuple[str, Column, Column]]:
    """(name, source expression, target expression), NULL and '' being one key."""
    out = []
    for key in keys:
        s, t = F.col(PREFIX + key), F.col(key)
        s_type, t_type = src.schema[PREFIX + key].dataType, tgt.schema[key].dataType
        if is_text(s_type) or is_text(t_type) or not comparable(s_type, t_type):
            s = F.coalesce(s.cast("string"), F.lit(""))
            t = F.coalesce(t.cast("string"), F.lit(""))
        elif s_type != t_type:
            wide = common_type(src.sparkSession, s_type, t_type)
            s, t = s.cast(wide), t.cast(wide)
        out.append((key, s, t))
    return out


#: Copies that one step makes from a count; more are dealt out in portions of so many.
PORTION = 4096


@dataclass(frozen=True)
class Bag:
    """The distinct rows of two sides with the same columns, staged: `columns`, the key values `_k0`...,
    `n_src`, `n_tgt`, `n_met` (the smaller of the two) and `_class` of `_repeated_keys`. Rows are as
    they were, so NULL and '', and 0 and -0, are apart here."""

    rows: DataFrame
    columns: tuple[str, ...]

    def of(self, name: str | None) -> Bag:
        wanted = F.col("_class").isNull() if name is None else F.col("_class") == name
        return Bag(self.rows.filter(wanted), self.columns)

    def side(self, count: str, keys: Sequence[str], prefix: str, suffix: str = "") -> DataFrame:
        """`count` copies of each row under the names of one side, with the key values."""
        named = [F.col(c).alias(prefix + c) for c in self.columns]
        return copies(self.rows.select(*named, *[F.col(k).alias(k + suffix) for k in keys], F.expr(count).alias("_n")), "_n")

    def met(self) -> DataFrame:
        both = [F.col(c).alias(p + c) for p in (PREFIX, "") for c in self.columns]
        flags = [F.lit(True).alias(f) for f in ("_in_src", "_in_tgt")]
        return copies(self.rows.select(*both, *flags, F.col("n_met").alias("_n")), "_n")


def copies(df: DataFrame, count: str) -> DataFrame:
    """Each row as often as `count` says. Rows with many copies are dealt to all tasks in portions."""
    n, at, columns = F.col(count), "_portion", [c for c in df.columns if c != count]
    one = F.lit(1).cast("bigint")
    few = df.filter(n.between(1, PORTION)).select(*columns, F.explode(F.sequence(one, n)).alias(at))
    portions = df.filter(n > PORTION).withColumn(at, F.explode(F.sequence(one, F.ceil(n / PORTION))))
    size = F.least(F.lit(PORTION).cast("bigint"), n - (F.col(at) - 1) * PORTION)
    dealt = portions.select(*columns, F.col(at), size.alias(count)).repartition(*columns[:1], at)
    many = dealt.select(*columns, F.explode(F.sequence(one, n)).alias(at))
    return few.unionAll(many).drop(at)


def _alike(src: DataFrame, tgt: DataFrame) -> bool:
    """Whether both sides have the same columns of the same plain types."""
    s = {f.name.removeprefix(PREFIX): f.dataType for f in src.schema}
    t = {f.name: f.dataType for f in tgt.schema}
    own = {"n_src", "n_tgt", "n_met", "_class", "_minus", "_n", "_portion"}
    plain = all(isinstance(d, T.AtomicType) and not isinstance(d, T.VariantType) for d in t.values())
    return s == t and plain and not own & set(t) and not any(c.startswith("_k") for c in t)


def _bag(src: DataFrame, tgt: DataFrame, named: list[tuple[str, Column, Column]], marks: DataFrame) -> Bag:
    """Both sides counted by whole rows: every row is moved once, and copies combine before that.
    The class of their keys is looked up for distinct rows."""
    names, one, none = tgt.columns, F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    s = src.select(*[F.col(PREFIX + c).alias(c) for c in names], one.alias("n_src"), none.alias("n_tgt"))
    both = s.unionAll(tgt.select("*", none.alias("n_src"), one.alias("n_tgt")))
    # grouping makes -0 a 0, so which columns have it is grouped by as well
    floats = [f.name for f in tgt.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    minus = [F.when((F.col(c) == 0) & F.col(c).cast("string").startswith("-"), F.lit(c)) for c in floats]
    both = both.withColumn("_minus", F.concat_ws(",", *minus) if minus else F.lit(""))
    counts = both.groupBy(*names, "_minus").agg(F.sum("n_src").alias("n_src"), F.sum("n_tgt").alias("n_tgt"))
    signed = {c: F.when(F.array_contains(F.split("_minus", ","), c), F.lit(-0.0).cast(tgt.schema[c].dataType)).otherwise(F.col(c)) for c in floats}
    values = {f"_k{i}": t for i, (_, _, t) in enumerate(named)} | {"n_met": F.least("n_src", "n_tgt")}
    rows = counts.withColumns(signed).drop("_minus").withColumns(values)
    k = [f"_k{i}" for i in range(len(named))]
    found = marks.select(*[F.col(c).alias(f"{c}_h") for c in k], "_class")
    classed = rows.join(found, null_safe([(F.col(c), F.col(f"{c}_h")) for c in k]), "left")
    return Bag(pin(classed.drop(*[f"{c}_h" for c in k]), "bag"), tuple(names))


@dataclass(frozen=True)
class Pairing:
    """`joined`: the pairs of all keys that at least one side has once at most, and rows without
    a partner. `many_src`, `many_tgt`: the rows of keys that both sides repeat, whose pairs
    would grow with the product of their rows. Counts take those pairs from value counts
    (`many_cells`); rows take them by occurrence (`rows`)."""

    joined: DataFrame
    keys: tuple[str, ...]
    how: str
    many_src: DataFrame | None = None
    many_tgt: DataFrame | None = None
    bag: Bag | None = None

    def rows(self, ignored: Sequence[str] = ()) -> DataFrame:
        """Every row of both sides, as many as the longer side has in each key.

        In a key that both sides repeat, rows that are equal in all common columns but the
        `ignored` ones meet first: the n-th copy of a row on one side and the n-th on the other.
        Of what is left, the n-th row of one side meets the n-th of the other, by the common
        columns; what one side has more of then is left without a partner. So a row that one
        side lacks leaves all others of its key in their pairs."""
        if self.many_src is None or self.many_tgt is None:
            return self.joined
        k = [f"_k{i}" for i in range(len(self.keys))]
        src_columns = [c for c in self.many_src.columns if c not in k]
        tgt_columns = [c for c in self.many_tgt.columns if c not in k]
        src, tgt = self.many_src.select(src_columns), self.many_tgt.select(tgt_columns)
        s_order, t_order = agreed_order(src, tgt)
        s_value, t_value = agreed_values(src, tgt, ignored)
        v = [f"_v{i}" for i in range(len(s_value))]
        many_src, many_tgt, equal = self.many_src, self.many_tgt, self.joined
        if self.bag is not None and not ignored:  # equal rows have met as counts; what is left goes on
            many_src, many_tgt = self.bag.side("n_src - n_met", k, PREFIX), self.bag.side("n_tgt - n_met", k, "")
            equal = equal.unionByName(self.bag.met().select(equal.columns))
        s = numbered(many_src.withColumns(dict(zip(v, s_value))), [*k, *v], s_order, "_k_n")
        t = numbered(many_tgt.withColumns(dict(zip(v, t_value))), [*k, *v], t_order, "_k_n")
        s = s.withColumn("_in_src", F.lit(True))
        t = t.withColumnsRenamed({c: c + "t" for c in [*k, *v, "_k_n"]}).withColumn("_in_tgt", F.lit(True))
        met = pin(_flagged(_joined(s, t, [*k, *v, "_k_n"], "full"), [*k, *[c + "t" for c in k], *src_columns, *tgt_columns]), "met")
        both = F.col("_in_src") & F.col("_in_tgt")
        s = numbered(met.filter(~F.col("_in_tgt")).select(*src_columns, *k), k, s_order, "_k_n")
        t = met.filter(~F.col("_in_src")).select(*tgt_columns, *[F.col(c + "t").alias(c) for c in k])
        t = numbered(t, k, t_order, "_k_n").withColumnsRenamed({c: c + "t" for c in [*k, "_k_n"]})
        rest = _joined(s.withColumn("_in_src", F.lit(True)), t.withColumn("_in_tgt", F.lit(True)), [*k, "_k_n"], self.how)
        columns = [*src_columns, *tgt_columns]
        return equal.unionByName(_flagged(met.filter(both), columns)).unionByName(_flagged(rest, columns))


def _flagged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns, *[F.coalesce(f, F.lit(False)).alias(f) for f in ("_in_src", "_in_tgt")])


def _joined(left: DataFrame, right: DataFrame, k: Sequence[str], how: str) -> DataFrame:
    """Keys `k` of the left side against those with `t` added of the right one.

    Always by sorted pieces: Spark takes the size of a staged table from its files, where millions
    of like rows are a few MB, and would send them all through the driver to broadcast them."""
    return _met(left, right, [(F.col(c), F.col(c + "t")) for c in k], how)


def _met(left: DataFrame, right: DataFrame, pairs: list[tuple[Column, Column]], how: str, unique: bool = False) -> DataFrame:
    """The join of `_joined` on any expressions. Keys that are unique on both sides are dealt
    evenly, so their full join needs no halves and moves each side once."""
    same = null_safe(pairs)
    if how != "full" or unique:
        return left.join(right.hint("merge"), same, how)
    # a full join can't be split by adaptive execution; its two halves can
    both = left.join(right.hint("merge"), same, "left")
    return both.unionByName(right.join(left.hint("merge"), same, "left_anti"), allowMissingColumns=True)


def pair_by_key(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    how: str = "full",
    unique: bool = False,
) -> Pairing:
    """Join on the keys, NULL-safe. `unique=True`: the keys are unique by construction.

    A key is treated by what it is, whatever its size. One aggregation counts the rows of both
    sides by key. Keys repeated on both sides are set apart. Keys repeated in the target alone
    are joined from the target's side, all others from the source's, so the side that may be
    skewed is the one that adaptive execution can split. Sides with the same columns are staged as
    counts of their distinct rows; of others only the rows of keys that the target repeats are."""
    named = key_columns(src, tgt, keys)
    columns = [*src.columns, *tgt.columns]
    if unique:  # joined on the expressions themselves: no second copy of the keys is moved
        s, t = src.withColumn("_in_src", F.lit(True)), tgt.withColumn("_in_tgt", F.lit(True))
        return Pairing(_flagged(_met(s, t, [(a, b) for _, a, b in named], how, unique=True), columns), tuple(keys), how)
    k = [f"_k{i}" for i in range(len(keys))]
    s = src.withColumns({c: e for c, (_, e, _) in zip(k, named)}).withColumn("_in_src", F.lit(True))
    t = tgt.withColumns({c + "t": e for c, (_, _, e) in zip(k, named)}).withColumn("_in_tgt", F.lit(True))
    marks = _repeated_keys(s, t, k)
    if marks.isEmpty():
        return Pairing(_flagged(_joined(s, t, k, how), columns), tuple(keys), how)

    def marked(df: DataFrame, suffix: str, kind: str) -> DataFrame:
        same = null_safe([(F.col(c + suffix), F.col(f"{c}_h")) for c in k])
        found = df.join(marks.select(*[F.col(c).alias(f"{c}_h") for c in k], "_class"), same, kind)
        return found.drop(*[f"{c}_h" for c in k])

    if _alike(src, tgt):
        bag = _bag(src, tgt, named, marks)

        def sides(name: str | None) -> tuple[DataFrame, DataFrame]:
            rows, flags = bag.of(name), (F.lit(True).alias("_in_src"), F.lit(True).alias("_in_tgt"))
            return rows.side("n_src", k, PREFIX).select("*", flags[0]), rows.side("n_tgt", k, "", "t").select("*", flags[1])

        rows = _flagged(_joined(*sides(None), k, how), columns)
        by_target = _flagged(_joined(*sides("target"), k, "right"), columns).filter(_wanted(how))
        many = bag.of("both")
        return Pairing(
            rows.unionByName(by_target), tuple(keys), how,
            many_src=many.side("n_src", k, PREFIX), many_tgt=many.side("n_tgt", k, ""), bag=many,
        )
    s_all, t_all = pin(marked(s, "", "inner"), "source"), pin(marked(t, "t", "inner"), "target")

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("_class") == name).drop("_class")

    rows = _flagged(_joined(marked(s, "", "left_anti"), marked(t, "t", "left_anti"), k, how), columns)
    by_target = _joined(part(s_all, "target"), part(t_all, "target"), k, "right")
    rows = rows.unionByName(_flagged(by_target, columns).filter(_wanted(how)))
    return Pairing(
        rows,
        tuple(keys),
        how,
        many_src=part(s_all, "both").select(*src.columns, *k),
        many_tgt=part(t_all, "both").select(*tgt.columns, *[F.col(c + "t").alias(c) for c in k]),
    )


def _wanted(how: str) -> Column:
    both = F.col("_in_src") & F.col("_in_tgt")
    return {"full": F.lit(True), "inner": both, "left": F.col("_in_src"), "right": F.col("_in_tgt")}[how]


def _repeated_keys(s: DataFrame, t: DataFrame, k: list[str]) -> DataFrame:
    """Keys that the target repeats, and whether the source does so too; as a table."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = s.select(*k, one.alias("_s"), none.alias("_t")).unionAll(
        t.select(*[F.col(c + "t").alias(c) for c in k], none.alias("_s"), one.alias("_t"))
    )
    counts = sides.groupBy(*k).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t")).filter("_t > 1")
    return pin(counts.select(*k, F.when(F.col("_s") > 1, "both").otherwise("target").alias("_class")), "repeated")


def agreed_order(src: DataFrame, tgt: DataFrame) -> tuple[list[Column], list[Column]]:
    """One order for both sides: by the common columns as the target has them, in a common type
    (text where they can't be compared as they are), with NULL text as ''; then by the side's
    other columns by name."""
    names = {c.removeprefix(PREFIX): c for c in src.columns}
    common = [c for c in tgt.columns if c in names]
    orders = agreed_values(src, tgt)
    orders[0].extend(F.col(c) for c in sorted(src.columns) if c.removeprefix(PREFIX) not in common)
    orders[1].extend(F.col(c) for c in sorted(tgt.columns) if c not in common)
    return orders


def agreed_values(src: DataFrame, tgt: DataFrame, ignored: Sequence[str] = ()) -> tuple[list[Column], list[Column]]:
    """The common columns of both sides but the `ignored` ones, in the form of `agreed_order`."""
    names = {c.removeprefix(PREFIX): c for c in src.columns}
    orders: tuple[list[Column], list[Column]] = ([], [])
    for name in [c for c in tgt.columns if c in names and c not in ignored]:
        s, t = F.col(names[name]), F.col(name)
        s_type, t_type = src.schema[names[name]].dataType, tgt.schema[name].dataType
        if is_text(s_type) or is_text(t_type) or not comparable(s_type, t_type):
            s, t = F.coalesce(s.cast("string"), F.lit("")), F.coalesce(t.cast("string"), F.lit(""))
        elif s_type != t_type:
            wide = common_type(src.sparkSession, s_type, t_type)
            s, t = s.cast(wide), t.cast(wide)
        orders[0].append(s)
        orders[1].append(t)
    return orders


def blank_text(df: DataFrame) -> DataFrame:
    """NULL text becomes '', so that both sort and group alike."""
    return df.select(
        [F.coalesce(c, F.lit("")).alias(c) if is_text(df.schema[c].dataType) else F.col(c) for c in df.columns]
    )


def occurrence_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    name: str = "rnm",
) -> DataFrame:
    """Numbers the rows inside each business key. The numbered rows are staged, so that every reader
    sees the same; only if a key has very many rows are they cut into pieces for it."""
    order = list(order) if order else df.columns
    if not keys or not whole_groups(df, keys):
        return numbered(df, keys, order, name)
    apart = [c for c in order if not isinstance(c, str) or c not in keys]  # a key is one value in its group
    own = W.partitionBy(*keys).orderBy(*(apart or keys))
    return pin(df.withColumn(name, F.row_number().over(own).cast("bigint")), "numbered")


def pair_by_important(
    src: DataFrame, tgt: DataFrame, important: Sequence[str], how: str = "full"
) -> Pairing:
    """Keyless: rows are numbered inside the important columns, ordered by the common ones."""
    s, t = blank_text(src), blank_text(tgt)
    s_order, t_order = agreed_order(s, t)
    named = key_columns(s, t, important)
    k = [f"_g{i}" for i in range(len(important))]
    # text has no NULL here, so a key of one type on both sides is its own group
    own = [s.schema[PREFIX + c].dataType == t.schema[c].dataType for c in important]
    s_group, t_group = ([p + c if o else g for c, g, o in zip(important, k, own)] for p in (PREFIX, ""))
    s = s.withColumns({g: e for g, o, (_, e, _) in zip(k, own, named) if not o})
    t = t.withColumns({g: e for g, o, (_, _, e) in zip(k, own, named) if not o})
    s, t = numbered(s, s_group, s_order, PREFIX + ROW_ID), numbered(t, t_group, t_order, ROW_ID)
    return pair_by_key(s.drop(*k), t.drop(*k), [*important, ROW_ID], how, unique=True)


def pair_by_ordinal(src: DataFrame, tgt: DataFrame, how: str = "full") -> Pairing:
    """Keyless: the n-th row of one side meets the n-th row of the other."""
    s, t = blank_text(src), blank_text(tgt)
    s_order, t_order = agreed_order(s, t)
    s, t = numbered(s, [], s_order, PREFIX + ROW_ID), numbered(t, [], t_order, ROW_ID)
    return pair_by_key(s, t, [ROW_ID], how, unique=True)


def bag_alignment(src: DataFrame, tgt: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keyless: equal rows are matched by count, without an order or a join.

    One row per distinct row, with `n_src`, `n_tgt`, `matched`, `src_only` and
    `tgt_only`. Copies combine before the shuffle."""
    names = list(columns or tgt.columns)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    s = blank_text(prefix_source(src).select([F.col(PREFIX + c).alias(c) for c in names]))
    t = blank_text(tgt.select(*names))
    both = s.select("*", one.alias("_s"), none.alias("_t")).unionByName(t.select("*", none.alias("_s"), one.alias("_t")))
    counts = both.groupBy(*names).agg(F.sum("_s").alias("n_src"), F.sum("_t").alias("n_tgt"))
    matched = F.least("n_src", "n_tgt")
    return counts.withColumns(
        {"matched": matched, "src_only": F.col("n_src") - matched, "tgt_only": F.col("n_tgt") - matched}
    )
