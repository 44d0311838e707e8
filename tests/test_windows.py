import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pyspark.sql import Window as W

from tablecheck.operators import windows
from tablecheck.operators.align import occurrence_number
from tablecheck.operators.windows import border_carry, capped_running_balance, edge_rows, numbered, ordered_pieces, running_total

# A third of the rows in one group, a third of those copies of one row.
random.seed(3)
ROWS = [("hot", random.randint(0, 40), random.randint(-9, 9)) for _ in range(400)]
ROWS += [("hot", 7, 7)] * 200
ROWS += [(f"g{i % 50}", random.randint(0, 40), random.randint(-9, 9)) for i in range(1200)]
ROWS += [(None, i, -i) for i in range(20)]


def sort_key(row):
    return tuple((v is not None, v) for v in row)


@pytest.fixture
def rows(spark, cut_often):
    return spark.createDataFrame(ROWS, "g string, a int, b int").repartition(5)


def test_pieces_follow_the_order(rows):
    pieces = ordered_pieces(rows, [], ["g", "a", "b"]).collect()
    ordered = sorted(pieces, key=lambda r: (r["_piece"], r["_pos"]))
    values = [(r["g"], r["a"], r["b"]) for r in ordered]
    assert values == sorted(ROWS, key=sort_key)
    assert len({r["_piece"] for r in pieces}) > 1


def test_copies_are_cut(spark, cut_often):
    same = spark.createDataFrame([("x", 1)] * 1000, "g string, a int").repartition(4)
    sizes = ordered_pieces(same, ["g"], ["a"]).groupBy("_piece").count().collect()
    assert len(sizes) > 1
    assert sum(r["count"] for r in sizes) == 1000


def test_ordinal_equals_global_row_number(rows):
    numbers = numbered(rows, [], rows.columns)
    assert "SinglePartition" not in numbers._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    got = numbers.collect()
    assert sorted(r["row_id"] for r in got) == list(range(1, len(ROWS) + 1))
    by_id = sorted(got, key=lambda r: r["row_id"])
    assert [(r["g"], r["a"], r["b"]) for r in by_id] == sorted(ROWS, key=sort_key)


def test_number_inside_groups(rows):
    got = numbered(rows, ["g"], ["a", "b"], "n").collect()
    groups = defaultdict(list)
    for r in got:
        groups[r["g"]].append((r["n"], r["a"], r["b"]))
    assert len(got) == len(ROWS)
    for name, found in groups.items():
        found.sort()
        assert [n for n, *_ in found] == list(range(1, len(found) + 1))
        assert [(a, b) for _, a, b in found] == sorted((a, b) for g, a, b in ROWS if g == name)


def test_running_total(rows):
    distinct = rows.withColumn("id", F.monotonically_increasing_id())
    got = running_total(distinct, ["g"], ["a", "id"], "b", "run").collect()
    totals = defaultdict(int)
    for r in sorted(got, key=lambda r: (sort_key((r["g"],)), r["a"], r["id"])):
        totals[r["g"]] += r["b"]
        assert r["run"] == totals[r["g"]]


def test_capped_balance_equals_a_loop(spark, cut_often):
    data = [(g, i, b) for i, (g, _, b) in enumerate(ROWS)]
    df = spark.createDataFrame(data, "g string, i int, b int").repartition(5)
    got = capped_running_balance(df, ["g"], ["i"], F.col("b"), "bal", "prev", "n").collect()
    expect, state, count = {}, defaultdict(int), defaultdict(int)
    for g, i, b in data:
        before = state[g]
        state[g] = min(0, before + b)
        count[g] += 1
        expect[i] = (state[g], before, count[g])
    assert {r["i"]: (r["bal"], r["prev"], r["n"]) for r in got} == expect


def test_carry_is_bounded_by_the_pieces(rows):
    """However many groups there are, a piece has one border."""
    pieces = ordered_pieces(rows, ["g"], ["a", "b"])
    local = pieces.withColumn("n", F.row_number().over(W.partitionBy("_piece", "g").orderBy("_pos")))
    events = border_carry(local, ["g"], "_piece", "_pos", {"rows": F.col("n")})
    count = pieces.select("_piece").distinct().count()
    assert events.count() == 2 * count > 2
    assert events.filter("_end = 0 AND _pieces > 0").count() < count


def test_nothing_is_counted_while_planning(spark, rows):
    """Numbering in groups runs no job but those that write the sorted pieces."""

    def jobs(name, plan):
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", name)
        plan()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    pieces = jobs("pieces", lambda: ordered_pieces(rows, ["g"], ["a", "b"]))
    assert jobs("numbered", lambda: numbered(rows, ["g"], ["a", "b"])) == pieces


def test_names_that_a_table_has_already(spark, cut_often):
    data = [("x", k % 5, k, k, k, "t") for k in range(200)]
    odd = spark.createDataFrame(data, "_piece string, _pos int, _tie int, _hash int, _number int, _run string").repartition(3)
    got = numbered(odd, ["_piece"], ["_tie"], "n").collect()
    assert sorted((r["n"], r["_tie"]) for r in got) == [(k + 1, k) for k in range(200)]
    assert got[0].__fields__ == [*odd.columns, "n"]
    run = running_total(odd, ["_pos"], ["_tie"], "_number", "total").collect()
    assert all(r["total"] == sum(x for x in range(r["_tie"] + 1) if x % 5 == r["_pos"]) for r in run)
    balance = capped_running_balance(odd, ["_run"], ["_tie"], -F.col("_hash"), number="n").collect()
    assert all(r["short_balance"] == -sum(range(r["_tie"] + 1)) for r in balance)


def test_carries_come_from_border_rows_only(spark, cut_often):
    """Of a table with small groups only the ends of its pieces are windowed for the carries."""
    small = spark.range(4000).selectExpr("id div 4 as g", "id as a").repartition(5)
    pieces = ordered_pieces(small, ["g"], ["a"])
    count = pieces.select("_piece").distinct().count()
    assert 1 < count < edge_rows(pieces, ["g"], "_piece", "_pos").count() <= 5 * count
    assert numbered(small, ["g"], ["a"], "n").filter("n <> a % 4 + 1").count() == 0


def test_like_rows_go_through_the_shuffle_together(spark, monkeypatch):
    """Rows are sorted by (group, order) before they are dealt by range, not put in the order of a hash."""
    monkeypatch.setattr(windows, "pin", lambda df, name="": df)
    laid = windows.ordered_pieces(spark.range(10).selectExpr("id % 2 as g", "id as a"), ["g"], ["a"])
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    before = plan.split("RepartitionByExpression")[1].split("Sort [")[1]
    assert before.startswith("g#") and "a#" in before.split("]")[0]


@pytest.mark.parametrize("whole", [1_000_000, 100])
def test_groups_are_numbered_whole_or_in_pieces(rows, monkeypatch, whole):
    """Groups below the bound need no staged pieces; those above it are cut, also if a key is NULL."""
    monkeypatch.setattr(windows, "WHOLE_GROUP_ROWS", whole)
    staged = []
    pin = windows.pin
    monkeypatch.setattr(windows, "pin", lambda df, name: staged.append(name) or pin(df, name))
    odd = rows.withColumn("h", F.when(F.col("a") % 2 == 0, F.col("g"))).unionAll(
        rows.limit(150).select(F.lit(None).alias("g"), F.monotonically_increasing_id().alias("a"), "b", F.lit(None).alias("h")))
    order = ["a", "b"]
    got = windows.numbered_groups(odd, ["g", "h"], order, "n")
    plain = odd.withColumn("n", F.row_number().over(W.partitionBy("g", "h").orderBy(*order)).cast("bigint"))
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    assert staged == ([] if whole > 1000 else ["large-groups", "pieces"])
    assert windows.numbered_groups(rows.limit(0), ["g"], order).collect() == []


def test_whole_groups_have_the_balance_of_pieces(spark, cut_often, monkeypatch):
    rows = spark.createDataFrame([(g, i, b) for i, (g, _, b) in enumerate(ROWS)], "g string, i int, b int").repartition(5)
    cut = capped_running_balance(rows, ["g"], ["i"], F.col("b"), "bal", "prev", "n")
    monkeypatch.setattr(windows, "ordered_pieces", lambda *_: pytest.fail("cut into pieces"))
    beside = {"top": F.max("b").over(W.partitionBy("g").orderBy("i").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))}
    got = capped_running_balance(rows, ["g"], ["i"], F.col("b"), "bal", "prev", "n", whole=True, beside=beside)
    assert sorted(map(str, got.drop("top").collect())) == sorted(map(str, cut.collect()))
    assert got.drop("top").dtypes == cut.dtypes
    assert {r.g: r.top for r in got.collect()} == {g: max(b for h, _, b in ROWS if h == g) for g in {r[0] for r in ROWS}}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 2


@pytest.mark.parametrize("limit, fits", [(599, False), (600, True)])
def test_whole_groups_are_found_by_shares(spark, rows, monkeypatch, limit, fits):
    monkeypatch.setattr(windows, "WHOLE_GROUP_ROWS", limit)
    monkeypatch.setattr(windows, "SHARES", 2)  # shares are larger than any group
    assert windows.whole_groups(rows, ["g"]) is fits
    assert windows.whole_groups(rows.limit(0), ["g"])


@pytest.mark.parametrize("keys, order", [([], ["g", "a", "b"]), (["g"], ["g"]), (["g"], [F.desc]), (["g", "a"], None)])
def test_occurrences_of_any_key_and_order(spark, rows, keys, order):
    order = [f("a") if callable(f) else f for f in order] if order else None
    got = occurrence_number(rows, keys, order, "n").collect()
    groups = defaultdict(list)
    for r in got:
        groups[tuple(r[k] for k in keys)].append(r)
    assert all(sorted(r.n for r in found) == list(range(1, len(found) + 1)) for found in groups.values())
    assert sorted(map(str, ((r.g, r.a, r.b) for r in got))) == sorted(map(str, ROWS))
    if order and not isinstance(order[0], str):
        assert all([r.a for r in sorted(found, key=lambda r: r.n)] == sorted((r.a for r in found), reverse=True) for found in groups.values())
