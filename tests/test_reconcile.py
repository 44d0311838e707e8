import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablecheck.functions.columns import prefix_source
from tablecheck.model import RESULT_SCHEMA, RunInfo, TableRules
from tablecheck.operators import align
from tablecheck.operators.align import bag_alignment, pair_by_key
from tablecheck.operators.compare import cell_rules, compare_cells, count_cells, long_cells, many_cells, unmatched_counts
from tablecheck.plans.reconcile import detail, reconcile, run_table, self_compare
from tablecheck.session import pin

RUN = RunInfo("20240131", "2024-02-01 08:30:00")
random.seed(5)


def make(n, keys):
    out = []
    for i in range(n):
        k = random.choice(keys)
        name = random.choice(["a", "b", "", None])
        amount = random.choice([None, 0.0, -0.0, 1.0, 1.00001, 5.0, -5.0, 5.0001])
        out.append((k, name, amount, Decimal(i % 3) if i % 4 else None))
    return out


SCHEMA = "k string, name string, amount double, d decimal(10,2)"
SRC = make(300, ["h"] * 6 + ["", None, "x", "y", "s1", "s2", "lone_s"]) + [("one", "a", 1.0, None)]
TGT = make(280, ["h"] * 6 + ["", None, "x", "y", "t1", "lone_t"]) + [("one", "b", 2.0, None)] * 90
TGT += [("only_t", None, None, None)] * 60
SRC += [("only_s", "", 0.0, None)] * 60
RULES = TableRules("t", pk_col=("k",), threshold_col=("amount",), threshold_val_perc=0.01, non_nullable_col=("k",))


def expected(src, tgt, how, percent=0.01):
    """Counters by making every pair."""
    blank = lambda v: "" if v is None else v
    pairs = [(s, t) for s in src for t in tgt if blank(s[0]) == blank(t[0])]
    t_keys, s_keys = {blank(t[0]) for t in tgt}, {blank(s[0]) for s in src}
    none = (None,) * 4
    if how in ("full", "left"):
        pairs += [(s, none) for s in src if blank(s[0]) not in t_keys]
    if how in ("full", "right"):
        pairs += [(none, t) for t in tgt if blank(t[0]) not in s_keys]
    out = {}
    for i, name in enumerate(("k", "name", "amount", "d")):
        if name == "amount":
            near = lambda s, t: (
                abs(s or 0) * (1 - percent / 100) <= abs(t or 0) <= abs(s or 0) * (1 + percent / 100)
            )
            good = sum(near(s[i], t[i]) for s, t in pairs)
        elif name == "d":
            good = sum(s[i] == t[i] for s, t in pairs)
        else:
            good = sum(blank(s[i]) == blank(t[i]) for s, t in pairs)
        out[name] = (good, len(pairs) - good, sum(t[i] is None for _, t in pairs))
    return out


@pytest.mark.parametrize("how", ["full", "inner", "left", "right"])
def test_counts_equal_all_pairs(spark, how):
    src, tgt = spark.createDataFrame(SRC, SCHEMA), spark.createDataFrame(TGT, SCHEMA)
    s = prefix_source(src)
    paired = pair_by_key(s, tgt, ["k"], how)
    assert paired.many_src is not None
    _, cells = cell_rules(s, tgt, RULES)
    got = {r[0]: tuple(int(x) for x in r[1:]) for r in count_cells(paired, cells).collect()}
    assert got == expected(SRC, TGT, how)


def test_repeated_keys_make_no_pairs(spark):
    s, tgt = prefix_source(spark.createDataFrame(SRC, SCHEMA)), spark.createDataFrame(TGT, SCHEMA)
    paired = pair_by_key(s, tgt, ["k"])
    assert paired.joined.count() < len(SRC) + len(TGT)
    _, cells = cell_rules(s, tgt, RULES)
    counted = many_cells(paired, cells)
    totals = counted.filter("column_name = 'k' and key_k = 'h'").agg(F.sum("n_src"), F.sum("n_tgt")).first()
    assert tuple(totals) == (sum(r[0] == "h" for r in SRC), sum(r[0] == "h" for r in TGT))


def test_counts_of_repeated_keys_read_distinct_rows_only(spark):
    """Sides with the same columns are staged as counts, and no copies are made from them to be counted."""
    s, tgt = prefix_source(spark.createDataFrame(SRC, SCHEMA)), spark.createDataFrame(TGT, SCHEMA)
    paired = pair_by_key(s, tgt, ["k"])
    made = F.coalesce(F.raise_error(F.lit("copies were made")).cast("boolean"), F.lit(True))
    paired = replace(paired, many_src=paired.many_src.filter(made), many_tgt=paired.many_tgt.filter(made))
    _, cells = cell_rules(s, tgt, RULES)
    got = {r[0]: tuple(int(x) for x in r[1:]) for r in count_cells(paired, cells).collect()}
    assert got == expected(SRC, TGT, "full")
    assert unmatched_counts(paired).first().src_only >= 60


@pytest.mark.parametrize("n", [2, 100, 101, 200])
def test_detail_has_every_row_of_a_repeated_key(spark, n):
    """One rule at every size: by occurrence, the surplus without a partner."""
    src = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    tgt = spark.range(n + 3).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    rows = detail(src, tgt, TableRules("t", pk_col=("k",)))
    got = {r.row_status: r["count"] for r in rows.groupBy("row_status").count().collect()}
    assert got == {"matched": n, "tgt_only": 3}
    assert rows.filter("row_status = 'matched' and status_v = 'FAIL'").count() == 0


def test_many_repeated_keys_stay_linear(spark):
    df = spark.range(36_000).select((F.col("id") % 12_000).alias("k"), F.col("id").alias("v"))
    rows = detail(df, df, TableRules("t", pk_col=("k",)))
    assert rows.count() == 36_000
    assert rows.filter("status_v = 'FAIL' or row_status != 'matched'").count() == 0


def test_bag_with_a_target_only_column_fails(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tgt = src.withColumn("extra", F.lit("x"))
    got = {r.column_name: (r.overall_Status, int(r.fail_count)) for r in reconcile(src, tgt, TableRules("t"), RUN).collect()}
    assert got == {"k": ("PASS", 0), "v": ("PASS", 0), "extra": ("FAIL", 2)}


def test_bag_compares_by_value(spark):
    src = spark.createDataFrame([("1", 1.0), ("x1", 2.0), (None, -0.0)], "k string, v double")
    tgt = spark.createDataFrame([(1, 1), (7, 2), (None, 0)], "k int, v int")
    got = {r.column_name: (int(r.pass_count), int(r.fail_count)) for r in reconcile(src, tgt, TableRules("t"), RUN).collect()}
    assert got == {"k": (2, 2), "v": (2, 2)}


def test_bag_refuses_what_it_cannot_do(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    with pytest.raises(ValueError, match="tolerance"):
        reconcile(df, df, TableRules("t", threshold_col=("v",)), RUN)
    with pytest.raises(ValueError, match="how"):
        reconcile(df, df, TableRules("t"), RUN, how="left")


@pytest.mark.parametrize("align", ["ordinal", "important"])
def test_keyless_order_ignores_column_order_and_type(spark, align):
    src = spark.createDataFrame([(str(i), i % 3) for i in range(1, 21)], "a string, b int")
    tgt = spark.createDataFrame([(i % 3, i) for i in range(1, 21)], "b int, a int")
    rows = reconcile(src, tgt, TableRules("t", important_col=("B",)), RUN, align=align).collect()
    assert {r.overall_Status for r in rows} == {"PASS"}


def test_rule_names_may_be_in_capitals(spark):
    df = spark.createDataFrame([(1, "a")], "K int, V string")
    assert {r.overall_Status for r in reconcile(df, df, TableRules("t", pk_col=("K",)), RUN).collect()} == {"PASS"}


def test_signed_tolerance_and_text_mode(spark):
    src = spark.createDataFrame([(1, -5.0, 1.5), (2, None, 2.0)], "k int, amount double, d double")
    tgt = spark.createDataFrame([(1, 5.0, 1.5), (2, 0.0, 2.0)], "k int, amount double, d double")
    tgt = tgt.withColumn("d", F.col("d").cast("decimal(30,6)"))
    rules = TableRules("t", pk_col=("k",), threshold_col=("amount",))
    status = lambda **kw: {r.column_name: r.overall_Status for r in reconcile(src, tgt, rules, RUN, **kw).collect()}
    assert status() == {"k": "PASS", "amount": "PASS", "d": "PASS"}
    assert status(signed=True)["amount"] == "FAIL"
    assert status(compare="text")["d"] == "FAIL"


def test_status_ladder(spark):
    schema = "k int, v string"
    one = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    rules = TableRules("t", pk_col=("k",), non_nullable_col=("v",))
    status = lambda s, t: {r.column_name: r.overall_Status for r in reconcile(s, t, rules, RUN).collect()}
    assert status(one, one) == {"k": "PASS", "v": "PASS"}
    assert status(one, one.limit(1))["k"] == "FAIL(Count Check)"
    assert status(one, spark.createDataFrame([(1, "a"), (2, None)], schema))["v"] == "FAIL(Null Check)"
    assert status(one, spark.createDataFrame([(1, "a"), (3, "b")], schema))["k"] == "FAIL(Duplicate Check)"
    assert status(one, spark.createDataFrame([(1, "a"), (2, "c")], schema)) == {"k": "PASS", "v": "FAIL"}


def test_empty_tables_have_no_percentages(spark):
    empty = spark.createDataFrame([], "k int, v string")
    rows = self_compare(empty, TableRules("t", pk_col=("k",)), RUN).collect()
    assert {r.overall_Status for r in rows} == {"PASS"}
    assert {r.src_pass_percentage for r in rows} == {None}


def test_absent_target_column_fails(spark):
    src = spark.createDataFrame([(1, "a")], "k int, old string")
    tgt = spark.createDataFrame([(1, "b")], "k int, new string")
    rows = {r.column_name: r.overall_Status for r in reconcile(src, tgt, TableRules("t", pk_col=("k",)), RUN).collect()}
    assert rows == {"k": "PASS", "new": "FAIL"}


def test_detail_order_and_row_status(spark):
    src = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "K int, V string, Extra int")
    tgt = spark.createDataFrame([(1, "a", "z"), (3, None, "z")], "k int, v string, skip string")
    wide = detail(src, tgt, TableRules("t", pk_col=("k",), ignore_col=("skip",)))
    assert wide.columns == [
        "k", "qa_k", "status_k", "k_null", "v", "qa_v", "status_v", "v_null", "skip", "qa_extra", "row_status",
    ]
    got = {(r.qa_k, r.k): (r.status_v, r.v_null, r.row_status) for r in wide.collect()}
    assert got == {(1, 1): ("PASS", 0, "matched"), (2, None): ("FAIL", 1, "src_only"), (None, 3): ("PASS", 1, "tgt_only")}


def test_long_cells(spark):
    s = prefix_source(spark.createDataFrame([(1, "a")], "k int, v string"))
    t = spark.createDataFrame([(1, "b")], "k int, v string")
    _, rules = cell_rules(s, t, TableRules("t", pk_col=("k",)))
    got = {tuple(r) for r in long_cells(pair_by_key(s, t, ["k"]), rules).collect()}
    assert got == {("1", "k", "1", "1", "PASS"), ("1", "v", "a", "b", "FAIL")}


@pytest.mark.parametrize("seed", [1, 2])
def test_bag_is_independent_of_order(spark, seed):
    src = spark.createDataFrame(SRC, SCHEMA).orderBy(F.rand(seed))
    tgt = spark.createDataFrame(TGT, SCHEMA).orderBy(F.rand(seed + 7))
    sums = bag_alignment(src, tgt).agg(F.sum("matched"), F.sum("src_only"), F.sum("tgt_only")).first()
    key = lambda r: (r[0] or "", r[1] or "", None if r[2] is None else r[2] + 0.0, r[3])
    from collections import Counter

    a, b = Counter(map(key, SRC)), Counter(map(key, TGT))
    assert tuple(sums) == (sum((a & b).values()), sum((a - b).values()), sum((b - a).values()))


@pytest.mark.parametrize("align", ["important", "ordinal", "bag"])
def test_keyless_identity_passes(spark, cut_often, align):
    df = spark.createDataFrame(SRC, SCHEMA)
    rows = self_compare(df, TableRules("t", important_col=("k",)), RUN, align=align).collect()
    assert {r.overall_Status for r in rows} == {"PASS"}
    assert {int(r.pass_count) for r in rows} == {len(SRC)}


def test_changing_cells_changes_the_count_by_as_many(spark):
    base = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    changed = base.withColumn("v", F.when(F.col("k") % 50 == 0, -1).otherwise(F.col("v")))
    rows = {r.column_name: r for r in reconcile(base, changed, TableRules("t", pk_col=("k",)), RUN).collect()}
    assert (rows["v"].fail_count, rows["v"].pass_count, rows["k"].fail_count) == (10, 490, 0)


def test_run_table_schema(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    out = run_table(df, df, RULES.__class__("t", pk_col=("k",), non_nullable_col=("v",)), RUN)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in RESULT_SCHEMA]
    assert sorted(r.type for r in out.collect()) == ["Count", "Duplicate", "Null", "Regression", "Regression"]


def test_one_missing_row_of_a_key_leaves_the_others_paired(spark, cut_often):
    """Six rows of one key, the third missing on the other side; a copy too many of another key."""
    rows = [("k", i, f"v{i}") for i in range(6)] + [("c", 1, "same")] * 4 + [("c", 2, "odd")] * 2
    src = spark.createDataFrame(rows, "k string, a int, b string")
    tgt = src.filter("a != 2 OR k = 'c'").unionAll(spark.createDataFrame([("c", 1, "same")], src.schema))
    rules = TableRules("t", pk_col=("k",))
    got = detail(src, tgt, rules).collect()
    assert sorted(r.row_status for r in got) == ["matched"] * 11 + ["src_only", "tgt_only"]
    alone = [(r.qa_k, r.qa_a, r.k, r.a) for r in got if r.row_status != "matched"]
    assert sorted(map(str, alone)) == sorted(map(str, [("k", 2, None, None), (None, None, "c", 1)]))
    assert {(r.status_a, r.status_b) for r in got if r.row_status == "matched"} == {("PASS", "PASS")}
    counts = unmatched_counts(pair_by_key(prefix_source(src), tgt, ["k"])).first()
    assert tuple(counts) == (1, 1, 0)


def test_changed_rows_meet_after_the_equal_ones(spark):
    src = spark.createDataFrame([("k", 1, 10), ("k", 2, 20), ("k", 3, 30)], "k string, a int, x int")
    tgt = spark.createDataFrame([("k", 1, 99), ("k", 3, 77), ("k", 9, 20)], src.schema)
    got = detail(src, tgt, TableRules("t", pk_col=("k",), ignore_col=("x",))).collect()
    assert sorted((r.qa_a, r.a, r.status_a) for r in got) == [(1, 1, "PASS"), (2, 9, "FAIL"), (3, 3, "PASS")]


@pytest.mark.parametrize("how", ["full", "left", "right", "inner"])
def test_unmatched_agrees_with_the_rows(spark, cut_often, how):
    draw = random.Random(4)
    side = lambda n: spark.createDataFrame([(draw.choice(["a", "b", "", None, "c", "d"]), draw.randint(0, 3)) for _ in range(n)], "k string, v int")
    paired = pair_by_key(prefix_source(side(60)), side(45), ["k"], how)
    rows = paired.rows().collect()
    alone = [r for r in rows if not (r["_in_src"] and r["_in_tgt"])]
    expected = (sum(r["_in_src"] for r in alone), sum(r["_in_tgt"] for r in alone), sum(not (r["k"] or r["qa_k"]) for r in alone))
    assert tuple(unmatched_counts(paired).first()) == expected


def test_tolerance_of_many_columns_is_one_sort(spark, cut_often):
    """Pairs within a tolerance, counted for several columns at once, against a loop."""
    draw = random.Random(9)
    make = lambda n: [(draw.choice("ab"), draw.choice([None, 0.0, 10.0, 10.1, -10.0, 11.0]), draw.choice([5.0, 5.05, 6.0])) for _ in range(n)]
    src, tgt = make(40), make(50)
    schema = "k string, x double, y double"
    rules = TableRules("t", pk_col=("k",), threshold_col=("x", "y"), threshold_val_perc=2.0)
    rows = reconcile(spark.createDataFrame(src, schema), spark.createDataFrame(tgt, schema), rules, RUN).collect()
    for at, name in ((1, "x"), (2, "y")):
        pairs = [(abs(s[at] or 0), abs(t[at] or 0)) for s in src for t in tgt if s[0] == t[0]]
        good = sum(s * 0.98 <= t <= s * 1.02 for s, t in pairs)
        row = next(r for r in rows if r.column_name == name)
        assert (row.pass_count, row.fail_count) == (good, len(pairs) - good)


def test_staged_sides_are_not_broadcast(spark):
    """Millions of like rows are a few MB of files; their keys must not go through the driver."""
    src = pin(spark.range(100).selectExpr("id as qa_id", "'x' as qa_v"))
    tgt = pin(spark.range(50, 150).selectExpr("id", "'x' as v"))
    joined = pair_by_key(src, tgt, ["id"], unique=True).joined
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 150


def test_unique_sides_are_moved_once(spark):
    """A full join of unique keys is one join, and its keys do not go along twice."""
    src = pin(spark.range(100).selectExpr("cast(id as string) as qa_id", "'x' as qa_v"))
    tgt = pin(spark.range(50, 150).selectExpr("cast(id as string) as id", "'x' as v"))
    joined = pair_by_key(src, tgt, ["id"], unique=True).joined
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1
    assert "_k0" not in plan
    assert joined.groupBy("_in_src", "_in_tgt").count().orderBy("count").collect()[0]["count"] == 50


def test_equal_rows_of_repeated_keys_meet_as_counts(spark, cut_often, monkeypatch):
    """Rows of repeated keys are moved once, as counts; copies, -0, NULL and '' stay as they were."""
    monkeypatch.setattr(align, "PORTION", 3)
    schema = "k int, v string, x double"
    src = spark.createDataFrame([(1, "a", -0.0)] * 8 + [(1, None, 1.0), (1, "b", 2.0), (2, "c", 0.0), (None, "n", 1.0)], schema)
    tgt = spark.createDataFrame([(1, "a", -0.0)] * 7 + [(1, "", 1.0), (1, "d", 3.0), (2, "c", -0.0), (2, "e", 1.0)], schema)
    paired = pair_by_key(prefix_source(src), tgt, ["k"])
    assert paired.bag is not None and paired.bag.rows.count() == 5
    got = sorted(str((r.qa_k, r.qa_v, str(r.qa_x), r.k, r.v, str(r.x))) for r in paired.rows().collect())
    expect = [(1, "a", "-0.0", 1, "a", "-0.0")] * 7 + [(1, None, "1.0", 1, "", "1.0"), (1, "a", "-0.0", 1, "d", "3.0")]
    expect += [(1, "b", "2.0", None, None, "None"), (2, "c", "0.0", 2, "c", "-0.0"), (2, "c", "0.0", 2, "e", "1.0")]
    expect += [(None, "n", "1.0", None, None, "None")]
    assert got == sorted(map(str, expect))
    assert paired.many_src.count() == 10 and paired.many_tgt.count() == 9
