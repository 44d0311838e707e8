import pytest
from pyspark.sql import functions as F

from tablecheck.functions.options import contract_date, option_symbol, option_type
from tablecheck.model import RunInfo
from tablecheck.operators import windows
from tablecheck.plans import extracts as E
from tablecheck.plans import netting as N

DATE = "2024-01-31"
SCHEMA = (
    "bor_client_id string, option_name string, underlying string, underlying_symbol string, underlying_sec_name string, "
    "option_maturitydate string, short_or_long string, strikepriceamount int, option_tradeqty int, process_date string, run_date string"
)


def position(client="c1", name="CALL 100 ABC'24 @20", symbol="ABC", sec="ABC CORP", day="2024-06-01", strike=20, qty=1, process=DATE):
    side = "Long" if qty > 0 else "Short"
    return (client, name, "U1", symbol, sec, day, side, strike, qty, process, "2024-02-01")


def stages(spark, rows, **options):
    return N.Stages(spark.createDataFrame(rows, SCHEMA), DATE, **options)


def test_option_fields(spark):
    names = [("CALL 100 ABC'24 @20",), ("PUT  5 X Y$7",), ("CALL ABC",), ("PUT|A|B",)]
    rows = spark.createDataFrame(names, "n string").select(option_symbol(F.col("n")), option_type(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [("ABC", "CALL"), ("X Y", "PUT"), (None, "CALL"), ("A", "PUT|")]
    assert spark.range(1).select(contract_date(F.lit("2024-06-01"))).first()[0] == "06012024"


def test_enrich_fallbacks(spark):
    rows = [position(symbol=None, sec=None), position(symbol="", sec="")]
    got = stages(spark, rows).enriched.collect()
    assert [(r.underlying_symbol, r.underlying_sec_name) for r in got] == [
        ("ABC", "CALL 100 ABC'24 @20"), ("", "CALL 100 ABC'24 @20"),
    ]


def test_zero_totals_other_dates_and_lone_sides_drop_out(spark):
    rows = [position(qty=2), position(qty=-2, strike=30), position(client="c2", qty=5), position(qty=9, process="2023-01-01")]
    rows += [position(client="c3", qty=1, strike=5), position(client="c3", qty=-3)]
    st = stages(spark, rows)
    assert {r.bor_client_id for r in st.sided.collect()} == {"c1", "c3"}
    got = {(r.bor_client_id, int(r.occ_qty_reported), float(r.occ_strkprice_report)) for r in st.report.collect()}
    assert got == {("c1", 2, 20.0), ("c3", 1, 5.0)}


def test_exact_offset_and_allocation(spark):
    """Long 3 and 4 against short 5 of the first maturity: the balance runs -2, then
    is used up."""
    rows = [position(qty=3), position(qty=-5), position(qty=4, day="2024-07-01")]
    st = stages(spark, rows)
    seq = sorted((r.long_option_maturitydate, int(r.short_balance), int(r.short_balance_prev), r.row_seqno) for r in st.sequenced.collect())
    assert seq == [("2024-06-01", -2, 0, 1), ("2024-07-01", 0, -2, 2)]
    got = {(r.expiry_maturity_date, int(r.occ_qty_reported)) for r in st.report.collect()}
    assert got == {("2024-06-01", 3), ("2024-07-01", 2)}


def test_positive_rest_with_a_balance_reports_only_the_balance(spark):
    """A row that has a short quantity and a balance before it reports the balance."""
    rows = [position(qty=-2, day="2024-05-01"), position(qty=5), position(qty=-1)]
    got = {(r.expiry_maturity_date, int(r.occ_qty_reported)) for r in stages(spark, rows).report.collect()}
    assert got == {("2024-06-01", 2)}


TWO_NAMES = [position(qty=10), position(qty=-3, sec="B"), position(qty=-4, sec="C")]


def test_two_short_names_pair_the_long_row_twice(spark):
    attached = stages(spark, TWO_NAMES).attached.collect()
    assert sorted((r.underlying_sec_name, int(r.short_quantity), int(r.long_quantity)) for r in attached) == [("B", -3, 10), ("C", -4, 10)]
    once = stages(spark, TWO_NAMES, by_name=False).attached.collect()
    assert [(r.underlying_sec_name, int(r.short_quantity), int(r.long_quantity)) for r in once] == [("B", -7, 10)]


def test_null_client_is_matched(spark):
    rows = [position(client=None, qty=3), position(client=None, qty=-3)]
    got = stages(spark, rows).report.collect()
    assert [(r.bor_client_id, int(r.occ_qty_reported)) for r in got] == [(None, 3)]


def many(n=600):
    rows = []
    for i in range(n):
        qty = (i % 7 + 1) * (1 if i % 3 else -1)
        client = "hot" if i % 2 else f"c{i % 5}"
        rows.append(position(client=client, qty=qty, day=f"2024-{i % 12 + 1:02d}-01", strike=10 * (i % 4 + 1), sec=f"N{i % 17}"))
    return rows


@pytest.mark.parametrize("policy", ["ordered", "ordered_alterix", "unordered"])
def test_hot_groups_give_the_same_sequence(spark, cut_often, policy):
    columns = [*N.ATTACHED[:-1], "row_seqno", "short_balance", "short_balance_prev"]
    cut = stages(spark, many(), policy=policy).sequenced.select(*columns).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    whole = stages(spark, many(), policy=policy).sequenced.select(*columns).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(str, whole)) == sorted(map(str, cut))
    assert len(whole) > 50


def test_report_reconciles_with_itself(spark):
    report = stages(spark, many()).report
    rows = N.reconcile_report(report, report, RunInfo("20240131")).collect()
    assert {r.overall_Status for r in rows} == {"PASS"}
    assert {r.type for r in rows} == {"Regression", "Count", "Null", "Duplicate"}


def test_more_than_one_run_date_is_an_error(spark):
    odd = (*position(qty=-1)[:-1], "2024-02-02")
    with pytest.raises(Exception, match="run_date has more than one value"):
        stages(spark, [position(qty=1), odd]).report.collect()


def test_sides_meet_in_one_join(spark):
    """Short rows, lone carriers and the rest, blank names and no symbol included, from one join."""
    rows = [position(qty=3), position(qty=4, strike=30), position(qty=-5), position(qty=-1, sec="B")]
    rows += [position(qty=2, day="2024-07-01", symbol=None), position(qty=1, day=None), position(qty=-9, day=None)]
    rows += [position(qty=7, day="2024-09-01"), position(qty=8, day="2024-09-01", sec="Z"), position(qty=-2, day="2024-10-01")]
    st = stages(spark, rows)
    got = [
        (r.long_option_maturitydate, r.short_quantity, r.long_quantity, r.source, r.underlying_sec_name)
        for r in st.attached.collect()
    ]
    assert sorted(map(str, [(d, None if s is None else int(s), int(q), *rest) for d, s, q, *rest in got])) == sorted(
        map(
            str,
            [
                ("2024-06-01", -5, 3, "step4", "ABC CORP"),
                ("2024-06-01", -1, 3, "step4", "B"),
                ("2024-06-01", None, 4, "step3.1", "ABC CORP"),
                ("2024-07-01", 0, 2, "step4", None),
                (None, -9, 1, "step4", "ABC CORP"),
                ("2024-09-01", 0, 7, "step4", None),
                ("2024-09-01", None, 8, "step3.1", "Z"),
                ("2024-10-01", -2, 0, "step4", "ABC CORP"),
            ],
        )
    )
    assert st.paired.count() == 6
    assert st.attached._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_long_rows_are_staged_without_short_ones_or_pieces(spark, monkeypatch):
    """The numbering of long rows joins, sums and writes no short rows, and stages no second time."""
    rows = [position(client=c, sec=s, strike=k, qty=q) for c in ("c1", "c2") for s in ("A", "B") for k in (10, 20) for q in (3, -1)]
    rows += [position(client="lone", qty=4), position(client=None, qty=2), position(client="", qty=-2), position(client=None, sec=None, qty=1), position(client=None, qty=-1)]
    seen = []
    pin = N.pin
    monkeypatch.setattr(N, "pin", lambda df, *name: seen.append(pin(df, *name)) or seen[-1])
    monkeypatch.setattr("tablecheck.operators.windows.pin", lambda *_: pytest.fail("staged again"))
    run = stages(spark, rows)
    got = N.numbered_long_rows(run.longs).collect()
    assert len(seen) == 2
    assert {r.short_or_long for r in seen[1].collect()} == {"Long"}
    key = lambda r: (r.bor_client_id or "", r.underlying_sec_name, r.strikepriceamount)
    assert [(*key(r), r.row_id) for r in sorted(got, key=key)] == [
        ("", "ABC CORP", 20, 1), ("", "CALL 100 ABC'24 @20", 20, 2),
        *((c, s, k, n) for c in ("c1", "c2") for s, k, n in (("A", 10, 1), ("A", 20, 2), ("B", 10, 3), ("B", 20, 4))),
    ]
    assert sorted(map(repr, run.longs.collect())) == sorted(map(repr, N.long_rows(run.pinned_sides).collect()))


def odd(n=400):
    """Groups that are NULL on one side and '' on the other, sides that only one of them has, several
    names and strikes in a maturity, and maturities that offset exactly."""
    rows = many(n)
    for i in range(n // 4):
        client, symbol = (None, "", "x")[i % 3], ("ABC", "", None, "D")[i % 4]
        qty = (i % 5 + 1) * (1 if client is None or i % 8 > 4 else -1)
        name = None if symbol is None and i % 2 else "CALL 100 ABC'24 @20"
        rows.append(position(client=client, symbol=symbol, name=name, qty=qty, day=f"2024-{i % 3 + 1:02d}-01", strike=10 * (i % 3), sec=f"N{i % 4}"))
    rows += [position(client="even", qty=q, day=d) for q, d in ((4, "2024-01-01"), (-4, "2024-01-01"), (3, "2024-02-01"), (-1, "2024-03-01"))]
    return rows + [position(client="", qty=2, symbol="L"), position(client=None, qty=-2, symbol="L")]


@pytest.mark.parametrize("blanks", [True, False])
@pytest.mark.parametrize("policy, newest, by_name", [("ordered", False, True), ("ordered_alterix", True, True), ("unordered", False, False)])
def test_report_at_home_equals_the_one_in_pieces(spark, cut_often, monkeypatch, policy, newest, by_name, blanks):
    rows = [r for r in odd() if blanks or "" not in (r[0], r[3])]
    options = {"policy": policy, "newest_first": newest, "by_name": by_name}
    home = stages(spark, rows, **options)
    got = sorted(map(str, home.report.collect()))
    assert len(N._home(home.homed)) == (4 if blanks else 1)
    monkeypatch.setattr(windows, "WHOLE_GROUP_ROWS", 0)
    cut = stages(spark, rows, **options)
    assert cut.settled is None
    assert got == sorted(map(str, cut.report.collect())) and len(got) > 40
    assert home.report.schema == cut.report.schema


def test_report_is_dealt_and_staged_once(spark, monkeypatch):
    """Behind the totals there are no joins, one shuffle, two sorts and no other staged table."""
    seen, pin = [], N.pin
    monkeypatch.setattr(N, "pin", lambda df, *name: seen.append(name) or pin(df, *name))
    monkeypatch.setattr("tablecheck.operators.windows.pin", lambda *_: pytest.fail("staged again"))
    report = stages(spark, many()).report
    report.collect()
    assert seen == [("totals",)]
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2 and "Join" not in plan


def test_extract_rows_are_numbered_without_pieces(spark, monkeypatch):
    report = stages(spark, many()).report
    for which in ("1", "3"):
        make, number, key = E.MAKERS[which]
        with monkeypatch.context() as m:
            m.setattr(windows, "WHOLE_GROUP_ROWS", 0)
            cut = sorted(map(str, number(make(report)).collect()))
            m.setattr(windows, "WHOLE_GROUP_ROWS", 1000)
            m.setattr(windows, "ordered_pieces", lambda *_: pytest.fail("cut into pieces"))
            got = number(make(report))
        assert sorted(map(str, got.collect())) == cut
        assert got.groupBy(*key).count().filter("count > 1").isEmpty()
