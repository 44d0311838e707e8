import pytest

from tablecheck.model import EdgeRule, ExtractRules, RunInfo
from tablecheck.sources import text as L
from tablecheck.sources import xml as M

RUN = RunInfo("20240131", "2024-02-01 08:30:00")
STAMP = "20240201083000"
RULES = ExtractRules(
    "t",
    "psv",
    skip_header_rows=2,
    skip_trailer_rows=1,
    headers=(EdgeRule("H!{as_of_date}"), EdgeRule("k|v", is_pattern=False)),
    trailers=(EdgeRule("T!{count}"),),
    tbl_column_names=("k", "v"),
)


def write(folder, name, lines, end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + end)
    return str(folder)


def good(n=5):
    return ["H|20240131", "k|v", *[f"{i}|v{i}" for i in range(n)], f"T|{n}"]


def status(spark, path, mode="prefix", rules=RULES):
    rows = L.check_edges(L.read_lines(spark, path), rules, RUN, STAMP, mode).collect()
    return {(r.part, r.line_no): r.status for r in rows}


def read_in_blocks(spark, path, size):
    """The lines of `path`, read in blocks of `size` bytes."""
    limits = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        return L.read_lines(spark, path).coalesce(4)
    finally:
        for key in limits:
            spark.conf.unset(key)


def test_split_over_many_blocks_and_files(spark, tmp_path):
    for name, n in (("a.txt", 300), ("b.txt", 7), ("c.txt", 120)):
        path = write(tmp_path / "in", name, good(n))
    lines = read_in_blocks(spark, path, 300)
    assert lines.select("file", "block").distinct().count() > 10
    data, edges = L.split_lines(lines, RULES)
    assert data.count() == 427
    assert data.filter("value like 'H%' or value like 'T%' or value = 'k|v'").count() == 0
    got = sorted((r.file[-5:], r.part, r.line_no, r.value) for r in edges.collect())
    assert [g for g in got if g[0] == "a.txt"] == [
        ("a.txt", "header", 1, "H|20240131"), ("a.txt", "header", 2, "k|v"), ("a.txt", "trailer", 1, "T|300"),
    ]
    counts = {r.file[-5:]: r.record_count for r in L.record_counts(lines, RULES).collect()}
    assert counts == {"a.txt": 300, "b.txt": 7, "c.txt": 120}
    assert set(status(spark, path).values()) == {"PASS"}


@pytest.mark.parametrize(
    "change,failing",
    [
        (lambda x: [*x[:-1], "T|9"], {("trailer", 1)}),
        (lambda x: ["H|20240130", *x[1:]], {("header", 1)}),
        (lambda x: [x[0], "k|w", *x[2:]], {("header", 2)}),
        (lambda x: x, set()),
    ],
)
def test_wrong_edges(spark, tmp_path, change, failing):
    path = write(tmp_path / "in", "x.txt", change(good()))
    assert {k for k, s in status(spark, path).items() if s == "FAIL"} == failing
    rows = L.validate_extract(L.read_lines(spark, path), RULES, RUN, STAMP).collect()
    assert sum(r.overall_Status == "FAIL" for r in rows) == len(failing)


def test_prefix_and_full_mode(spark, tmp_path):
    path = write(tmp_path / "in", "x.txt", [*good()[:-1], "T|5 and more"])
    assert status(spark, path)[("trailer", 1)] == "PASS"
    assert status(spark, path, "full")[("trailer", 1)] == "FAIL"


def test_missing_final_newline_and_no_data(spark, tmp_path):
    path = write(tmp_path / "a", "x.txt", good(3), end="")
    assert set(status(spark, path).values()) == {"PASS"}
    path = write(tmp_path / "b", "x.txt", good(0))
    assert set(status(spark, path).values()) == {"PASS"}
    assert L.split_lines(L.read_lines(spark, path), RULES)[0].count() == 0


def test_line_that_is_not_there_fails(spark, tmp_path):
    path = write(tmp_path / "in", "x.txt", ["H|20240131"])
    assert status(spark, path)[("header", 2)] == "FAIL"


def test_header_longer_than_the_first_block(spark, tmp_path):
    """Edges may run over block borders, and may leave no data at all."""
    rules = ExtractRules("t", "psv", skip_header_rows=9, skip_trailer_rows=7)
    path = write(tmp_path / "in", "x", [f"line {i:02d} {'.' * 20}" for i in range(40)])
    data, edges = L.split_lines(read_in_blocks(spark, path, 100), rules)
    assert sorted(int(r.value[5:7]) for r in data.collect()) == list(range(9, 33))
    got = {(r.part, r.line_no): int(r.value[5:7]) for r in edges.collect()}
    assert got == {("header", i + 1): i for i in range(9)} | {("trailer", i + 1): 33 + i for i in range(7)}
    path = write(tmp_path / "few", "x", [f"line {i:02d}" for i in range(10)])
    data, edges = L.split_lines(L.read_lines(spark, path), rules)
    assert data.count() == 0
    assert edges.groupBy("part").count().count() == 2 and edges.count() == 16


def test_formats(spark, tmp_path):
    names = ("k", "v")
    csv = write(tmp_path / "csv", "x", ['1,"a, b"', "2,x|y", "3,"])
    rules = ExtractRules("t", "csv", tbl_column_names=names)
    assert [tuple(r) for r in L.read_extract(spark, csv, rules).orderBy("k").collect()] == [("1", "a, b"), ("2", "x~!~y"), ("3", None)]
    fwf = write(tmp_path / "fwf", "x", ["001  ab|c ", "2         "])
    rules = ExtractRules("t", "fwf", tbl_column_names=names, fixed_widths=(5, 5))
    assert [tuple(r) for r in L.read_extract(spark, fwf, rules).orderBy("k").collect()] == [("001", "ab,c"), ("2", None)]
    fixed_csv = write(tmp_path / "fwcsv", "x", ["1,   a b, ", "2,   ,    "])
    rules = ExtractRules("t", "fw_csv", tbl_column_names=names, fixed_widths=(5, 5))
    assert [tuple(r) for r in L.read_extract(spark, fixed_csv, rules).orderBy("k").collect()] == [("1", "a b"), ("2", None)]
    with pytest.raises(ValueError):
        L.read_extract(spark, csv, ExtractRules("t", "zip"))


NESTED = """<?xml version="1.0"?>
<b:Batch xmlns:b="urn:x" BizDt="2024-01-31"
   Tot="2">
  <Req Id="1"><Pty ID="P"> Some TEXT </Pty><Leg n="1">a</Leg><Leg n="2">b</Leg><Fee f="9"/><Fee f="8"/></Req>
  <Req Id="2"><Pty ID="Q"/><Leg n="3">c</Leg></Req>
</b:Batch>
"""


ROW_SCHEMA = """_Id string, Pty struct<_VALUE: string, _ID: string>, Leg array<struct<_VALUE: string, _n: string>>,
  Fee array<struct<_VALUE: string, _f: string>>"""


def test_xml_inferred(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "x.xml").write_text(NESTED)
    rows = L.read_extract(spark, str(folder), ExtractRules("t", "xml", row_tag="Req")).collect()
    assert len(rows) == 4
    assert {r.leg_text for r in rows} == {"a", "b", "c", ""}
    assert {r.fee_f for r in rows} == {"9", "8", None}


def test_xml(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "x.xml").write_text(NESTED)
    rules = ExtractRules("t", "xml", row_tag="Req", root_tag="Batch", row_schema=ROW_SCHEMA)
    rows = L.read_extract(spark, str(folder), rules)
    assert {"batch_bizdt", "batch_tot", "batch_text", "req_id", "pty_id", "pty_text", "leg_n", "leg_text", "fee_f"} <= set(rows.columns)
    got = {(r.batch_bizdt, r.batch_tot, r.req_id, r.pty_id, r.pty_text, r.leg_n, r.leg_text, r.fee_f) for r in rows.collect()}
    day = "2024-01-31"
    assert got == {
        (day, "2", "1", "P", "some text", "1", "a", None),
        (day, "2", "1", "P", "some text", "2", "b", "9"),
        (day, "2", "1", "P", "some text", None, "", "8"),
        (day, "2", "2", "Q", "", "3", "c", None),
    }


def test_xsd(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "x.xml").write_text("<a><r><n>1</n></r><r><n>oops</n></r></a>")
    xsd = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="r"><xs:complexType><xs:sequence>
      <xs:element name="n" type="xs:int"/></xs:sequence></xs:complexType></xs:element></xs:schema>"""
    schema = spark.createDataFrame([], "n string").schema
    bad = M.xsd_failures(spark, str(folder), "r", schema, M.ship_xsd(spark, xsd)).collect()
    assert len(bad) == 1 and "oops" in bad[0][0]


def test_names_and_delimiter_come_from_the_rules(spark, tmp_path):
    rules = ExtractRules("t", "psv", delimiter=";", skip_header_rows=1)
    path = write(tmp_path / "semi", "a.txt", ["k;v", "1;a|b", "2;"])
    write(tmp_path / "semi", "b.txt", ["k;v", "3;c"])
    got = sorted(tuple(r) for r in L.read_extract(spark, path, rules).collect())
    assert got == [("1", "a~!~b"), ("2", None), ("3", "c")]
    assert L.read_extract(spark, path, rules).columns == ["k", "v"]
    write(tmp_path / "semi", "c.txt", ["k;other", "4;d"])
    with pytest.raises(ValueError, match="no column names"):
        L.read_extract(spark, path, rules)
    with pytest.raises(ValueError, match="no column names"):
        L.read_extract(spark, path, ExtractRules("t", "psv"))
