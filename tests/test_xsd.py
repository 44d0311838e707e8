"""XML extracts against a schema file: records, and whole documents."""

import pytest

from tablecheck.model import ExtractRules
from tablecheck.sources import text as L
from tablecheck.sources import xsd as X

XSD = """<?xml version="1.0"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="items">
    <xs:complexType><xs:sequence><xs:element ref="item" minOccurs="2" maxOccurs="4"/></xs:sequence></xs:complexType>
    <xs:key name="id_key"><xs:selector xpath="item"/><xs:field xpath="@id"/></xs:key>
    <xs:unique name="code_once"><xs:selector xpath="./item"/><xs:field xpath="info/code"/></xs:unique>
    <xs:keyref name="parent" refer="id_key"><xs:selector xpath="item"/><xs:field xpath="@under"/></xs:keyref>
  </xs:element>
  <xs:element name="item">
    <xs:complexType>
      <xs:sequence>
        <xs:element name="info" minOccurs="0"><xs:complexType><xs:sequence>
          <xs:element name="code" type="xs:string"/></xs:sequence></xs:complexType></xs:element>
        <xs:element name="n" type="xs:int"/>
      </xs:sequence>
      <xs:attribute name="id" type="xs:string"/>
      <xs:attribute name="under" type="xs:string"/>
    </xs:complexType>
  </xs:element>
</xs:schema>"""
SCHEMA = "_id string, _under string, info struct<code: string>, n int"


def item(id=None, under=None, code=None, n="1"):
    attributes = "".join(f' {k}="{v}"' for k, v in (("id", id), ("under", under)) if v is not None)
    info = "" if code is None else f"<info><code>{code}</code></info>"
    return f"<item{attributes}>{info}<n>{n}</n></item>"


FILES = {
    "good.xml": [item("a"), item("b", "a", "x"), item("c", "b", "y")],
    "across.xml": [item("a", code="x"), item("a", "z", "x"), item(None, "a")],  # each record is fine on its own
    "record.xml": [item("a"), item("b"), item("c", n="many")],
    "few.xml": [item("a")],
    "many.xml": [item(str(k)) for k in range(5)],
    "none.xml": [],
    "skipped.txt": [item("a", "nowhere")],
}


@pytest.fixture
def rules(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, items in FILES.items():
        (folder / name).write_text("<items day='1'>\n" + "\n".join(items) + "\n</items>")
    (tmp_path / "items.xsd").write_text(XSD)
    found = ExtractRules(
        "items", "xml", extract_file_ext="xml", row_tag="item", root_tag="items", row_schema=SCHEMA,
        validator_file_name=str(tmp_path / "items.xsd"),
    )
    return str(folder), found


def name_of(file):
    return file.rsplit("/", 1)[-1]


def test_documents(spark, rules):
    path, given = rules
    rows, found = L.read_checked(spark, path, given)
    failures = {(name_of(r.file), r.rule, r.value, r.records) for r in found.failures.collect()}
    assert failures == {
        ("across.xml", "key id_key", "a", 2),
        ("across.xml", "key id_key", "(missing)", 1),
        ("across.xml", "unique code_once", "x", 2),
        ("across.xml", "keyref parent", "z", 1),
        ("few.xml", "minOccurs", "1", 1),
        ("many.xml", "maxOccurs", "5", 5),
        ("none.xml", "minOccurs", "0", 0),
    }
    verdicts = {name_of(r.file): (r.accepted, r.rejected, r.failures, r.status) for r in found.documents(X.xml_files(spark, path, "xml")).collect()}
    assert verdicts == {
        "good.xml": (3, 0, 0, "PASS"),
        "across.xml": (3, 0, 4, "FAIL"),
        "record.xml": (2, 1, 0, "FAIL"),
        "few.xml": (1, 0, 1, "FAIL"),
        "many.xml": (5, 0, 1, "FAIL"),
        "none.xml": (0, 0, 1, "FAIL"),
    }
    assert rows.count() == 14 and {r.items_day for r in rows.collect()} == {"1"}


def test_rejects(spark, rules):
    path, given = rules
    _, found = L.read_checked(spark, path, given)
    bad = found.rejected.collect()
    assert [(name_of(r.file), r.reason) for r in bad] == [("record.xml", "does not conform to the schema")]
    assert "<n>many</n>" in bad[0].record
    assert L.read_extract(spark, path, given).count() == 14


def test_one_parse_of_the_text(spark, rules):
    """Everything but the attributes of the roots comes from one staged scan."""
    path, given = rules
    found = X.check_xml(spark, path, "item", SCHEMA, XSD, "xml")
    for df in (found.accepted, found.rejected, found.failures):
        plan = df._jdf.queryExecution().executedPlan().toString().lower()
        assert "parquet" in plan and "xml" not in plan.replace(".xml", "").replace("binaryfile", "")


def test_rules_of_a_schema():
    found = X.document_rules(XSD, "item")
    assert (found.least, found.most) == (2, 4)
    assert [(c.name, c.kind, c.fields, c.refer) for c in found.constraints] == [
        ("id_key", "key", ("@id",), ""), ("code_once", "unique", ("info/code",), ""), ("parent", "keyref", ("@under",), "id_key"),
    ]
    assert X.document_rules(XSD, "other") == X.DocumentRules()
    with pytest.raises(ValueError, match="references to keys"):
        X.document_rules(XSD.replace('refer="id_key"', 'refer="else"'), "item")


def test_fields_that_records_lack_and_other_formats_raise(spark, rules):
    path, given = rules
    with pytest.raises(ValueError, match="no field @under"):
        X.check_xml(spark, path, "item", "_id string, info struct<code: string>, n int", XSD)
    with pytest.raises(ValueError, match="only XML"):
        L.read_extract(spark, path, ExtractRules("t", "csv", validator_file_name="x.xsd"))


def test_only_files_with_the_extension(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.dat").write_text("1,2\n")
    (folder / "b.bak").write_text("3,4\n")
    names = ("a", "b")
    take = lambda ext: L.read_extract(spark, str(folder), ExtractRules("t", "csv", extract_file_ext=ext, tbl_column_names=names))
    assert [tuple(r) for r in take("dat").collect()] == [("1", "2")]
    assert [tuple(r) for r in take(".bak").collect()] == [("3", "4")]
    assert take("").count() == 2


def test_documents_of_part_files(spark, tmp_path):
    """A document in several files, which several tasks read: its rules hold across them."""
    for day, parts in {"one": [["a", "b"], ["a"]], "two": [["a"], ["b", "c"], []]}.items():
        (tmp_path / "in" / f"part={day}").mkdir(parents=True)
        for i, ids in enumerate(parts):
            items = "".join(f"<item id='{k}'><n>1</n></item>\n" for k in ids)
            (tmp_path / "in" / f"part={day}" / f"{i}.xml").write_text(f"<items day='{day}'>\n{items}</items>")
    (tmp_path / "items.xsd").write_text(XSD)
    given = ExtractRules(
        "items", "xml", row_tag="item", root_tag="items", row_schema=SCHEMA, validator_file_name=str(tmp_path / "items.xsd"),
        document_folders=True,
    )
    path = str(tmp_path / "in")
    rows, found = L.read_checked(spark, path, given)
    assert [(name_of(r.file), r.rule, r.value, r.records) for r in found.failures.collect()] == [("part=one", "key id_key", "a", 2)]
    verdicts = {name_of(r.file): (r.accepted, r.status) for r in found.documents(X.xml_files(spark, path, folders=True)).collect()}
    assert verdicts == {"part=one": (3, "FAIL"), "part=two": (3, "PASS")}
    assert sorted(r.items_day for r in rows.collect()) == ["one"] * 3 + ["two"] * 3
