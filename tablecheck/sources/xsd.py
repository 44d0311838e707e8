"""XML extracts against a schema file: single records, and what holds for a whole document.

Spark checks records one by one. What a schema says about the records of a document together
(keys, unique values, references to keys, how many records there may be) is checked here by
aggregations and joins per file."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.columns import null_safe
from tablecheck.session import pin
from tablecheck.sources.xml import ATTRIBUTE, BAD, TEXT, document_path, file_filter, read_xml, ship_xsd

#: Columns of a staged document besides those of its records.
FILE = "_file"
REJECT = "file string, reason string, record string"
FAILURE = "file string, rule string, value string, records bigint"

_XS = "{http://www.w3.org/2001/XMLSchema}"


@dataclass(frozen=True)
class Constraint:
    """`kind` is key, unique or keyref; `refer` the key that a keyref points to."""

    name: str
    kind: str
    fields: tuple[str, ...]
    refer: str = ""


@dataclass(frozen=True)
class DocumentRules:
    """What a schema asks of all records of a document. `most` is None if there is no limit."""

    constraints: tuple[Constraint, ...] = ()
    least: int = 0
    most: int | None = None


def _bare(name: str) -> str:
    return name.strip().split(":")[-1]


def document_rules(xsd: str, row_tag: str) -> DocumentRules:
    """The rules on elements `row_tag` in the text of a schema file.

    Constraints count if their selector names the records, and fields may be attributes, child elements or
    elements further below. How often the record may occur is taken from its declaration inside
    another element."""
    root = ET.fromstring(xsd)
    constraints = []
    for kind in ("key", "unique", "keyref"):
        for node in root.iter(_XS + kind):
            selector = node.find(_XS + "selector")
            target = "" if selector is None else _bare(selector.get("xpath", "").split("/")[-1])
            if target != row_tag:
                continue
            fields = tuple(f.get("xpath", "").strip().removeprefix("./") for f in node.findall(_XS + "field"))
            constraints.append(Constraint(node.get("name", ""), kind, fields, _bare(node.get("refer", ""))))
    keys = {c.name for c in constraints if c.kind != "keyref"}
    unknown = [c.name for c in constraints if c.kind == "keyref" and c.refer not in keys]
    if unknown:
        raise ValueError(f"references to keys of other elements than {row_tag}: {', '.join(unknown)}")
    least, most = 0, None
    for group in (*root.iter(_XS + "sequence"), *root.iter(_XS + "choice"), *root.iter(_XS + "all")):
        for node in group.findall(_XS + "element"):
            if _bare(node.get("name") or node.get("ref") or "") == row_tag:
                least, limit = int(node.get("minOccurs", "1")), node.get("maxOccurs", "1")
                most = None if limit == "unbounded" else int(limit)
    return DocumentRules(tuple(constraints), least, most)


def _field(schema: T.StructType, path: str) -> Column:
    """The value at a field's path as text; white space around it does not count."""
    steps = [ATTRIBUTE + _bare(p[1:]) if p.startswith("@") else _bare(p) for p in path.split("/")]
    kind: T.DataType = schema
    for step in steps:
        if not isinstance(kind, T.StructType) or step not in kind.names:
            raise ValueError(f"the records have no field {path}")
        kind = kind[step].dataType
    if isinstance(kind, T.StructType):
        steps.append(TEXT)
    return F.trim(F.col(".".join(f"`{s}`" for s in steps)).cast("string"))


def _shown(values: Sequence[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(v), F.lit("(missing)")) for v in values])


def document_failures(records: DataFrame, files: DataFrame, rules: DocumentRules) -> DataFrame:
    """(file, rule, value, records): each value that breaks a rule in a file, and how many records do.

    `records` has the parsed records and `_file`; `files` (file) also those without records. Values
    count by partial sums before they are shuffled, so one that most records share is no
    hot group; references are joined as distinct values."""
    if not rules.constraints and not rules.least and rules.most is None:
        return records.sparkSession.createDataFrame([], FAILURE)
    schema = T.StructType([f for f in records.schema.fields if f.name not in (FILE, BAD)])
    counted: dict[str, tuple[DataFrame, list[str]]] = {}
    parts = []
    for c in rules.constraints:
        names = [f"f{i}" for i in range(len(c.fields))]
        rows = records.select(F.col(FILE).alias("file"), *[_field(schema, p).alias(n) for p, n in zip(c.fields, names, strict=True)])
        values = rows.groupBy("file", *names).agg(F.count(F.lit(1)).alias("records"))
        whole = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
        counted[c.name] = values.filter(whole), names
        if c.kind == "unique":
            bad = values.filter(whole & (F.col("records") > 1))
        elif c.kind == "key":
            bad = values.filter(~whole | (F.col("records") > 1))
        else:
            continue
        parts.append(bad.select("file", F.lit(f"{c.kind} {c.name}").alias("rule"), _shown(names).alias("value"), "records"))
    for c in rules.constraints:
        if c.kind != "keyref":
            continue
        values, names = counted[c.name]
        known, key_names = counted[c.refer]
        known = known.select(F.col("file").alias("k_file"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(key_names)])
        same = null_safe([(F.col("file"), F.col("k_file")), *[(F.col(n), F.col(f"k{i}")) for i, n in enumerate(names)]])
        bad = values.join(known, same, "left_anti")
        parts.append(bad.select("file", F.lit(f"keyref {c.name}").alias("rule"), _shown(names).alias("value"), "records"))
    held = records.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("records"))
    held = files.join(held, "file", "left").withColumn("records", F.coalesce("records", F.lit(0)).cast("bigint"))
    for name, broken in (("minOccurs", F.col("records") < rules.least), ("maxOccurs", F.col("records") > (rules.most if rules.most is not None else 2**62))):
        rows = held.filter(broken)
        parts.append(rows.select("file", F.lit(name).alias("rule"), F.col("records").cast("string").alias("value"), "records"))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Checked:
    """`accepted`: records that conform, as parsed, with `_file`. `rejected` (file, reason, record):
    the text of those that do not. `failures`: what is wrong with whole documents; their records
    stay accepted."""

    accepted: DataFrame
    rejected: DataFrame
    failures: DataFrame

    def documents(self, files: DataFrame) -> DataFrame:
        """(file, accepted, rejected, failures, status) of every file."""
        count = lambda df, at, name: df.groupBy(F.col(at).alias("file")).agg(F.count(F.lit(1)).alias(name))
        names = ("accepted", "rejected", "failures")
        out = files
        for df, at, name in zip((self.accepted, self.rejected, self.failures), (FILE, "file", "file"), names, strict=True):
            out = out.join(count(df, at, name), "file", "left")
        out = out.withColumns({n: F.coalesce(n, F.lit(0)).cast("bigint") for n in names})
        good = (F.col("rejected") == 0) & (F.col("failures") == 0)
        return out.withColumn("status", F.when(good, "PASS").otherwise("FAIL"))


def xml_files(spark: SparkSession, path: str, file_ext: str = "", folders: bool = False) -> DataFrame:
    """(file): the documents of an extract, those without records too."""
    files = spark.read.format("binaryFile").options(**file_filter(file_ext)).load(path)
    named = files.select(document_path(folders).alias("file"))  # contents are not read
    return named.distinct() if folders else named


def check_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None, xsd: str, file_ext: str = "",
    folders: bool = False,
) -> Checked:
    """An XML extract against the text of a schema file, parsed once.

    Spark reads an XML file in one task. With `folders` a document is a folder of part files, as many
    as it takes, and the rules hold for all of them together; `_file` is the folder then.

    One staged scan holds both the records that conform and the text of the others; all else
    reads the columns of that which it needs. Without a schema of the records Spark infers one."""
    if schema is None:
        schema = read_xml(spark, path, row_tag, file_ext=file_ext).schema
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    wanted = T.StructType([f for f in wanted.fields if f.name != BAD] + [T.StructField(BAD, T.StringType())])
    parsed = read_xml(spark, path, row_tag, wanted, ship_xsd(spark, xsd), file_ext)
    staged = pin(parsed.withColumn(FILE, document_path(folders)), "checked")
    rejected = staged.filter(F.col(BAD).isNotNull())
    accepted = staged.filter(F.col(BAD).isNull()).drop(BAD)
    rules = document_rules(xsd, row_tag)
    return Checked(
        accepted,
        rejected.select(F.col(FILE).alias("file"), F.lit("does not conform to the schema").alias("reason"), F.col(BAD).alias("record")),
        document_failures(accepted, xml_files(spark, path, file_ext, folders), rules),
    )
