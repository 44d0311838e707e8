"""XML extracts as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.session import pin, staging_path

ATTRIBUTE = "_"
TEXT = "_VALUE"
BAD = "_corrupt_record"


def _bare(name: str) -> str:
    """Tag or attribute name in lower case, without its namespace."""
    return name.removeprefix(ATTRIBUTE).split(":")[-1].lower()


def file_filter(file_ext: str) -> dict[str, str]:
    """Reader options that leave out files with another extension; '' takes all."""
    return {"pathGlobFilter": f"*.{file_ext.lstrip('.')}"} if file_ext else {}


def document_path(folders: bool = False) -> Column:
    """What a row's document is called: by its file, or by its folder if documents come in part files."""
    file = F.col("_metadata.file_path")
    return F.regexp_replace(file, "/[^/]*$", "") if folders else file


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None, xsd: str | None = None,
    file_ext: str = "",
) -> DataFrame:
    """One row per `row_tag` element. With `xsd`, elements that do not conform
    keep their text in `_corrupt_record`."""
    options = {"rowTag": row_tag, "attributePrefix": ATTRIBUTE, "valueTag": TEXT, "inferSchema": "false"}
    options |= file_filter(file_ext)
    if xsd:
        options |= {"rowValidationXSDPath": xsd, "columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE"}
    reader = spark.read.format("xml").options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def xsd_failures(spark: SparkSession, path: str, row_tag: str, schema: T.StructType, xsd: str) -> DataFrame:
    """The elements that do not conform to the schema file, as text.

    Spark does not read the bad text on its own, so the bad rows (only those)
    are written once with all their fields."""
    wanted = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return pin(read_xml(spark, path, row_tag, wanted, xsd).filter(F.col(BAD).isNotNull())).select(BAD)


def _text(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))), F.lit(""))


class _Level:
    """Columns of one element: own values, single children, one row list."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self.columns: dict[str, Column] = {}

    def add(self, tag: str, path: str, kind: T.DataType) -> None:
        """`path` is a column path of the frame holding the element."""
        if not isinstance(kind, T.StructType):
            self.columns[f"{tag}_text"] = _text(F.col(path))
            return
        lists: list[tuple[str, str, T.DataType]] = []
        names = {f.name for f in kind.fields}
        for f in kind.fields:
            at = f"{path}.`{f.name}`"
            if f.name == TEXT:
                self.columns[f"{tag}_text"] = _text(F.col(at))
            elif f.name.startswith(ATTRIBUTE):
                self.columns[f"{tag}_{_bare(f.name)}"] = F.col(at).cast("string")
            elif isinstance(f.dataType, T.ArrayType):
                lists.append((_bare(f.name), at, f.dataType.elementType))
            else:
                self.add(_bare(f.name), at, f.dataType)
        if TEXT not in names:
            self.columns[f"{tag}_text"] = F.lit("")
        if lists:
            self._explode(lists)

    def _explode(self, lists: list[tuple[str, str, T.DataType]]) -> None:
        """Every repeat starts a row. Different repeated tags follow one another:
        the first of the next tag shares the row of the last of the tag before,
        so n tags give the sum of their lengths in rows, not the product."""
        index = f"_i{len(self.columns)}_{lists[0][0]}"
        sizes = [F.coalesce(F.size(F.col(at)), F.lit(0)) for _, at, _ in lists]
        starts, start = [], F.lit(0)
        for size in sizes:
            starts.append(start)
            start = start + F.greatest(size - 1, F.lit(0))
        self.df = self.df.withColumn(index, F.explode(F.sequence(F.lit(0), start)))
        for (tag, at, kind), begin in zip(lists, starts, strict=True):
            item = f"{index}_{tag}"
            place = F.col(index) - begin
            self.df = self.df.withColumn(item, F.when(place >= 0, F.get(F.col(at), place)))
            self.add(tag, item, kind)


def flatten(df: DataFrame, row_tag: str) -> DataFrame:
    """Nested records to flat text rows: `<tag>_<attribute>` and `<tag>_text`."""
    level = _Level(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")))
    level.add(_bare(row_tag), "_row", df.schema)
    return level.df.select([c.alias(n) for n, c in level.columns.items()])


def root_values(spark: SparkSession, path: str, root_tag: str, folders: bool = False) -> DataFrame:
    """(file, attributes) of each document's root element.

    Cutting the text at '>' keeps a tag in one piece even when it runs over
    several lines; the root tag lies in the first block of its file. The result,
    one row per file, is staged: its size is then known, and Spark broadcasts it
    when it is small."""
    pieces = spark.read.option("lineSep", ">").text(path)
    opening = pieces.filter(F.col("_metadata.file_block_start") == 0).filter(
        F.col("value").rlike(rf"<(?:[\w.-]+:)?{root_tag}(?:\s|$)")
    )
    pattern = F.lit(r"\s(?!xmlns)([\w:.-]+)\s*=\s*[\"']([^\"']*)[\"']")
    names = F.regexp_extract_all("value", pattern, F.lit(1))
    values = F.regexp_extract_all("value", pattern, F.lit(2))
    bare = F.transform(names, lambda n: F.lower(F.regexp_replace(n, "^.*:", "")))
    found = opening.select(document_path(folders).alias("_file"), F.map_from_arrays(bare, values).alias("_root"))
    return pin(found.groupBy("_file").agg(F.any_value("_root").alias("_root")), "roots")


def flatten_xml(
    spark: SparkSession, path: str, row_tag: str, root_tag: str | None = None, schema: T.StructType | str | None = None,
    file_ext: str = "",
) -> DataFrame:
    """Flat rows of an XML extract; root attributes are on every row.

    Without a schema Spark infers one in a pass of its own and sorts it by name;
    give one to save the pass and to keep the order of repeated tags."""
    records = read_xml(spark, path, row_tag, schema, file_ext=file_ext)
    if root_tag is None:
        return flatten(records, row_tag)
    return flatten_with_root(records.withColumn("_file", F.col("_metadata.file_path")), path, row_tag, root_tag)


def flatten_with_root(records: DataFrame, path: str, row_tag: str, root_tag: str, folders: bool = False) -> DataFrame:
    """Flat rows of parsed records, which carry their `_file`, with its root's attributes."""
    roots = root_values(records.sparkSession, path, root_tag, folders)
    tag = _bare(root_tag)
    # The attribute names are metadata: a few names, from the files' first tags.
    names = sorted(r.k for r in roots.select(F.explode(F.map_keys("_root")).alias("k")).distinct().collect())
    marked = records.join(roots, "_file", "left")
    fields = [c for c in records.columns if c != "_file"]
    level = _Level(
        marked.select(F.struct(*[F.col(f"`{c}`") for c in fields]).alias("_row"), F.col("_root").alias("_root_map"))
    )
    for name in names:
        level.columns[f"{tag}_{name}"] = F.element_at("_root_map", name)
    level.columns[f"{tag}_text"] = F.lit("")
    level.add(_bare(row_tag), "_row", marked.select(*[F.col(f"`{c}`") for c in fields]).schema)
    return level.df.select([c.alias(n) for n, c in level.columns.items()])


def ship_xsd(spark: SparkSession, text: str) -> str:
    """Stages schema text in the shared folder and ships it to all executors;
    returns the name the reader finds it by."""
    path = staging_path(spark, "schema")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    staged = spark.read.text(path).inputFiles()[0]
    spark.sparkContext.addFile(staged)
    return staged.rsplit("/", 1)[-1]
