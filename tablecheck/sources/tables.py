"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.model import RESULT_SCHEMA

#: A run of a table is one folder of the log, which is replaced as a whole.
LOG_PARTITIONS = ("as_of_date", "last_insert_timestamp", "table_name")
#: Folders of a replaced stage: its versions, and an empty file for each that was published.
VERSION, PUBLISHED = "version=", "_published"


def read_table(
    spark: SparkSession, source: DataFrame | str, fmt: str = "parquet", where: Column | str | None = None
) -> DataFrame:
    """`source` is a frame, a path (anything with a '/') or a catalog name; a
    registered view is read by its name. Of a replaced stage the published version is read."""
    if isinstance(source, DataFrame):
        df = source
    elif "/" in source:
        df = spark.read.format(fmt).load(current_version(spark, source) or source)
    else:
        df = spark.table(source)
    return df if where is None else df.filter(where)


def read_query(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """A SQL query; frames passed by name are available as `{name}`."""
    return spark.sql(query, **frames)


def read_text_table(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None, **options: str
) -> DataFrame:
    """Delimited file with a header; text columns unless a schema is given."""
    reader = spark.read.options(header="true", sep=sep, **options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def permitted_columns(
    df: DataFrame, grants: DataFrame, schema_name: str, table_name: str, principal: str | None = None
) -> list[str]:
    """Columns of `df` that the grants name, in table order. Only names come to
    the driver, at most one per column of the table."""
    held = grants.filter(
        (F.col("schema_name") == schema_name)
        & (F.col("table_name") == table_name)
        & F.col("column_name").isin(df.columns)
    )
    if principal is not None:
        held = held.filter(F.col("user_name") == principal)
    names = {row.column_name for row in held.select("column_name").distinct().collect()}
    return [c for c in df.columns if c in names]


def select_permitted(
    df: DataFrame, grants: DataFrame, schema_name: str, table_name: str, principal: str | None = None
) -> DataFrame:
    return df.select(*permitted_columns(df, grants, schema_name, table_name, principal))


def jdbc_options(
    url: str,
    table: str,
    columns: Sequence[str],
    properties: Mapping[str, str],
    split: tuple[str, str, str, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a view: only the wanted columns travel, and with
    `split=(column, lower, upper, partitions)` many connections share the read."""
    options = {
        "url": url,
        "dbtable": f"(select {', '.join(columns)} from {table}) t",
        "fetchsize": str(fetch_size),
        **properties,
    }
    if split:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_view(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """See `jdbc_options`; the caller supplies url and credentials."""
    return spark.read.format("jdbc").options(**jdbc_options(*args, **kwargs)).load()


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 100) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(*keys).limit(n)


def append_results(results: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Adds result rows to the shared log. All rows of a table and run come in one call.

    Each table and run is a folder that is replaced as a whole, so a run that is
    repeated after a failure, under the same stamp, is in the log once."""
    rows = results.select([f.name for f in RESULT_SCHEMA])
    rows = rows.repartition(*LOG_PARTITIONS)  # a few rows each; one file
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.format(fmt).partitionBy(*LOG_PARTITIONS).save(path)


def read_results(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(RESULT_SCHEMA).load(path).select([f.name for f in RESULT_SCHEMA])


def _folder(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def published_versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions of a stage that are still there, oldest first."""
    fs, place = _folder(spark, f"{path}/{PUBLISHED}")
    if not fs.exists(place):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(place))


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of a stage's newest published version; None if `path` is no such stage."""
    found = published_versions(spark, path)
    return f"{path}/{VERSION}{found[-1]}" if found else None


def replace_table(df: DataFrame, target: str, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Replaces a stage (a path or a catalog table) and reads it back.

    The rows are written as a new version beside the old one, which is read until the new one
    is whole and published: by an empty file, made last. So a write that fails at any time
    leaves the old rows, may be repeated, and frames that read the old version go on; the version
    before the last is deleted. Of two writers at once the second to publish fails.
    A catalog table points at the published version; its versions are below `path`, else
    beside the warehouse's tables."""
    spark = df.sparkSession
    in_catalog = "/" not in target
    root = target if not in_catalog else path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target}.versions"
    before = published_versions(spark, root)
    number = before[-1] + 1 if before else 1
    written = f"{root}/{VERSION}{number}"
    df.write.mode("overwrite").format(fmt).save(written)
    fs, mark = _folder(spark, f"{root}/{PUBLISHED}/{number}")
    fs.create(mark, False).close()
    if in_catalog:
        _point(spark, target, fmt, written)
    for old in before[:-1]:
        fs.delete(_folder(spark, f"{root}/{PUBLISHED}/{old}")[1], False)
        fs.delete(_folder(spark, f"{root}/{VERSION}{old}")[1], True)
    return spark.table(target) if in_catalog else spark.read.format(fmt).load(written)


def _point(spark: SparkSession, name: str, fmt: str, location: str) -> None:
    """Makes the catalog table read a folder. A table of the same columns is only pointed
    elsewhere; one of other columns is made anew, its rows not being the table's own."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    wanted = spark.read.format(fmt).load(location).schema
    if spark.catalog.tableExists(name) and spark.table(name).schema == wanted:
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {quoted}")
        spark.catalog.createTable(name, path=location, source=fmt)
    spark.catalog.refreshTable(name)


def publish(df: DataFrame, name: str, everywhere: bool = False) -> DataFrame:
    """Registers the frame as a temporary view, for all sessions if asked."""
    if everywhere:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


def export_results(results: DataFrame, path: str, sep: str = "|") -> None:
    """One delimited file of result rows (a few per compared column, so small)."""
    results.coalesce(1).write.mode("overwrite").options(header="true", sep=sep).csv(path)


def export_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """A normalised extract, written in parallel with a header."""
    df.write.mode("overwrite").options(header="true", sep=sep).csv(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
