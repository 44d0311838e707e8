"""Inputs derived from the given tables: perturbed copies, a current/history
split, option positions and delivered text and XML extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.session import staging_path

AS_OF_DATE = "20240131"
PROCESS_DATE = "2024-01-31"
RUN_STAMP = "20240201083000"
RUN_DATE = "2024-02-01"
#: Keys of an extract file: few enough that the smallest data have several files.
FILE_ROWS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def perturbed_customer(customer: DataFrame) -> DataFrame:
    """Target-side copy of customer with known differences."""
    k = "c_custkey"
    balance = F.when(_every(k, 7), F.col("c_acctbal") * 1.00001).otherwise(F.col("c_acctbal"))
    balance = F.when(_every(k, 11), balance + 1).otherwise(balance)
    balance = F.when(~_every(k, 13), balance)
    segment = F.when(_every(k, 17), "").otherwise(F.col("c_mktsegment"))
    changed = {
        "c_acctbal": balance,
        "c_mktsegment": F.when(~_every(k, 19), segment),
        "c_name": F.when(_every(k, 23), F.lower("c_name")).otherwise(F.col("c_name")),
    }
    copies = F.array(F.col(k), F.when(_every(k, 97), F.col(k)), F.when(_every(k, 89), F.col(k) + 10_000_000))
    rows = customer.filter(~_every(k, 101)).withColumns(changed)
    return rows.withColumn(k, F.explode(F.array_compact(copies)))


def perturbed_lineitem(lineitem: DataFrame) -> DataFrame:
    more = F.when(_every("l_suppkey", 29), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return lineitem.filter(~_every("l_partkey", 211)).withColumn("l_quantity", more)


def customer_current(customer: DataFrame) -> DataFrame:
    return customer.withColumn("ifw_effective_date", F.lit("20240131000000"))


def customer_history(customer: DataFrame) -> DataFrame:
    parts = [
        (3, "20231231000000", "20240131000000", 100),
        (5, "20231130000000", "20231231000000", 200),
        (50, "20231031000000", None, 0),
    ]
    versions = F.array(
        *[
            F.when(
                _every("c_custkey", n),
                F.struct(
                    F.lit(start).alias("ifw_effective_date"),
                    F.lit(end).cast("string").alias("ifw_effective_end_date"),
                    F.lit(less).alias("less"),
                ),
            )
            for n, start, end, less in parts
        ]
    )
    rows = customer.withColumn("v", F.explode(F.array_compact(versions)))
    rows = rows.withColumn("c_acctbal", F.col("c_acctbal") - F.col("v.less"))
    return rows.select(*customer.columns, "v.ifw_effective_date", "v.ifw_effective_end_date")


def positions(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Option positions; the part table is a lookup by key. What follows from the part alone is made
    once per part."""
    lines = lineitem.select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    brand, price = F.translate("p_brand", "0123456789", "ABCDEFGHIJ"), (F.col("p_size") % 4 + 1) * 10
    parts = part.select(
        "p_partkey",
        brand.alias("code"),
        price.alias("strike"),
        F.concat(F.lit(" 100 "), brand, F.lit("'24 @"), price.cast("string")).alias("name"),
        F.concat(F.lit("U"), (F.col("p_size") % 3).cast("string")).alias("underlying"),
        F.concat(brand, F.lit(" CORP")).alias("sec_name"),
    )
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    kind = F.when(F.col("l_returnflag") == "A", "CALL").otherwise("PUT")
    long = F.col("l_linestatus") == "O"
    quantity = (F.col("l_quantity") % 4 + 1).cast("int")
    return rows.select(
        F.col("l_suppkey").cast("string").alias("bor_client_id"),
        F.concat(kind, F.col("name")).alias("option_name"),
        "underlying",
        F.when(F.col("l_linenumber") != 7, F.col("code")).alias("underlying_symbol"),
        F.col("sec_name").alias("underlying_sec_name"),
        F.date_format(F.trunc("l_shipdate", "year"), "yyyy-MM-dd").alias("option_maturitydate"),
        F.when(long, "Long").otherwise("Short").alias("short_or_long"),
        F.col("strike").alias("strikepriceamount"),
        F.when(long, quantity).otherwise(-quantity).alias("option_tradeqty"),
        F.lit(PROCESS_DATE).alias("process_date"),
        F.lit(RUN_DATE).alias("run_date"),
    )


def changed_report(report: DataFrame) -> DataFrame:
    """Target-side copy of the netting report with known differences."""
    client = F.col("bor_client_id").cast("bigint")
    more = F.when(client % 10 == 0, F.col("occ_qty_reported") + 1).otherwise(F.col("occ_qty_reported"))
    return report.filter(client % 37 != 0).withColumn("occ_qty_reported", more)


def deliver_lines(
    rows: DataFrame,
    key: str,
    line: Column,
    header: list[str],
    trailer: str | None,
    file_rows: int = FILE_ROWS,
) -> str:
    """Writes extract files of `file_rows` unique keys each: header lines, data
    lines by key, and a trailer with `{count}` filled in. Returns the folder."""
    data = rows.select(
        F.floor(F.col(key) / file_rows).cast("bigint").alias("bucket"), F.col(key).alias("at"), line.alias("value")
    )
    per_file = data.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    lines = data.select("bucket", F.lit(1).alias("part"), "at", "value")
    for i, text in enumerate(header):
        top = per_file.select("bucket", F.lit(0).alias("part"), F.lit(i).cast("bigint").alias("at"), F.lit(text).alias("value"))
        lines = lines.unionByName(top)
    if trailer is not None:
        text = F.replace(F.lit(trailer), F.lit("{count}"), F.col("n").cast("string"))
        end = per_file.select("bucket", F.lit(2).alias("part"), F.lit(0).cast("bigint").alias("at"), text.alias("value"))
        lines = lines.unionByName(end)
    path = staging_path(rows.sparkSession, "extract")
    ordered = lines.repartition("bucket").sortWithinPartitions("bucket", "part", "at")
    ordered.select("value", "bucket").write.partitionBy("bucket").text(path)
    return path


def deliver_xml(part: DataFrame) -> str:
    """One `part` element per row with two `attr` children, in a dated batch."""
    record = part.select(
        F.col("p_partkey").alias("_key"),
        F.col("p_brand").alias("_brand"),
        F.array(
            F.struct(F.col("p_type").alias("_VALUE"), F.lit("type").alias("_name")),
            F.struct(F.col("p_size").cast("string").alias("_VALUE"), F.lit("size").alias("_name")),
        ).alias("attr"),
        F.struct(F.col("p_name").alias("_VALUE"), F.lit("long").alias("_form")).alias("title"),
    )
    path = staging_path(part.sparkSession, "xml")
    root = f'batch date="{AS_OF_DATE}" source="parts"'
    record.write.format("xml").options(rowTag="part", rootTag=root, attributePrefix="_", valueTag="_VALUE").save(path)
    return path
