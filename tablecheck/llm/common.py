"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that parts words, as in `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of text that one call of a Python helper handles.
BATCH_BYTES = 4 << 20

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Lets Python workers on other machines import this library (once per application).

    The archive is a few hundred kilobytes of code; Spark copies it to the executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it runs from an archive that was shipped before
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        path = os.path.join(tempfile.mkdtemp(prefix="code-"), "tablecheck_code.zip")
        with open(path, "wb") as out:
            out.write(packed.getvalue())
        context.addPyFile(path)
    _shipped.add(context.applicationId)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that are needed, so that others can't clash; a NULL text is empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def in_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES):
    """The same rows in slices of about `most` bytes of one column, so that the work of a
    call depends on bytes and not on rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(batch.schema.get_field_index(column)).to_pylist()
        begin = held = 0
        for at, text in enumerate(sizes):
            held += len(text) if text is not None else 0
            if held >= most:
                yield batch.slice(begin, at + 1 - begin)
                begin, held = at + 1, 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


def in_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES):
    """As `in_batches`, by lengths that Arrow has, without making the values of a whole batch."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
        begin = held = 0
        for at, length in enumerate(lengths):
            held += length
            if held >= most:
                yield batch.slice(begin, at + 1 - begin)
                begin, held = at + 1, 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


def give_back() -> None:
    """Returns memory that is free to the system, as a worker goes on with other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(docs: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Applies `make()(ids, texts) -> dict of columns` to the (doc_id, text) rows of `docs`."""
    ship(docs.sparkSession)

    def run(batches):
        work = make()
        for batch in in_batches(batches):
            yield pa.RecordBatch.from_pydict(work(batch.column(0), batch.column(1).to_pylist()))

    return docs.mapInArrow(run, schema)
