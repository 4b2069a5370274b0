"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of a table that may be broadcast; callers multiply by a bounded row width.
SMALL_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder all executors share; one of this machine only in local mode (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def kept_table(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast if the written table has few rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, _row, so that columns added beside it clash with none of them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")


def map_batches(
    df: DataFrame, make: Callable[[], Callable[..., list[tuple]]], schema: str, rows: int = 500
) -> DataFrame:
    """Apply a Python function to short runs of rows, in Arrow batches.

    make() runs once per task and returns a function from the columns of a run, as
    lists in the order of df's columns, to a list of tuples in the order of the schema.
    """
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what other kinds of tasks left
        fn = make()
        try:
            for batch in batches:
                for part in slices(batch, rows):
                    yield to_batch(fn(*(c.to_pylist() for c in part.columns)), arrow)
        finally:
            del fn
            give_back()

    return df.mapInArrow(run, out)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """As map_batches, with a function from the values of a row to a tuple."""

    def make_batch() -> Callable[..., list[tuple]]:
        fn = make()
        return lambda *columns: [fn(*row) for row in zip(*columns, strict=True)]

    return map_batches(df, make_batch, schema)


def slices(batch: pa.RecordBatch, rows: int = 500, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, of about `size` bytes or one row, so that Python holds few decoded values at a time."""
    start = 0
    while start < batch.num_rows:
        part = batch.slice(start, rows)
        while part.num_rows > 1 and part.nbytes > size:
            part = batch.slice(start, part.num_rows // 2)
        yield part
        start += part.num_rows


def array_slices(values: pa.Array, rows: int) -> Iterator[pa.Array]:
    """As slices, of one column."""
    batch = pa.RecordBatch.from_arrays([values], names=["values"])
    return (part.column(0) for part in slices(batch, rows))


def give_back() -> None:
    """Return freed memory to the system: a worker process lives on behind its task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def to_batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
    )
