"""Stage tables: Parquet between stages, CSV for exchange, vectors by business."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FOLDER = "vector_folder"


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir; a local one in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="reviewloom-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str) -> None:
    """Replace a stage table."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Export with a header; nested columns become JSON text.

    Quoted text may span lines, so a reader takes a file as a whole: files are kept small.
    """
    nested = (T.MapType, T.StructType, T.ArrayType)
    flat = df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    # blanks at the ends of a text belong to it
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    options = {"header": True, "escape": '"', "maxRecordsPerFile": rows_per_file, **blanks}
    flat.write.mode("overwrite").options(**options).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read exported CSV, whose quoted text may span lines."""
    options = {"header": True, "multiLine": True, "escape": '"', "mode": "FAILFAST"}
    return spark.read.schema(schema).options(**options).csv(path)


def _folder(key: Column, buckets: int | None) -> Column:
    if buckets is None:
        return key.cast("string")
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("string")


def write_vectors(
    df: DataFrame,
    path: str,
    key: str = "business_id",
    buckets: int | None = None,
    refresh: bool = False,
) -> None:
    """Store vectors with their metadata so that one business reads few files.

    A folder per business by default; with ``buckets`` the folders are hash buckets,
    for when businesses are many. REBALANCE lets AQE split a business that holds a
    large share of the rows over several files and merge small ones. ``refresh``
    replaces only the folders present in ``df``, otherwise the table is replaced.
    """
    (
        df.withColumn(_FOLDER, _folder(F.col(key), buckets))
        .hint("rebalance", _FOLDER)
        .sortWithinPartitions(_FOLDER, key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if refresh else "static")
        .partitionBy(_FOLDER)
        .parquet(path)
    )


def as_text(schema: T.StructType, *folders: str) -> T.StructType:
    """Folder names stay text: ids such as "007" must not turn into numbers."""
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in folders else f for f in schema])


def read_vectors(
    spark: SparkSession,
    path: str,
    business_id: str | None = None,
    key: str = "business_id",
    buckets: int | None = None,
) -> DataFrame:
    """The vector table, or one business of it; ``buckets`` as when it was written."""
    df = spark.read.schema(as_text(spark.read.parquet(path).schema, _FOLDER)).parquet(path)
    if business_id is not None:
        wanted = F.lit(business_id)
        df = df.filter((F.col(_FOLDER) == _folder(wanted, buckets)) & (F.col(key) == wanted))
    return df.drop(_FOLDER)


def write_bucketed(
    df: DataFrame, path: str, bucket_key: str, folder_key: str = "business_id", folders: int = 8, buckets: int | None = None
) -> DataFrame:
    """Store a table in hash folders of one key and, within them, in buckets of another, and read it back.

    A join on the bucket key finds the rows in place and shuffles only its other side, as
    long as there are no fewer buckets than shuffle partitions. A filter made by
    :func:`one_folder` reads a single folder. Rows meet their bucket before they are
    written, so there is one file for each folder and bucket.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df.withColumn(_FOLDER, _folder(F.col(folder_key), folders)).repartition(buckets, bucket_key)
    writer = rows.write.format("parquet").option("path", path).partitionBy(_FOLDER).bucketBy(buckets, bucket_key)
    writer.sortBy(bucket_key).saveAsTable(name)
    return spark.table(name)


def one_folder(df: DataFrame, value, folder_key: str = "business_id", folders: int = 8) -> DataFrame:
    """Rows of one key of a table of :func:`write_bucketed`; other folders are not read."""
    wanted = F.lit(value)
    return df.filter((F.col(_FOLDER) == _folder(wanted, folders)) & (F.col(folder_key) == wanted))


def file_blocks(counts: dict[int, int], most: int) -> list[tuple[int, int]]:
    """Ranges of file hashes that hold at most ``most`` rows each, or one file."""
    blocks, held = [], math.inf
    for file in sorted(counts):
        if held + counts[file] > most:
            blocks.append((file, file))
            held = 0
        blocks[-1] = (blocks[-1][0], file)
        held += counts[file]
    return blocks
