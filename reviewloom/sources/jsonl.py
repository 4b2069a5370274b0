"""JSON Lines input."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.ranking import row_bytes

CORRUPT = "_corrupt"
#: Bytes of rows that one task sorts and writes as a file, about.
FILE_BYTES = 64 << 20
#: Keys that are drawn for a file, and for all files, to find where files start.
FILE_KEYS, MOST_KEYS = 256, 1_000_000


def write_jsonl(df: DataFrame, path: str, order: str, least: int = 4) -> None:
    """Write JSON Lines, files and lines in ascending ``order``, a column that is not written itself.

    Files take about equally many bytes, wherever the long rows lie, and their number follows the
    measured bytes, so what a task holds does not grow with the input; only rows that repeat an
    ``order`` stay in one file. There are at least ``least`` files if the rows suffice.
    """
    starts = file_starts(df, order, least)
    n_starts = len(starts["_starts"][0])
    known = F.broadcast(df.sparkSession.createDataFrame(starts))
    steps = F.array(*[F.lit(1 << i) for i in range(n_starts.bit_length(), -1, -1)])
    # a binary search: how many starts are not above the row
    file = F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(F.get("_starts", n + step - 1) <= F.col(order), n + step).otherwise(n),
    )
    rows = df.crossJoin(known).withColumn("_file", file).drop("_starts")
    dealt = rows.repartitionById(n_starts + 1, "_file")
    dealt.sortWithinPartitions(order).drop(order, "_file").write.json(path)


def file_starts(df: DataFrame, order: str, least: int) -> pa.Table:
    """One row of the ascending values of ``order`` at which new files start, so that these take about equally many bytes.

    A row gives its key once for every so many of its bytes, the rest decided by the key's
    hash. This draws keys for the starts only; every row is measured, and every row is written.
    """
    size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    files = max(least, -(-size // FILE_BYTES))
    per_file = max(1, min(FILE_KEYS, MOST_KEYS // files))
    chance = F.pmod(F.xxhash64(order), F.lit(1 << 20)) / (1 << 20)
    times = F.floor(row_bytes(df) * (per_file * files) / max(size, 1) + chance).cast("int")
    drawn = df.select(F.explode(F.array_repeat(F.col(order), times)).alias("key"))
    every = F.filter(F.sort_array(F.collect_list("key")), lambda _, i: (i > 0) & (i % per_file == 0))
    return drawn.agg(F.array_distinct(every).alias("_starts")).toArrow()


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType, head: int | None = None
) -> DataFrame:
    """Read a JSON Lines file or folder; a malformed line fails the job.

    ``ordinal`` (file, split, position) orders rows as in the files, with or without
    ``head``, which keeps the first lines only. Blank lines are skipped.
    """
    lines = ordered_lines(spark, path) if head is None else head_lines(spark, path, head)
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    rows = lines.filter(F.trim("value") != "").select("ordinal", parsed.alias("row"))
    return rows.select("row.*", "ordinal")


def read_jsonl_lenient(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines) instead of a failure."""
    with_raw = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select("value", F.from_json("value", with_raw, options).alias("row"))
    bad = F.col(f"row.{CORRUPT}").isNotNull()
    good = parsed.filter(~bad).select("row.*").drop(CORRUPT)
    return good, parsed.filter(bad).select(F.col("value").alias("line"))


def ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with ``ordinal``, which orders them by file, split of the file, and place in it.

    It costs no pass over the data: a task reads each of its splits in order, so the
    task's own row numbers order the lines of a split.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
    )
    return spark.read.text(path).select("value", place.alias("ordinal"))


def head_lines(spark: SparkSession, path: str, n: int, files_at_once: int = 1000) -> DataFrame:
    """The first ``n`` lines of a text input, in file order, with their ``ordinal``.

    One job counts the lines of every split of the first files and adds the counts up in
    the order of files and splits; only the split that holds line n comes to the driver. If
    these files are not enough, the next job takes 16 times as many, so all lines of a large
    input are not counted for the sake of a few.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if n <= 0 or not files:
        return ordered_lines(spark, path).limit(0)
    before = taken = 0
    while taken < len(files):
        some = files[taken : taken + files_at_once]
        at = F.col("ordinal")
        splits = ordered_lines(spark, some).groupBy(at["file"].alias("file"), at["start"].alias("start")).agg(
            F.min(at["position"]).alias("first"), F.count("*").alias("n")
        )
        upto = F.sum("n").over(Window.orderBy("file", "start")) + before  # a row per split
        ends = splits.withColumn("upto", upto)
        cut = F.min(F.when(F.col("upto") >= n, F.struct("file", "start", "first", "n", "upto"))).alias("cut")
        found = ends.agg(cut, F.max("upto").alias("upto")).first()
        if found["cut"] is not None:
            c = found["cut"]
            # row numbers hold within one read of files, so the last files are read as they were counted
            inside = (at["start"] == c["start"]) & (at["position"] < c["first"] + c["n"] - (c["upto"] - n))
            upto = (at["file"] < c["file"]) | (at["file"] == c["file"]) & ((at["start"] < c["start"]) | inside)
            last = ordered_lines(spark, some).filter(upto)
            return ordered_lines(spark, files[:taken]).unionAll(last) if taken else last
        before = found["upto"] or before
        taken, files_at_once = taken + len(some), 16 * files_at_once
    return ordered_lines(spark, path)
