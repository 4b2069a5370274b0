"""Clean, normalize and deduplicate review text."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reviewloom.functions import text as T
from reviewloom.operators.ranking import first_by
from reviewloom.params import Params
from reviewloom.sources import tables

#: Places of dropped rows (a file and a row number) that one broadcast may hold: 64 MB of them.
BROADCAST_PLACES = 4 << 20


def clean_text(df: DataFrame, col: str = "text", min_chars: int = 30, nfkc: bool = True) -> DataFrame:
    """Strip, drop null and short text, replace characters, squeeze blanks, NFKC.

    Length is tested before blanks are squeezed, so a shorter result can remain.
    """
    kept = df.withColumn(col, T.strip(F.col(col).cast("string"))).filter(
        F.length(col) >= min_chars  # null is dropped here too
    )
    cleaned = kept.withColumn(col, T.replace_and_collapse(F.col(col)))
    return cleaned.withColumn(col, T.nfkc(F.col(col))) if nfkc else cleaned


def dedup_text(df: DataFrame, col: str = "text", order: str = "ordinal") -> DataFrame:
    """Keep the first row of every distinct text, over the whole table.

    Each map task keeps one row per text before the shuffle, so a text that makes
    up a third of the input reaches its reducer once per task. The hash leads the
    key only to make sorting cheap; equality is still decided on the text.
    """
    hashed = df.withColumn("_hash", F.xxhash64(col))
    return first_by(hashed, ["_hash", col], [F.col(order)]).drop("_hash")


def clean_dedup(df: DataFrame, params: Params = Params()) -> DataFrame:
    order = params.col_order if params.col_order in df.columns else params.col_review
    return dedup_text(clean_text(df, params.col_text, params.min_chars), params.col_text, order)


def _place() -> list[Column]:
    """File (hashed) and row number of a row of a stored table: unique, unlike ids."""
    return [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]


def repeated_places(
    stored: DataFrame, order: str, digest: str = "_digest", known: DataFrame | None = None
) -> DataFrame:
    """Places of all rows of a stored table but the first of each digest, and of those with a known digest too.

    Digests and places are all that moves. The first place per digest is an aggregate, so a
    text that makes up a third of the table meets its reducer as one row per task, and the
    rows that are no first place are found by place, which no two rows share.
    """
    rows = stored.select(digest, order, *_place())
    first = rows.groupBy(digest).agg(F.min(F.struct(order, "_file", "_row")).alias("first"))
    if known is not None:
        first = first.join(known.select(digest), digest, "left_anti")
    return rows.select("_file", "_row").join(first.select("first._file", "first._row"), ["_file", "_row"], "left_anti")


def without_places(stored: DataFrame, places: DataFrame, most: int = BROADCAST_PLACES) -> DataFrame:
    """A stored table without some of its rows, which are filtered where they are read.

    Places are broadcast to the scan of their files. If they are too many for one broadcast,
    the files are read in blocks of as many as one can hold, each with its own places, so no
    row of the table ever moves.
    """
    counts = {r["_file"]: r["count"] for r in places.groupBy("_file").count().collect()}  # a row per file

    def kept(part: DataFrame, drop: DataFrame) -> DataFrame:
        at = part.select("*", *_place())
        return at.join(F.broadcast(drop), ["_file", "_row"], "left_anti").select(*part.columns)

    if sum(counts.values()) <= most:
        return kept(stored, places)
    files = stored.select(F.col("_metadata.file_path").alias("path"), _place()[0]).distinct().collect()
    blocks = tables.file_blocks({r["_file"]: counts.get(r["_file"], 0) for r in files}, most)
    read = stored.sparkSession.read.schema(stored.schema)
    parts = [
        kept(
            read.parquet(*[unquote(r["path"]) for r in files if low <= r["_file"] <= high]),
            places.filter(F.col("_file").between(low, high)),
        )
        for low, high in blocks
    ]
    return reduce(DataFrame.unionAll, parts)


def stored_unique(
    cleaned: DataFrame,
    folder: str,
    col: str = "text",
    order: str = "ordinal",
    most: int = BROADCAST_PLACES,
    known: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """Write a table once and keep the first row of every distinct text; also the number of rows dropped.

    Texts whose ``_digest`` is in ``known`` are dropped with all their rows.

    No text is shuffled or sorted: texts stay in the files they were written to, and the
    256-bit digests beside them decide. ``order`` need not be unique.
    """
    spark = cleaned.sparkSession
    tables.write_table(cleaned.withColumn("_digest", F.unhex(F.sha2(col, 256))), f"{folder}/clean")
    stored = tables.read_table(spark, f"{folder}/clean")
    tables.write_table(repeated_places(stored, order, known=known), f"{folder}/repeated")
    places = tables.read_table(spark, f"{folder}/repeated")
    return without_places(stored, places, most).drop("_digest"), places.count()


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the job that reads ``df``."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def clean_stage(df: DataFrame, folder: str, params: Params = Params()) -> tuple[DataFrame, dict[str, int]]:
    """Clean and deduplicate by way of a stored table, and count what is dropped while it is written."""
    from reviewloom.operators.quality import observed

    order = params.col_order if params.col_order in df.columns else params.col_review
    seen, n_input = observed(df, "input")
    cleaned, n_clean = observed(clean_text(seen, params.col_text, params.min_chars), "clean")
    unique, repeated = stored_unique(cleaned, folder, params.col_text, order)
    counts = {"n_input": n_input.get["rows"], "n_clean": n_clean.get["rows"]}
    return unique, counts | {"n_unique": counts["n_clean"] - repeated}
