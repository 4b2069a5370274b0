"""Short codes for vectors: one codebook entry per part, fitted by Lloyd's rounds on whole numbers.

Every part of a vector keeps its entry and its exact squared distance from round to round. A
part whose entry did not move is compared with the moved entries only, as all others are where
they were; a part whose entry moved is compared with all entries. Both give the nearest entry,
the lower index among equals.

Vectors that are null or hold null or non-finite components are dropped. Vectors of unequal
length, empty ones among them, are filled up with zeros to the longest, which is filled up to a
multiple of the parts. Null ids come last in the order of ids, and repeated ids are ordered by
their vectors; all such rows get codes. With fewer rows than entries the codebooks are shorter.
An empty table gives no rows. Whole numbers of 2^25 and more fail the job, as their squared
distances might not be exact. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common
from reviewloom.llm.common import slices

LIMIT = 1 << 25
STATE = "vec_id bigint, label int, v binary, code binary, error binary"


@dataclass(frozen=True)
class Settings:
    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    batch: int = 2048


def whole_numbers(vectors: DataFrame, s: Settings) -> DataFrame:
    """Rows (vec_id, label, w) of the vectors that count."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * s.scale))
    return vectors.filter(x.isNotNull() & ~bad).select("vec_id", "label", scaled.alias("w"))


def widest(rows: DataFrame, s: Settings) -> int:
    """Components of a filled-up vector."""
    found = rows.agg(
        F.max(F.size("w")).alias("n"), F.max(F.greatest(F.abs(F.array_max("w")), F.abs(F.array_min("w")))).alias("top")
    ).first()
    if (found["top"] or 0) >= LIMIT:
        raise ValueError(f"whole numbers of {LIMIT} and more are not supported, found {found['top']}")
    return -(-(found["n"] or 0) // s.parts) * s.parts


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of one width."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = flat
    return out


def parts_of(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """Stored vectors as (row, part, component)."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.int32)
    return flat.reshape(len(column), parts, width // parts).astype(np.int64)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (row, entry) of one part position."""
    gaps = x[:, None, :] - book[None, :, :]
    return np.einsum("nek,nek->ne", gaps, gaps)


def assign(x: np.ndarray, books: np.ndarray, moved: np.ndarray, code: np.ndarray | None, error: np.ndarray | None):
    """Nearest entries of (row, part, component) in books (part, entry, component), from the last ones if there are any."""
    n, parts = x.shape[:2]
    new_code, new_error = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
    for p in range(parts):
        again = np.ones(n, bool) if code is None else moved[p][code[:, p]]
        whole = np.flatnonzero(again)
        if len(whole):
            d = distances(x[whole, p], books[p])
            best = d.argmin(axis=1)  # the first of equals
            new_code[whole, p], new_error[whole, p] = best, d[np.arange(len(whole)), best]
        kept = np.flatnonzero(~again)
        if not len(kept):
            continue
        was, far = code[kept, p], error[kept, p]
        entries = np.flatnonzero(moved[p])
        if len(entries):
            d = distances(x[kept, p], books[p][entries])
            best = d.argmin(axis=1)
            near, entry = d[np.arange(len(kept)), best], entries[best]
            better = (near < far) | ((near == far) & (entry < was))
            was, far = np.where(better, entry, was), np.where(better, near, far)
        new_code[kept, p], new_error[kept, p] = was, far
    return new_code, new_error


def blobs(a: np.ndarray) -> pa.Array:
    """Every row of a matrix as bytes."""
    a = np.ascontiguousarray(a)
    offsets = np.arange(len(a) + 1, dtype=np.int32) * (a.shape[1] * a.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(a.tobytes())])


def assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray, width: int, s: Settings) -> DataFrame:
    """One pass: vectors (v) with the codes and errors that these codebooks give."""
    first = "code" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, s.batch):
                x = parts_of(batch["v"], width, s.parts)
                code = error = None
                if not first:
                    code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, s.parts)
                    error = np.frombuffer(b"".join(batch["error"].to_pylist()), np.int64).reshape(-1, s.parts)
                code, error = assign(x, books, moved, code, error)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["label"], batch["v"], blobs(code), blobs(error)],
                    names=["vec_id", "label", "v", "code", "error"],
                )

    return rows.mapInArrow(run, STATE)


def sums(state: DataFrame, width: int, s: Settings) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sums of the parts at every entry; at most parts x entries rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((s.parts, s.entries, width // s.parts), np.int64)
        count = np.zeros((s.parts, s.entries), np.int64)
        for whole in batches:
            for batch in slices(whole, s.batch):
                x = parts_of(batch["v"], width, s.parts)
                code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, s.parts)
                for p in range(s.parts):
                    np.add.at(total[p], code[:, p], x[:, p])
                    count[p] += np.bincount(code[:, p], minlength=s.entries)
        used = np.argwhere(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0].astype(np.int32)), pa.array(used[:, 1].astype(np.int32)), pa.array(count[tuple(used.T)]),
             pa.array(list(total[tuple(used.T)]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    tasks = state.select("v", "code").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width // s.parts)]
    found = tasks.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(r[f"s{i}"]) for i in range(width // s.parts)]) for r in found}


def moved_books(books: np.ndarray, found: dict[tuple[int, int], tuple[int, list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the means, and which entries differ from before."""
    new = books.copy()
    for (p, e), (n, totals) in found.items():
        new[p, e] = [t // n for t in totals]
    return new, (new != books).any(axis=2)


def fit(vectors: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """All vectors with their final codes and errors, and the codebooks.

    The rounds write two tables in turn, so the disk holds the last state and the next one.
    """
    rows = whole_numbers(vectors, s)
    width = widest(rows, s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, s.batch):
                v = blobs(matrix(batch["w"], width).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], v], names=["vec_id", "label", "v"])

    packed = rows.mapInArrow(run, "vec_id bigint, label int, v binary")
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "w").limit(s.entries).toArrow()
    first = matrix(seeds["w"].combine_chunks(), width)
    books = first.reshape(len(first), s.parts, width // s.parts).transpose(1, 0, 2).copy()
    moved = np.ones(books.shape[:2], bool)
    turns = [common.shared_folder(vectors.sparkSession) for _ in range(2)]
    state = packed
    if not len(first):
        return assigned(packed, np.zeros((s.parts, 1, width // s.parts), np.int64), moved, width, s), books
    for i in range(s.rounds):
        assigned(state, books, moved, width, s).write.mode("overwrite").parquet(turns[i % 2])
        state = vectors.sparkSession.read.schema(STATE).parquet(turns[i % 2])
        books, moved = moved_books(books, sums(state, width, s))
    return common.kept_table(assigned(state, books, moved, width, s).drop("v")), books


def with_label_errors(rows: DataFrame, error: Column) -> DataFrame:
    """Adds the errors summed over equal labels, null being one of them.

    Beyond what may be broadcast, each label's sum is repeated for 16 shares of its rows.
    """
    rows = rows.withColumns({"_e": error, "_l": F.struct("label")})
    totals = common.kept_table(rows.groupBy("_l").agg(F.sum("_e").alias("label_error")))
    if totals.limit(common.SMALL_ROWS + 1).count() <= common.SMALL_ROWS:
        return rows.join(F.broadcast(totals), "_l")
    shares = totals.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return rows.withColumn("_share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(16)).cast("int")).join(shares, ["_l", "_share"])


def unpacked(rows: DataFrame) -> DataFrame:
    """(vec_id, label, code as hex, error summed over the parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = [int(np.frombuffer(e, np.int64).sum()) for e in batch["error"].to_pylist()]
            code = [c.hex() for c in batch["code"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(code, pa.string()), pa.array(total, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return rows.mapInArrow(run, "vec_id bigint, label int, code string, error bigint")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and codebooks of all stored vectors."""
    rows, books = fit(common.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    out = with_label_errors(unpacked(rows), F.col("error"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
