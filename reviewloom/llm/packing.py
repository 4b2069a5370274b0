"""Best-fit packing of documents into token sequences, by large-item matching.

A document is its ids and an end id. One that is longer than a sequence is cut
into full pieces behind a first piece that may be shorter. Pieces are whole
numbers of tokens, so how many there are of each length says all that packing
needs: a histogram of at most `capacity` counts is packed on the driver, at a cost
that does not grow with the documents.

- Full pieces fill sequences of their own.
- Pieces above a third of the capacity: the longest is paired with the longest
  that still fits beside it; no sequence holds more than two of them.
- Shorter pieces, longest first, go where they leave the smallest gap, else into
  a new sequence.

The result is a list of patterns, each with its number of sequences. A pattern's
places are dealt to pieces by their rank among the pieces of their length. Ranks
are counted inside small blocks and moved up by the sizes of the blocks before,
so a length that half of all pieces share is never in one task.

Null text counts as empty: such a document is one piece, the end id. Rows with
equal doc_id, or none, are packed as rows of their own. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm import bpe, common

CAPACITY = 1024
END_ID = 2
#: Pieces whose ranks are counted in one task at a time, about.
BLOCK = 500_000


@dataclass
class Pattern:
    """So many sequences of these piece lengths, in order."""

    lengths: tuple[int, ...]
    number: int


def pair_large(counts: Counter[int], capacity: int) -> Counter[tuple[int, ...]]:
    """Greedy matching: the longest with the longest partner that fits, else alone."""
    large = sorted((n for n in counts if counts[n] and 3 * n > capacity), reverse=True)
    out: Counter[tuple[int, ...]] = Counter()
    for a in large:
        while counts[a]:
            b = next((n for n in large if n <= capacity - a and counts[n] > (n == a)), None)
            if b is None:
                out[(a,)] += counts[a]
                counts[a] = 0
            else:
                n = counts[a] // 2 if a == b else min(counts[a], counts[b])
                out[(a, b)] += n
                counts[a] -= n
                counts[b] -= n
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold `counts[n]` pieces of each length n."""
    rest = Counter({n: c for n, c in counts.items() if n < capacity})
    made: Counter[tuple[int, ...]] = Counter()
    if counts.get(capacity):
        made[(capacity,)] = counts[capacity]
    by_gap: dict[int, Counter[tuple[int, ...]]] = {}
    for lengths, n in pair_large(rest, capacity).items():
        by_gap.setdefault(capacity - sum(lengths), Counter())[lengths] += n
    gaps = sorted(by_gap)
    for n in sorted((n for n in rest if rest[n]), reverse=True):
        while rest[n]:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):  # no sequence has room: new ones, filled with this length
                each = min(capacity // n, rest[n])
                lengths, number = (n,) * each, rest[n] // each
                gap = capacity - n * each
            else:
                old = gaps[at]
                base, have = next(iter(by_gap[old].items()))
                each = min(old // n, rest[n])
                lengths, number = (*base, *(n,) * each), min(have, rest[n] // each)
                gap = old - n * each
                by_gap[old][base] -= number
                if not by_gap[old][base]:
                    del by_gap[old][base]
                if not by_gap[old]:
                    del by_gap[old], gaps[at]
            rest[n] -= number * each
            if gap not in by_gap:
                by_gap[gap] = Counter()
                bisect.insort(gaps, gap)
            by_gap[gap][lengths] += number
    for group in by_gap.values():
        made.update(group)
    return [Pattern(lengths, n) for lengths, n in sorted(made.items()) if n]


def cut(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = total % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def tokenized_pieces(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    max_words: int = bpe.MAX_WORDS,
    rows_at_once: int = bpe.ROWS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32. Fewer words and rows at once take less memory and more time."""

    def make() -> Callable[..., list[tuple]]:
        codec = bpe.Codec(path or bpe.public_path(), max_words)
        end = np.array([end_id], "<u4").tobytes()

        def rows(doc_ids: list, texts: list) -> list[tuple]:
            out = []
            for doc_id, ids in zip(doc_ids, codec.encode_batch([t or "" for t in texts])):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc_id, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
            return out

        return rows

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return common.map_batches(docs.select("doc_id", "text"), make, schema, rows_at_once)


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Adds `at`: a piece's rank, from 0, among those of its length.

    Blocks are hash buckets of a length; their number follows the total. Equal
    rows of equal pieces get different ranks in either order, which changes nothing.
    """
    blocks = max(1, -(-total // BLOCK)) * 8
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(blocks)))
    sizes = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    placed = pieces.withColumn("in_block", F.row_number().over(inside) - 1)
    return placed.join(sizes, ["length", "block"]).withColumn("at", F.col("first") + F.col("in_block"))


def places(patterns: list[Pattern]) -> dict[int, list[np.ndarray]]:
    """For each length: first rank, first sequence and offset of its runs of places, in order of rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter[int] = Counter()
    sequence = 0
    for p in patterns:
        offset = 0
        for n in p.lengths:
            runs.setdefault(n, []).append((used[n], sequence, offset))
            used[n] += p.number
            offset += n
        sequence += p.number
    return {n: [np.array(c, np.int64) for c in zip(*r)] for n, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to doc_id, piece, start, length, ids_crc32.

    The pieces are read three times; give a written table.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = places(plan(counts, capacity))

    def make() -> Callable[..., list[tuple]]:
        def rows(doc_ids: list, piece: list, start: list, length: list, crc: list, at: list) -> list[tuple]:
            out = []
            for d, p, s, n, c, r in zip(doc_ids, piece, start, length, crc, at):
                first, sequence, offset = runs[n]
                k = int(np.searchsorted(first, r, "right")) - 1
                out.append((d, p, s, n, c, int(sequence[k] + r - first[k]), int(offset[k])))
            return out

        return rows

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return common.map_batches(ranked(pieces, sum(counts.values())).select(*columns, "at"), make, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, **memory: int) -> DataFrame:
    """Tokenize once into a written table of pieces, then pack that; `memory` as in `tokenized_pieces`."""
    return pack(common.kept_table(tokenized_pieces(docs, path, capacity, **memory)), capacity)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(common.table(spark, folder, "documents"))
