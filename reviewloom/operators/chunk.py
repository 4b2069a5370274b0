"""Split text into overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.vectors import let
from reviewloom.params import Params


def _sliding(text: Column, size: int, overlap: int, min_size: int) -> Column:
    """Chunks of ``size`` that start every ``size - overlap`` characters.

    Chunk 0 starts at 0; chunk i > 0 starts ``overlap`` before i * step, and exists
    while the text from there on is longer than ``min_size``. The text is cut into
    pieces of one step in a single pass and each chunk is a piece plus the end of
    the piece before it: linear in the text, where a substring per chunk would
    walk from the start every time. An overlap longer than a step takes the ends of
    several pieces.
    """
    step = size - overlap
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))

    reach = max(1, -(-overlap // step))  # pieces that an overlap can touch

    def pieces_from(all_: Column, i: Column, n: Column | int) -> Column:
        return F.array_join(F.slice(all_, i + 1, n), "")

    def chunk(p: Column, i: Column, all_: Column) -> Column:
        head = F.concat(p, F.left(pieces_from(all_, i + 1, reach), F.lit(overlap)))
        first = F.greatest(i - reach, F.lit(0))
        later = F.concat(F.right(pieces_from(all_, first, i - first), F.lit(overlap)), p)
        return F.when(i == 0, head).otherwise(later)

    def split(n: Column) -> Column:
        def numbered(all_: Column) -> Column:
            made = F.transform(
                all_,
                lambda p, i: F.struct(i.alias("chunk_index"), chunk(p, i, all_).alias("chunk")),
            )
            return F.filter(
                made,
                lambda c: (c["chunk_index"] == 0)
                | (n - c["chunk_index"] * step + overlap > min_size),
            )

        return let(pieces, numbered)

    return F.when(F.length(text) > size, let(F.length(text), split)).otherwise(_whole(text))


def _whole(text: Column) -> Column:
    """The text as its only chunk; null, hence no row, when it is empty."""
    return F.when(
        text != "", F.array(F.struct(F.lit(0).alias("chunk_index"), text.alias("chunk")))
    )


def chunk_array(
    text: Column, size: int = 1000, overlap: int = 200, min_size: int = 230, mode: str = "sliding"
) -> Column:
    """Array of (chunk_index, chunk). Mode "first" yields only the leading chunk."""
    if mode == "first":
        return _whole(F.left(text, F.lit(size)))
    if mode != "sliding":
        raise ValueError(f"mode must be 'sliding' or 'first', got {mode!r}")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    return _sliding(text, size, overlap, min_size)


def chunk(
    df: DataFrame,
    col: str = "text",
    size: int = 1000,
    overlap: int = 200,
    min_size: int = 230,
    mode: str = "sliding",
) -> DataFrame:
    """One row per chunk in place of ``col``; empty text has no chunk.

    Empty text is not filtered beforehand: Spark would push such a filter below the
    cleaning and run its Python step twice.
    """
    chunks = chunk_array(F.col(col), size, overlap, min_size, mode)
    return df.select(*[c for c in df.columns if c != col], F.inline(chunks))


def review_chunks(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Chunks with the review's metadata, in the stage-table layout.

    ``chunk_id`` is for display: it repeats when a review id does. ``chunk_key`` is
    unique among texts that are unique, as they are after deduplication.
    """
    p = params
    narrow = df.select(
        F.md5(p.col_text).alias("text_key"),
        F.col(p.col_entity).alias("business_id"),
        F.col(p.col_review).alias("review_id"),
        F.col(p.col_name).alias("restaurant_name"),
        F.col(p.col_stars).alias("stars"),
        F.col(p.col_date).alias("date"),
        F.col(p.col_text).alias("text"),
    )
    return chunk(narrow, "text", p.chunk_size, p.overlap, p.min_chunk, p.chunk_mode).select(
        "chunk_index",
        "chunk",
        "business_id",
        "review_id",
        "restaurant_name",
        F.concat_ws("_", "review_id", "chunk_index").alias("chunk_id"),
        F.length("chunk").alias("n_chars"),
        "stars",
        "date",
        F.concat_ws("_", "text_key", "chunk_index").alias("chunk_key"),
    )
