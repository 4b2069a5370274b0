"""Clean and chunk review files as they arrive.

These steps look at one row at a time, so they need no state or watermark. What
compares rows (deduplication, ranking) stays with the batch jobs that read the
chunk table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from reviewloom.operators.chunk import review_chunks
from reviewloom.operators.clean import clean_text
from reviewloom.params import Params


def append_chunks(
    reviews: DataFrame, path: str, checkpoint: str, params: Params = Params()
) -> StreamingQuery:
    """Append the chunks of all files not seen before, then stop."""
    cleaned = clean_text(reviews, params.col_text, params.min_chars)
    return (
        review_chunks(cleaned, params)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
