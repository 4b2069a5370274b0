"""Turn text into vectors with an exchangeable embedder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from reviewloom.functions import vectors as V


class Embedder(Protocol):
    def add_vectors(self, df: DataFrame, text_col: str, out: str) -> DataFrame: ...


class HashedTermEmbedder:
    """Term counts in ``dim`` md5 buckets. Lexical only; time does not depend on ``dim``."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def column(self, text: Column) -> Column:
        return V.term_counts(text, self.dim)

    def add_vectors(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        return df.withColumn(out, self.column(F.col(text_col)))


class PrecomputedEmbedder:
    """Vectors from a table, matched on a key column."""

    def __init__(self, vectors: DataFrame, key: str, vector_col: str = "embedding"):
        self.vectors, self.key, self.vector_col = vectors, key, vector_col

    def add_vectors(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        return df.join(self.vectors.select(self.key, F.col(self.vector_col).alias(out)), self.key)


class ModelEmbedder:
    """A user model: ``factory()`` returns ``encode(list[str]) -> 2-D array``.

    The model is built once per task and sees at most ``batch_size`` texts at a
    time; only the text column travels to Python.
    """

    def __init__(self, factory: Callable[[], Callable[[list[str]], Any]], batch_size: int = 64):
        self.factory, self.batch_size = factory, batch_size

    def column(self, text: Column) -> Column:
        factory, size = self.factory, self.batch_size

        @F.pandas_udf(ArrayType(FloatType()))
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = factory()
            for batch in batches:
                texts = batch.tolist()
                rows: list[np.ndarray] = []
                for start in range(0, len(texts), size):
                    rows.extend(np.asarray(model(texts[start : start + size]), dtype=np.float32))
                yield pd.Series(rows, dtype=object)

        return encode(text)

    def add_vectors(self, df: DataFrame, text_col: str, out: str) -> DataFrame:
        return df.withColumn(out, self.column(F.col(text_col)))


def embed(
    df: DataFrame,
    text_col: str,
    embedder: Embedder | None = None,
    out: str = "embedding",
    normalize: bool = True,
) -> DataFrame:
    """Add an array<float> column with the vector of ``text_col``."""
    vectors = (embedder or HashedTermEmbedder()).add_vectors(df, text_col, out)
    made = F.col(out)
    return vectors.withColumn(out, V.normalize(made) if normalize else made.cast("array<float>"))


def topic_table(spark, topics: dict[str, str]) -> DataFrame:
    """The query set as (topic, keywords), local to the plan."""
    columns = {"topic": list(topics), "keywords": list(topics.values())}
    return spark.createDataFrame(pa.table(columns))


def embed_topics(topics: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """(topic, qvec); query vectors always have unit length."""
    return embed(topics, "keywords", embedder, "qvec").select("topic", "qvec")
