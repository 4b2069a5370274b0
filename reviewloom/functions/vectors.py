"""Vector column expressions. Sums run in double, in index order."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("ip", "cosine", "l2")
MAX_BUCKETS = 1 << 16  # the bucket is taken from 16 bits of the digest
TERM = "[a-zà-ÿ0-9]+"
#: Terms whose buckets a worker keeps (some 20 MB), and what it makes at a time: values of vectors, bytes of texts.
KNOWN_TERMS = 100_000
RUN_VALUES = 1 << 18
RUN_BYTES = 1 << 20


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside lambdas of ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_l2(a: Column, b: Column) -> Column:
    def term(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return _total(F.zip_with(a, b, term))


def norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def normalize(v: Column) -> Column:
    """Unit length as array<float>; the zero vector stays zero."""
    return let(
        norm(v),
        lambda n: F.transform(
            v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)).cast("float")
        ),
    )


def term_counts(text: Column, dim: int) -> Column:
    """Histogram of the md5 buckets of a text's terms: array<float> of length ``dim``.

    One pass over the terms in Arrow batches, whatever the dimension. Terms are
    lower-case runs of letters and digits; Spark lowers the text. What a worker holds
    beside the batch is bounded: short runs of texts, and a dictionary of short terms.
    """
    if not 0 < dim <= MAX_BUCKETS:
        raise ValueError(f"dim must be between 1 and {MAX_BUCKETS}, got {dim}")
    return F.arrow_udf(term_counter(dim), "array<float>")(F.lower(text))


def term_counter(
    dim: int, known: int = KNOWN_TERMS, values: int = RUN_VALUES, size: int = RUN_BYTES
) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """From batches of lowered texts to vectors, in runs of at most so many values and about so many bytes, or one text.

    A worker keeps the buckets of at most ``known`` terms of up to 32 characters.
    """
    pattern, most = TERM, max(1, min(values // dim, 1000))

    # defined here so that it travels by value and workers need no package
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ctypes

        find = re.compile(pattern).findall
        bucket: dict[str, int] = {}
        for batch in batches:
            start = 0
            while start < len(batch):
                part = batch.slice(start, most)
                while len(part) > 1 and part.nbytes > size:
                    part = part.slice(0, len(part) // 2)
                start += len(part)
                made = np.zeros((len(part), dim), np.float32)
                for row, lowered in enumerate(part.to_pylist()):
                    terms = find(lowered or "")
                    rare = {}
                    for t in set(terms).difference(bucket):
                        b = int(hashlib.md5(t.encode()).hexdigest()[:4], 16) % dim
                        (bucket if len(t) <= 32 else rare)[t] = b
                    at = [rare[t] if t in rare else bucket[t] for t in terms] if rare else map(bucket.__getitem__, terms)
                    made[row] = np.bincount(np.fromiter(at, np.int64, len(terms)), minlength=dim)
                    if len(bucket) > known:
                        bucket.clear()
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * np.int32(dim))
                yield pa.ListArray.from_arrays(ends, pa.array(made.ravel()))
        bucket.clear()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only: a worker lives on behind its task
        if trim is not None:
            trim(0)

    return count


def _cosine(product: Column, norms: Column) -> Column:
    return F.when(norms > 0, product / norms).otherwise(F.lit(0.0))


def similarity(v: Column, q: Column, metric: str) -> Column:
    """Score of two vector columns."""
    check_metric(metric)
    if metric == "l2":
        return squared_l2(v, q)
    if metric == "cosine":
        return _cosine(dot(v, q), norm(v) * norm(q))
    return dot(v, q)


def batch_scores(vectors: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Scores of all rows of vectors against all queries, rounded so that ranking does not
    hang on the last bits of float sums."""
    v, q = vectors.astype(np.float64), queries.astype(np.float64)
    if metric == "l2":
        # by differences: squares that cancel would cost digits
        found = np.stack([((v - one) ** 2).sum(axis=1) for one in q], axis=1)
    else:
        found = v @ q.T
        if metric == "cosine":
            norms = np.sqrt((v * v).sum(axis=1))[:, None] * np.sqrt((q * q).sum(axis=1))
            found = np.divide(found, norms, out=np.zeros_like(found), where=norms > 0)
    return np.rint(found * 1e9) / 1e9


def stable(score: Column, decimals: int = 9) -> Column:
    """Round so that ranking does not hang on the last bits of float sums."""
    scale = float(10**decimals)
    return F.rint(score * scale) / scale
