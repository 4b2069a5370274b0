"""Small reports used to look at the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.ranking import first_by, top_per_group
from reviewloom.operators.select import draw_order
from reviewloom.params import HISTOGRAM_EDGES, HISTOGRAM_LABELS


def count_histogram(
    df: DataFrame,
    key: str,
    item: str,
    edges: Sequence[int] = HISTOGRAM_EDGES,
    labels: Sequence[str] = HISTOGRAM_LABELS,
) -> DataFrame:
    """How many keys have a distinct-item count in each right-closed bin, empty bins too."""
    counts = df.groupBy(key).agg(F.count_distinct(item).alias("n"))
    uppers = [*edges[1:], None]
    bins = []
    for low, high, label in zip(edges, uppers, labels):
        inside = F.col("n") > low
        inside = inside if high is None else inside & (F.col("n") <= high)
        bins.append((label, F.count_if(inside)))
    row = counts.agg(*[n.alias(label) for label, n in bins])
    entries = [
        F.struct(F.lit(i).alias("bin"), F.lit(label).alias("label"), F.col(f"`{label}`").alias("n_keys"))
        for i, (label, _) in enumerate(bins)
    ]
    return row.select(F.inline(F.array(*entries)))


def counts_by_name(df: DataFrame, name: str, item: str) -> DataFrame:
    """Distinct items per name, most first."""
    counts = df.groupBy(name).agg(F.count_distinct(item).alias("n_items"))
    return counts.orderBy(F.desc("n_items"), F.asc(name))


def sample_per_stratum(
    df: DataFrame, stratum: str, key: str, n: int = 1, seed: int = 1
) -> DataFrame:
    """``n`` seeded random rows of every stratum; ``key`` identifies rows."""
    return top_per_group(df, [stratum], draw_order(key, seed), n, salts=16)


def distinct_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """The first row of every name."""
    return first_by(df, [name], [F.col(order)])


def union_batches(*batches: DataFrame) -> DataFrame:
    """Stack batches by column name; a column a batch lacks becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
