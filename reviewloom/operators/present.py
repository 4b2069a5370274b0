"""The summary table as a reader sees it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import text as T
from reviewloom.operators.ranking import first_by
from reviewloom.params import MISSING_SUMMARY, TOPICS


def require_columns(df: DataFrame, expected: Sequence[str], what: str = "input") -> DataFrame:
    """Fail before any job when a column is missing."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df


def summary_view(
    df: DataFrame, topics: Sequence[str] = tuple(TOPICS), order: str | None = None
) -> DataFrame:
    """Stripped unique names in order, with a fallback text for missing summaries.

    Of rows with one name the first by ``order`` stays (default: by the texts).
    """
    require_columns(df, ["restaurant_name", *topics], "summaries")
    named = df.withColumn(
        "restaurant_name", T.strip(F.col("restaurant_name").cast("string"))
    ).filter(F.col("restaurant_name").isNotNull())
    tie = [F.asc_nulls_last(c) for c in ([order] if order else topics)]
    return (
        first_by(named, ["restaurant_name"], tie)
        .select(
            "restaurant_name",
            *[
                F.coalesce(t, T.fill(MISSING_SUMMARY, topic=t)).alias(t)
                for t in topics
            ],
        )
        .orderBy("restaurant_name")
    )


def lookup(view: DataFrame, name) -> DataFrame:
    """The row of one name (a value or a scalar subquery)."""
    return view.filter(F.col("restaurant_name") == name)
