"""Join reviews with businesses and choose the entities to report on."""

from __future__ import annotations

import math
import secrets
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.ranking import hint_measured, hint_small
from reviewloom.params import SUFFIXES, Params


def drop_nulls(df: DataFrame, policy: str = "any", required: Sequence[str] = ()) -> DataFrame:
    """Drop rows with a null (or NaN) in any column, or only in ``required`` ones."""
    if policy == "any":
        return df.na.drop("any")
    if policy == "required":
        return df.na.drop("any", subset=[c for c in required if c in df.columns])
    raise ValueError(f"null_policy must be 'any' or 'required', got {policy!r}")


def suffix_shared(
    left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str] = SUFFIXES
) -> tuple[DataFrame, DataFrame]:
    """Rename the non-key columns both sides have."""
    shared = (set(left.columns) & set(right.columns)) - {on}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c in shared})

    return renamed(left, suffixes[0]), renamed(right, suffixes[1])


def join_entities(
    reviews: DataFrame,
    businesses: DataFrame,
    on: str = "business_id",
    suffixes: tuple[str, str] = SUFFIXES,
    null_policy: str = "any",
    required: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Inner join without nulls.

    "No null in any joined column" equals "no null on either side" for an inner
    join, so nulls go before the shuffle rather than after it. With ``parts``, the number
    of partitions to spread over, keys with many reviews are looked for and cut into shares.
    """
    left, right = suffix_shared(reviews, businesses, on, suffixes)
    left = drop_nulls(left, null_policy, [on, *required])
    right = drop_nulls(right, null_policy, [on, *required])
    return left.join(right, on, "inner") if parts is None else salted_join(left, right, on, heavy_keys(left, on, parts))


def heavy_keys(df: DataFrame, key: str, parts: int, tracked: int = 10_000) -> dict[str, int]:
    """Keys that may hold more than half a part of the rows, with the shares to cut each into.

    One pass over the key column fills a frequent-items sketch of bounded size per task;
    sketches are merged. No more than 2 x ``parts`` keys can hold as much, and no such key is
    missed while ``tracked`` is well above that. Counts of a sketch are at least the true ones.
    """
    tracked = max(tracked, 8 * parts)
    # the items of a sketch have a plain type; their text tells keys of any type apart
    text = F.col(key).cast("string")
    sketch = F.expr(f"approx_top_k(`_text`, {min(2 * parts, 10_000)}, {min(tracked, 1_000_000)})")
    found = df.select(text.alias("_text")).filter("_text IS NOT NULL").agg(F.count("*").alias("n"), sketch.alias("top")).first()
    fair = max(1.0, found["n"] / parts)
    return {r["item"]: math.ceil(4 * r["count"] / fair) for r in found["top"] or [] if r["count"] > fair / 2}


def salted_join(left: DataFrame, right: DataFrame, on: str, heavy: dict[str, int]) -> DataFrame:
    """Inner join that cuts the rows of heavy keys on the left into shares.

    Rows of such keys on the right are repeated for each share; all other rows have share 0.
    Shares follow the row numbers of map tasks, so they are even; there are several for each
    partition, as some meet again by their hash.
    """
    if not heavy:
        return left.join(right, on)
    shares = left.sparkSession.createDataFrame(list(heavy.items()), "_heavy string, _shares int")

    def counted(df: DataFrame) -> DataFrame:
        looked_up = df.join(F.broadcast(shares), F.col(on).cast("string") == F.col("_heavy"), "left")
        return looked_up.withColumn("_shares", F.coalesce("_shares", F.lit(1))).drop("_heavy")

    dealt = counted(left).withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.col("_shares")).cast("int"))
    repeated = counted(right).withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    return dealt.drop("_shares").join(repeated.drop("_shares"), [on, "_share"]).drop("_share")


def category_filter(df: DataFrame, col: str, include: str, exclude: str) -> DataFrame:
    """Keep rows whose lower-cased category has ``include`` and no ``exclude`` match."""
    category = F.lower(F.col(col))
    return df.filter(category.contains(include) & ~category.rlike(exclude))


def eligible_keys(df: DataFrame, key: str, item: str, min_items: int) -> DataFrame:
    """Keys with strictly more than ``min_items`` distinct items."""
    counts = df.groupBy(key).agg(F.count_distinct(item).alias("n_items"))
    return counts.filter(F.col("n_items") > min_items)


def draw_order(key: str, seed: int) -> list[Column]:
    """A seeded random order that no partitioning can change."""
    text = F.col(key).cast("string")
    return [F.md5(F.concat(F.lit(f"{seed}:"), text)), F.col(key)]


def sample_keys(
    keys: DataFrame, key: str, n: int | None, seed: int | None = 1, strict: bool = False
) -> DataFrame:
    """``n`` keys in seeded order, all if it is None; ``strict`` fails when fewer exist."""
    if n is None:
        return keys.select(key)
    drawn = secrets.randbits(31) if seed is None else seed
    chosen = keys.select(key).orderBy(*draw_order(key, drawn)).limit(n)
    if not strict:
        return chosen
    # at most n ids in one array: survives an empty input, unlike a row-wise check
    listed = chosen.agg(F.collect_list(key).alias("ids"))
    enough = F.when(F.size("ids") >= n, F.col("ids")).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot draw {n} entities, eligible: "), F.size("ids")))
    )
    return listed.select(F.explode(enough).alias(key))


def select_entities(df: DataFrame, keys: DataFrame, key: str, max_keys: int | None) -> DataFrame:
    """Rows whose key was chosen; ``max_keys`` is the known bound of ``keys``, if there is one."""
    chosen = keys.select(key)
    return df.join(chosen if max_keys is None else hint_small(chosen, max_keys), key, "left_semi")


def sample_reviews(reviews: DataFrame, businesses: DataFrame, params: Params) -> DataFrame:
    """All reviews of a seeded sample of eligible businesses, joined.

    Distinct reviews are counted on ids alone and before any join: the count spreads
    over (business, review), so a business with a large share of all reviews does
    not skew it. The join for the category then sees one row per business. A sample
    of business rows, at most ``n_entities`` of them, is broadcast to the reviews, so
    these are not shuffled, if the drawn number of the largest businesses would still be
    small. Without a sample the reviews of a business with many of them are cut into shares.
    """
    p = params
    key = p.col_entity
    required = [key, p.col_category, p.col_review, p.col_text, p.col_name, p.col_stars]
    wanted = drop_nulls(businesses, p.null_policy, required)
    wanted = category_filter(wanted, p.col_category, p.include, p.exclude)
    usable = drop_nulls(reviews, p.null_policy, required)

    counted = eligible_keys(usable, key, p.col_review, p.min_reviews)
    eligible = counted.join(wanted.select(key), key, "left_semi")
    chosen = sample_keys(eligible, key, p.n_entities, p.seed, p.strict_sample)
    found = select_entities(wanted, chosen, key, p.n_entities)
    reviews_, businesses_ = suffix_shared(usable, found, key)
    if p.n_entities is not None:
        return reviews_.join(hint_measured(businesses_, wanted, key, p.n_entities), key)
    parts = int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return salted_join(reviews_, businesses_, key, heavy_keys(usable, key, parts))
