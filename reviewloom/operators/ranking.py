"""Ranked subsets: top k per group, first n rows, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of ids or of business descriptions (a few KB each) that may be broadcast.
BROADCAST_ROWS = 10_000


def hint_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when its known row bound is small; else let AQE choose."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts as they are, 16 for any other value."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    others = [f for f in df.schema if f.dataType.typeName() not in ("string", "binary", "array", "map", "struct")]
    nested = [
        F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")
    ]
    return sum((*texts, *nested), F.lit(16 * (len(others) + len(texts)))).cast("bigint")


def hint_measured(df: DataFrame, of: DataFrame, key: str, max_keys: int, most: int = 64 << 20) -> DataFrame:
    """Broadcast rows of ``of`` for at most ``max_keys`` keys only when their size has a proven bound.

    The bound is the ``max_keys`` times the largest bytes that one key has in ``of``, rows
    that repeat a key included; measuring it moves keys and numbers.
    """
    per_key = of.groupBy(key).agg(F.sum(row_bytes(of)).alias("bytes"))
    largest = per_key.agg(F.max("bytes")).first()[0] or 0
    return F.broadcast(df) if max_keys * largest <= most else df


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    salts: int = 0,
    rank: str | None = None,
) -> DataFrame:
    """Rows ranked at most ``k`` within ``keys``; ``order`` must be total.

    ``row_number() <= k`` lets each map task keep only k rows per group before the
    shuffle. With ``salts`` a group is first ranked in that many parts. A part is
    made of whole map tasks, so each of these still keeps k rows and not k per part;
    which task holds a row does not matter, as the best of all parts are ranked again.
    """

    def keep(frame: DataFrame, parts: Sequence[str], out: str) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy(*order)
        return frame.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)

    out = rank or "_rank"
    if salts > 1:
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        df = keep(salted, [*keys, "_salt"], "_part").drop("_salt", "_part")
    top = keep(df, keys, out)
    return top if rank else top.drop(out)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_per_group(df, keys, order, 1)


def head_rows(df: DataFrame, n: int, order: str, fan_out: int = 1024, enough: int = 10_000) -> DataFrame:
    """The ``n`` rows with the smallest values of a unique integer column.

    A plain ``orderBy.limit`` would send up to n rows of every partition to one
    task. Instead the value of row n is looked for: the range of values is cut into
    ``fan_out`` blocks, their rows are counted, and the block that holds row n is cut
    again, until it holds few rows. Dense ids take two passes over one integer
    column, and any 64-bit ids at most seven; the wide rows meet just a comparison.
    """
    if n <= 0:
        return df.limit(0)
    known = df.filter(F.col(order).isNotNull())
    low, high, rows = known.agg(F.min(order), F.max(order), F.count("*")).first()
    if rows <= n:
        return known
    before = 0
    while rows > enough and low < high:
        width = -(-(high - low + 1) // fan_out)
        inside = known.filter(F.col(order).between(low, high))
        # in decimals, as the range of 64-bit ids does not fit 64 bits
        block = F.floor((F.col(order).cast("decimal(20,0)") - F.lit(low)) / F.lit(width).cast("decimal(20,0)"))
        counts = inside.groupBy(block.cast("int").alias("block")).agg(F.count("*").alias("n"))
        for r in sorted(counts.collect()):  # at most fan_out rows
            if before + r["n"] >= n:
                break
            before += r["n"]
        low, high, rows = low + r["block"] * width, min(high, low + (r["block"] + 1) * width - 1), r["n"]
    left = known.select(order).filter(F.col(order).between(low, high)).orderBy(order).limit(n - before)
    return known.filter(F.col(order) <= left.agg(F.max(order)).first()[0])
