"""Exact top-k search by inner product over a pivot-distance index.

Components become whole numbers, floor(scale * x), so scores are exact. A vector's
key is its nearest pivot and its distance from it; the vectors of a pivot, sorted
by distance, form annuli. With q·x = (|q|² + |x|² - |q - x|²) / 2 and
|q - x| >= |d(q, p) - d(x, p)|, an annulus has an upper bound for a query's scores.
A query first looks into its best annuli, until they hold k vectors besides
itself; its k-th score so far then bounds the rest: inside an annulus, sorted
distances are expanded from the best one outwards and stop where the bound falls
below that score. All annuli whose bound reaches it are looked into, so the
result is exact, ties included.

Equal vectors are one index entry that keeps the k + 1 smallest ids (no query
needs more). Annuli are read in parts of bounded size and queries in blocks of
bounded size, so a crowded region is spread over tasks.

Vectors that are null or hold null or non-finite components, and rows without
id, take no part. Shorter vectors count as padded with zeros. Repeated rows (same
id and vector) count once; candidates with the query's own id are its own row.
Equal scores rank by the smaller id. An empty table, or one without valid vectors, gives no rows;
vectors may be of any length. Other columns are ignored. Components are limited to what keeps scores in 64
bits: |scale * x| < 2^28 with up to 64 dimensions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm import common


@dataclass(frozen=True)
class Settings:
    """pivots are chosen from at most about `sample` vectors, by a hash of the id; every vector is indexed."""

    k: int = 10
    scale: int = 1024
    pivots: int = 64
    annuli: int = 16
    sample: int = 4000
    part: int = 1024
    block: int = 256


def whole(vectors: DataFrame, id_column: str, column: str, s: Settings) -> DataFrame:
    """id, v: valid vectors as arrays of whole numbers, each (id, v) once."""
    x = F.col(column)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    valid = vectors.filter(F.col(id_column).isNotNull() & x.isNotNull() & ~bad)
    v = F.transform(x, lambda e: F.floor(F.lit(s.scale) * e.cast("double")))
    return valid.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v"))


def matrix(column: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def objects(rows) -> pd.Series:
    """A column of arrays; typed, so that no rows convert too."""
    return pd.Series(list(rows), dtype=object)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first from the first row: each next pivot is the one farthest from all before."""
    chosen = [0]
    x = sample.astype(np.float64)
    gap = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(x)) and gap.max() > 0:
        k = int(gap.argmax())
        chosen.append(k)
        gap = np.minimum(gap, ((x - x[k]) ** 2).sum(axis=1))
    return x[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rows of x to all pivots."""
    x = x.astype(np.float64)
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Directory:
    """What is known of each annulus: pivot, least and largest distance, largest squared length, entries, parts."""

    pivots: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    square: np.ndarray
    count: np.ndarray
    parts: np.ndarray
    ring: np.ndarray

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bounds of each query's scores in each annulus; rounding is allowed for."""
        d = distances(q, self.pivots)[:, self.pivot]
        gap = np.maximum(np.maximum(self.low - d, d - self.high), 0)
        square = (q.astype(np.float64) ** 2).sum(axis=1)[:, None]
        return (square + self.square - gap * gap) / 2 + slack(square, self.square)


def slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than the rounding error of a bound made of numbers of this size."""
    return 1 + 1e-9 * (a + b)


def keyed(entries: DataFrame, pivots: np.ndarray, s: Settings) -> DataFrame:
    """Entries (v, ids) with pivot, dist, square and their vector padded."""
    dim = pivots.shape[1]

    def run(batches):
        for batch in batches:
            x = matrix(batch["v"], dim)
            d = distances(x, pivots)
            at = d.argmin(axis=1)
            yield pd.DataFrame({
                "pivot": at.astype(np.int32), "dist": d[np.arange(len(x)), at], "square": (x.astype(np.float64) ** 2).sum(axis=1),
                "v": objects(x), "ids": objects(batch["ids"]),
            })

    return entries.select("v", "ids").mapInPandas(run, "pivot int, dist double, square double, v array<bigint>, ids array<bigint>")


def directory(rows: DataFrame, pivots: np.ndarray, s: Settings) -> tuple[DataFrame, Directory]:
    """Adds ring and part to keyed rows; at most pivots x annuli directory entries come to the driver."""
    spans = {r["pivot"]: (r["a"], r["b"]) for r in rows.groupBy("pivot").agg(F.min("dist").alias("a"), F.max("dist").alias("b")).collect()}
    low, width = F.lit(0.0), F.lit(1.0)
    a = np.array([spans.get(p, (0, 0))[0] for p in range(len(pivots))])
    w = np.array([max((spans[p][1] - spans[p][0]) / s.annuli if p in spans else 0, 1e-9) for p in range(len(pivots))])
    low, width = (F.element_at(F.array(*map(F.lit, c.tolist())), F.col("pivot") + 1) for c in (a, w))
    ring = F.least(F.floor((F.col("dist") - low) / width), F.lit(s.annuli - 1)).cast("int")
    rows = rows.withColumn("ring", ring)
    found = rows.groupBy("pivot", "ring").agg(
        F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("square").alias("square"), F.count("*").alias("n")
    ).orderBy("pivot", "ring").toPandas()
    parts = np.ceil(found["n"] / s.part).astype(int)
    known = Directory(
        pivots, *(found[c].to_numpy() for c in ("pivot", "low", "high", "square", "n")), parts.to_numpy(), found["ring"].to_numpy()
    )
    per_ring = {(p, r): n for p, r, n in zip(known.pivot.tolist(), known.ring.tolist(), known.parts.tolist())}
    table = F.array(*(F.lit(per_ring.get((p, r), 1)) for p in range(len(pivots)) for r in range(s.annuli)))
    n = F.element_at(table, F.col("pivot") * s.annuli + F.col("ring") + 1)
    return rows.withColumn("part", F.pmod(F.xxhash64("v"), n).cast("int")), known


def packed(rows: DataFrame) -> DataFrame:
    """One row for each part of an annulus, its entries sorted by distance."""
    entry = F.struct("dist", "square", "v", "ids")
    return rows.groupBy("pivot", "ring", "part").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def wanted(queries: DataFrame, known: Directory, s: Settings, floor: bool) -> DataFrame:
    """(pivot, ring, id, v, least) for each annulus a query has to look into.

    Without floor: the best annuli, until they hold k + 1 entries. With floor (column
    least, the k-th score so far): all others whose bound reaches it.
    """
    dim, k = known.pivots.shape[1], s.k

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                q = matrix(part["v"], dim)
                bound = known.bounds(q)
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(known.count[order], axis=1)
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, np.concatenate([np.zeros((len(q), 1)), held[:, :-1]], axis=1) <= k, axis=1)
                least = part["least"].to_numpy() if floor else np.full(len(q), np.iinfo(np.int64).min)
                look = (~first & (bound >= least[:, None])) if floor else first
                i, j = np.nonzero(look)
                yield pd.DataFrame({
                    "pivot": known.pivot[j].astype(np.int32), "ring": known.ring[j].astype(np.int32),
                    "id": part["id"].to_numpy()[i], "v": objects(q[i]), "least": least[i],
                })

    return queries.mapInPandas(run, "pivot int, ring int, id bigint, v array<bigint>, least bigint")


def looked_up(want: DataFrame, index: DataFrame, known: Directory, s: Settings) -> DataFrame:
    """(query_id, vec_id, score): of each part of an annulus, the best k for each query that looks into it."""
    want = common.kept_table(want)
    sizes = want.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / s.block).cast("int").alias("blocks"))
    sized = want.join(F.broadcast(sizes), ["pivot", "ring"])  # at most pivots x annuli rows
    blocks = sized.groupBy("pivot", "ring", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")).agg(
        F.collect_list(F.struct("id", "v", "least")).alias("queries")
    )
    both = blocks.join(index, ["pivot", "ring"]).select("pivot", "queries", "entries")
    pivots, k = known.pivots, s.k

    def best(pivot: int, queries: list, entries: list) -> list[tuple]:
        dim = pivots.shape[1]
        x = matrix([e["v"] for e in entries], dim)
        dist = np.array([e["dist"] for e in entries])
        square = max(e["square"] for e in entries)
        exact = x.astype(np.float64) if np.abs(x).max(initial=0) < 1 << 20 else x
        q = matrix([r["v"] for r in queries], dim)
        qd = distances(q, pivots[pivot : pivot + 1])[:, 0]
        out = []
        for row, d, v in zip(queries, qd, q):
            n2 = float((v.astype(np.float64) ** 2).sum())
            found: list[tuple[int, int]] = []  # (-score, id), best first
            least = row["least"]
            left = right = int(np.searchsorted(dist, d))
            step = 64
            while left > 0 or right < len(dist):
                # the next entries on both sides, nearest distances first, while their bound holds
                reach = np.sqrt(max(0.0, n2 + square + 2 * float(slack(np.float64(n2), np.float64(square))) - 2 * least)) if least > -(1 << 62) else np.inf
                a = max(0, left - step, int(np.searchsorted(dist, d - reach, "left")))
                b = min(len(dist), right + step, int(np.searchsorted(dist, d + reach, "right")))
                at = np.r_[a : max(a, left), min(right, b) : b] if (a < left or b > right) else np.zeros(0, int)
                if not len(at):
                    break
                score = exact[at] @ v.astype(exact.dtype)
                good = np.flatnonzero(score >= least)
                for g in good.tolist():
                    e = entries[at[g]]
                    found += [(-int(score[g]), i) for i in e["ids"] if i != row["id"]]
                found = sorted(found)[:k]
                if len(found) == k:
                    least = max(least, -found[-1][0])
                left, right, step = min(left, a), max(right, b), step * 2
            out += [(row["id"], i, -score) for score, i in found]
        return out

    def make() -> Callable[..., list[tuple]]:
        return lambda *columns: [r for row in zip(*columns) for r in best(*row)]

    return common.map_batches(both, make, "query_id bigint, vec_id bigint, score bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, s: Settings = Settings(), id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row that is_query (on column id) marks."""
    spark = vectors.sparkSession
    rows = common.kept_table(whole(vectors, id_column, column, s))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not size["n"]:
        return empty
    by_vector = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("r", F.row_number().over(by_vector)).filter(F.col("r") <= s.k + 1)
    entries = common.kept_table(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    cut = min(1_000_003, -(-1_000_003 * s.sample // size["n"]))
    sample = entries.filter(F.pmod(F.xxhash64("v"), F.lit(1_000_003)) < cut).select("v", F.col("ids")[0].alias("id"))
    sample = sample.limit(4 * s.sample).toPandas().sort_values("id")
    if not len(sample):  # possible only for a handful of entries
        sample = entries.select("v", F.col("ids")[0].alias("id")).limit(s.pivots).toPandas().sort_values("id")
    pivots = choose_pivots(matrix(sample["v"], max(1, size["dim"])), s.pivots)
    placed, known = directory(common.kept_table(keyed(entries, pivots, s)), pivots, s)
    index = common.kept_table(packed(placed))
    queries = rows.filter(is_query).distinct()
    first = common.kept_table(looked_up(wanted(queries, known, s, floor=False), index, known, s))
    tops = common.kept_table(ranked(first, s.k))
    full = tops.filter(F.col("rank") == s.k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    second = queries.join(full, "id", "left").withColumn("least", F.coalesce("least", F.lit(-(2**63))))
    more = looked_up(wanted(second, known, s, floor=True), index, known, s)
    best = tops.drop("rank").unionByName(more).distinct()
    return ranked(best, s.k).select("query_id", "rank", "vec_id", "score")


def op4_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(common.table(spark, folder, "embeddings"), F.col("id") % 100 == 0)
