"""Exact topic search: score, top k per entity and topic, caps."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.vectors import batch_scores, check_metric
from reviewloom.operators.ranking import top_per_group
from reviewloom.sources import tables

#: Queries that travel with the plan; a table of more is joined block by block.
FEW = 64
#: Bytes of query vectors in one block, and of all blocks that may be broadcast.
BLOCK_BYTES = 8 << 20
BROADCAST_BYTES = 64 << 20
#: Vectors in one block.
BLOCK_ROWS = 2048
#: Rows of ids and scores that may be broadcast to the texts, some 20 MB.
FEW_WINNERS = 100_000
RESULT_COLUMNS = (
    "topic", "score", "rank", "chunk_id", "business_id",
    "restaurant_name", "stars", "review_id", "chunk",
)
#: What identifies a chunk; ``chunk_key`` is unique where ids repeat.
KEYS = ("chunk_key", "chunk_id")
Topics = DataFrame | Sequence[tuple[str, Sequence[float]]]


def few_topics(topics: Topics, few: int = FEW) -> tuple[list[str], np.ndarray] | None:
    """(names, matrix) of a list, or of a table of at most ``few`` topics; no more rows than that come to the driver."""
    rows = topics.select("topic", "qvec").limit(few + 1).collect() if isinstance(topics, DataFrame) else list(topics)
    if isinstance(topics, DataFrame) and len(rows) > few:
        return None
    width = max((len(v) for _, v in rows), default=0)
    if any(len(v) != width for _, v in rows):
        raise ValueError("query vectors differ in length")
    return [name for name, _ in rows], np.array([v for _, v in rows], dtype=np.float64).reshape(len(rows), width)


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    for v in column:
        if len(v) != dim:
            raise ValueError(f"expected {dim} dimensions, found {len(v)}")
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, dim))


def _scores(vector_col: str, queries: np.ndarray, metric: str) -> Column:
    @F.pandas_udf("array<double>")
    def scores(batch: pd.Series) -> pd.Series:
        return pd.Series(list(batch_scores(_matrix(batch, queries.shape[1]), queries, metric)), dtype=object)

    return scores(vector_col)


def score(
    chunks: DataFrame,
    topics: Topics,
    metric: str = "ip",
    vector_col: str = "embedding",
    keep_vector: bool = False,
) -> DataFrame:
    """One row per (chunk, topic) with a double ``score``, for a list or at most FEW rows of topics.

    Vectors stay where they are: every Arrow batch of them is multiplied with the
    matrix of query vectors, which travels with the task. Of all pairs most callers
    need only the best, see :func:`score_topk`, which takes any number of queries.
    """
    check_metric(metric)
    few = few_topics(topics)
    if few is None:
        raise ValueError(f"more than {FEW} topics: use score_topk")
    names, queries = few
    kept = [c for c in chunks.columns if keep_vector or c != vector_col]
    if not names:
        return chunks.select(*kept, F.lit("").alias("topic"), F.lit(0.0).alias("score")).limit(0)
    # the outer form: for the inner one Spark infers a filter that computes the scores again
    places = chunks.select(*kept, F.posexplode_outer(_scores(vector_col, queries, metric)).alias("_i", "score"))
    return places.select(*kept, F.array(*map(F.lit, names))[F.col("_i")].alias("topic"), "score")


def block_best(own: pd.DataFrame, scores: np.ndarray, k: int, metric: str, ties: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, query) of the k best rows per business and query of a block, all queries at once."""
    order = own.reset_index(drop=True).sort_values(["business_id", *ties], kind="stable").index.to_numpy()
    business = own["business_id"].to_numpy()[order]
    new = np.append(True, business[1:] != business[:-1]) if len(order) else np.zeros(0, bool)
    cost = scores[order] if metric == "l2" else -scores[order]
    rows, queries = [], []
    starts = np.flatnonzero(new)
    for a, z in zip(starts, np.append(starts[1:], len(order))):
        part = cost[a:z]
        if z - a > k:
            limit = np.partition(part, k - 1, axis=0)[k - 1]
            best = part <= limit
            crowded = np.flatnonzero(best.sum(axis=0) > k)  # equals at the limit: the first ones in order of ids
            if len(crowded):
                first = np.argsort(part[:, crowded], axis=0, kind="stable")[:k]
                best[:, crowded] = False
                best[first, crowded] = True
        else:
            best = np.ones(part.shape, bool)
        r, q = np.nonzero(best)
        rows.append(order[a + r])
        queries.append(q)
    return (np.concatenate(rows), np.concatenate(queries)) if rows else (np.zeros(0, int), np.zeros(0, int))


def score_topk(
    chunks: DataFrame, topics: Topics, k: int = 25, metric: str = "ip", vector_col: str = "embedding", few: int = FEW
) -> DataFrame:
    """The k best chunks per (business, topic), without a row for any other pair.

    A few topics travel with the task; each Arrow batch emits its own k best per
    (business, topic), and these rows of ids and scores are ranked per map task and in
    all. A table of queries is cut into blocks, see :func:`blocks_topk`.
    """
    check_metric(metric)
    ids = [c for c in ("business_id", "review_id", *KEYS) if c in chunks.columns]
    ties = [c for c in reversed(KEYS) if c in chunks.columns]
    narrow = chunks.select(*ids, vector_col)
    schema = T.StructType([
        *(chunks.schema[c] for c in ids), T.StructField("topic", T.StringType()), T.StructField("score", T.DoubleType())
    ])
    held = few_topics(topics, few)
    if held is None:
        return topic_topk(blocks_topk(narrow, topics, ids, ties, k, metric, schema), k, metric)
    names, queries = held
    if not names:
        return narrow.select(*ids, F.lit("").alias("topic"), F.lit(0.0).alias("score")).limit(0)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = batch_scores(_matrix(batch[vector_col], queries.shape[1]), queries, metric)
            rows, at = block_best(batch[ids], scores, k, metric, ties)
            made = batch[ids].iloc[rows]
            yield made.assign(topic=np.array(names, dtype=object)[at], score=scores[rows, at])

    return topic_topk(narrow.mapInPandas(best, schema), k, metric)


def _listed(df: DataFrame, rows: int) -> DataFrame:
    """Blocks of up to so many rows, each one row of arrays; nothing is shuffled."""
    schema = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in df.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ends = pa.array([0, part.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, c) for c in part.columns]
                yield pa.RecordBatch.from_arrays(lists, names=part.schema.names)

    return df.mapInArrow(run, schema)


def blocks_topk(
    narrow: DataFrame, topics: DataFrame, ids: list[str], ties: list[str], k: int, metric: str, schema: T.StructType
) -> DataFrame:
    """Each vector block times each query block: the k best per (business, topic) of every pair of blocks.

    The product is a join on the number of the query block. Query blocks are broadcast when
    their measured size allows it, and vectors stay in place. Beyond that both sides are
    dealt over (query block, share), so a pair of blocks is the largest thing a task holds.
    The plan is the same for any number of queries.
    """
    spark, vector_col = narrow.sparkSession, narrow.columns[-1]
    stored = tables.scratch(spark)
    tables.write_table(topics.select("topic", "qvec"), stored)
    queries = tables.read_table(spark, stored)
    n, width = queries.agg(F.count("*"), F.max(F.size("qvec"))).first()
    size = n * (width or 0) * 4
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("topic"), F.lit(blocks)).cast("int")
    sides = queries.groupBy(block.alias("_q")).agg(F.collect_list("topic").alias("_names"), F.collect_list("qvec").alias("_qvecs"))
    vectors = _listed(narrow, BLOCK_ROWS).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if size <= BROADCAST_BYTES:
        pairs = vectors.join(F.broadcast(sides), "_q")
    else:
        shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
        share = F.pmod(F.xxhash64(*ids), F.lit(shares)).cast("int")
        dealt = sides.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        pairs = vectors.withColumn("_share", share).join(dealt.hint("shuffle_hash"), ["_q", "_share"])
    out = pa.schema([*((c, narrow_type) for c, narrow_type in _arrow_types(schema))])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = pd.DataFrame({c: batch[c][i].values.to_pandas() for c in ids})
                v, q = (_dense(batch[c][i].values) for c in (vector_col, "_qvecs"))
                names = batch["_names"][i].values
                scores = batch_scores(v, q, metric)
                rows, at = block_best(own, scores, k, metric, ties)
                columns = [batch[c][i].values.take(pa.array(rows)) for c in ids]
                columns += [names.take(pa.array(at)), pa.array(scores[rows, at])]
                yield pa.RecordBatch.from_arrays(columns, names=out.names).cast(out)

    return pairs.select(*ids, vector_col, "_names", "_qvecs").mapInArrow(best, schema)


def _arrow_types(schema: T.StructType) -> list[tuple[str, pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [(f.name, f.type) for f in to_arrow_schema(schema)]


def _dense(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    lengths = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) != 1:
        raise ValueError(f"expected vectors of one length, found {lengths.tolist()}")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def best_first(df: DataFrame, metric: str = "ip") -> list[Column]:
    """Similarity falls, distance rises; ties go to the smaller id, then the smaller key."""
    ties = [F.asc(c) for c in reversed(KEYS) if c in df.columns]
    return [F.asc("score") if metric == "l2" else F.desc("score"), *ties]


def topic_topk(scored: DataFrame, k: int = 25, metric: str = "ip", salts: int = 16) -> DataFrame:
    """The k best chunks per (business, topic); only real rows, never padding."""
    return top_per_group(scored, ["business_id", "topic"], best_first(scored, metric), k, salts=salts)


def cap_per_review(ranked: DataFrame, max_per_review: int = 1, metric: str = "ip") -> DataFrame:
    """At most ``max_per_review`` chunks of a review in each (business, topic)."""
    return top_per_group(
        ranked, ["business_id", "topic", "review_id"], best_first(ranked, metric), max_per_review
    )


def topic_retrieval(
    chunks: DataFrame,
    topics: Topics,
    k: int = 25,
    max_per_review: int = 1,
    max_per_topic: int = 12,
    metric: str = "ip",
    text_from: DataFrame | None = None,
    work: str | None = None,
) -> DataFrame:
    """Top k, then the cap per review, then the first ``max_per_topic``, ranked.

    Only ids and scores are ranked. The other columns are looked up for the winners,
    in ``text_from`` or, without it, in ``chunks``. With ``work``, a folder, the winners are
    written there and counted, so that few of them go to the texts and no text is shuffled.
    """
    top = score_topk(chunks, topics, k, metric)
    capped = cap_per_review(top, max_per_review, metric)
    ranked = top_per_group(
        capped, ["business_id", "topic"], best_first(capped, metric), max_per_topic, rank="rank"
    )
    details = chunks.drop("embedding") if text_from is None else text_from
    if set(details.columns) - set(ranked.columns):
        if work is not None:
            tables.write_table(ranked, work)
            ranked = tables.read_table(ranked.sparkSession, work)
        few = work is not None and ranked.limit(FEW_WINNERS + 1).count() <= FEW_WINNERS
        ranked = attach(ranked, details, few=few)
    return ranked.select(*[c for c in RESULT_COLUMNS if c in ranked.columns])


def attach(ranked: DataFrame, details: DataFrame, key: str | None = None, few: bool = False) -> DataFrame:
    """Look up the columns of ``details`` that ``ranked`` lacks, by key.

    ``few`` says that ``ranked`` may be broadcast; details then stay in place. The key is ``chunk_key`` if both have it, else ``chunk_id``. A key that occurs twice in
    ``details`` fails the job: it would make two rows of one.
    """
    key = key or next(c for c in KEYS if c in ranked.columns and c in details.columns)
    extra = [c for c in details.columns if c == key or c not in ranked.columns]
    # the winners are the side that is held: details stream by unsorted, and in place if bucketed by the key
    joined = details.select(*extra).join(F.broadcast(ranked) if few else ranked.hint("shuffle_hash"), key)
    row = [c for c in (key, "business_id", "topic", "rank") if c in ranked.columns]
    twice = F.count("*").over(Window.partitionBy(*row)) > 1
    checked = F.when(twice, F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string")))).otherwise(
        F.lit(True)
    )
    return joined.withColumn("_once", checked).filter("_once").drop("_once")


def search(
    chunks: DataFrame,
    query: Topics,
    business_id,
    k: int = 5,
    metric: str = "ip",
) -> DataFrame:
    """Free-text search in one business: the k best chunks, ranked.

    ``business_id`` is a value or a column such as a scalar subquery.
    """
    wanted = chunks.filter(F.col("business_id") == business_id)
    scored = score(wanted, query, metric)
    order = best_first(scored, metric)
    best = scored.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
