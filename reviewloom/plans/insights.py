"""The whole run: reviews and businesses in, one row of summaries per business out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewloom import schemas
from reviewloom.operators import chunk, clean, embed, quality, retrieve, select, summarize
from reviewloom.params import Params
from reviewloom.sources import jsonl, tables

Summarizer = Callable[[DataFrame, list[str]], DataFrame]


def prepared_chunks(sampled: DataFrame, params: Params = Params()) -> DataFrame:
    """Joined reviews to clean, unique, chunked text."""
    return chunk.review_chunks(clean.clean_dedup(sampled, params), params)


def retrieved_chunks(
    vectors: DataFrame,
    params: Params = Params(),
    embedder: embed.Embedder | None = None,
    text_from: DataFrame | None = None,
    work: str | None = None,
) -> DataFrame:
    """The ranked chunks of every (business, topic); ``work`` as in :func:`retrieve.topic_retrieval`."""
    topics = embed.topic_table(vectors.sparkSession, params.topics)
    return retrieve.topic_retrieval(
        vectors,
        embed.embed_topics(topics, embedder),
        params.top_k,
        params.max_per_review,
        params.max_per_topic,
        params.metric,
        text_from,
        work,
    )


def generated(client_factory, **options) -> Summarizer:
    """A summarizer that asks a user client."""

    def summarizer(retrieved: DataFrame, topics: list[str]) -> DataFrame:
        prompts = summarize.build_prompts(retrieved, topics)
        return summarize.generate(prompts, "prompt", client_factory, **options)

    return summarizer


def run(
    reviews: DataFrame,
    businesses: DataFrame,
    params: Params = Params(),
    embedder: embed.Embedder | None = None,
    summarizer: Summarizer = summarize.offline_summaries,
    out: str | None = None,
) -> DataFrame:
    """Summaries by name, lazily as one plan, or stage by stage under ``out``.

    With ``out`` each stage table is written and the next stage reads it, which cuts
    lineage, survives lost executors and lets model calls happen once. Beside them
    go reports: rows and businesses per stage, what cleaning dropped (counted while it was
    written), and the (business, topic) pairs without excerpts. Vectors and chunks that do
    not pair one to one, by key, fail the run.
    """
    written: dict[str, DataFrame] = {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        if out is None:
            return df
        tables.write_table(df, f"{out}/{name}")
        written[name] = tables.read_table(df.sparkSession, f"{out}/{name}")
        return written[name]

    topics = list(params.topics)
    sampled = select.sample_reviews(reviews, businesses.drop(params.col_order), params)
    sampled = stage("reviews_df", sampled)
    if out is None:
        chunks = prepared_chunks(sampled, params)
    else:
        # texts are cleaned once, counted as they are written, and never shuffled
        unique, counts = clean.clean_stage(sampled, f"{out}/clean_reviews", params)
        tables.write_table(quality.counted_report(unique, counts), f"{out}/cleaning_report")
        chunks = stage("review_chunks", chunk.review_chunks(unique, params))
    vectors = embed.embed(chunks, "chunk", embedder, normalize=params.normalize)
    if out is not None:
        tables.write_vectors(vectors, f"{out}/chunk_vectors", buckets=params.vector_buckets)
        # rank ids only; the text of the few winners is looked up in the chunk table
        vectors = tables.read_vectors(vectors.sparkSession, f"{out}/chunk_vectors")
        quality.require_pairs(vectors, chunks)
        vectors = vectors.select("chunk_key", "chunk_id", "business_id", "review_id", "embedding")
    # without a stage table too, the text of the winners comes from the chunks
    text = chunks.select("chunk_key", "restaurant_name", "stars", "chunk")
    retrieved = retrieved_chunks(vectors, params, embedder, text)
    retrieved = stage("topic_relevant_review_chunks", retrieved)
    long = stage("summaries_long", summarizer(retrieved, topics))
    if out is not None:
        entities = chunks.select("business_id").distinct()
        tables.write_table(quality.empty_topics(entities, topics, retrieved), f"{out}/empty_topics")
        tables.write_table(quality.run_report(written), f"{out}/run_report")
    wide = summarize.pivot_summaries(long, topics)
    return stage("summaries", summarize.summaries_by_name(wide, topics))


def run_files(
    spark: SparkSession, reviews: str, businesses: str, params: Params = Params(), **options
) -> DataFrame:
    """:func:`run` on two JSON Lines inputs, each capped at its first lines by itself."""
    return run(
        jsonl.read_jsonl(spark, reviews, schemas.REVIEWS, params.head_rows),
        jsonl.read_jsonl(spark, businesses, schemas.BUSINESSES, params.head_rows),
        params,
        **options,
    )
