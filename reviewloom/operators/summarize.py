"""Prompts, generated or offline summaries, and the summary table."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from reviewloom.functions import text as T
from reviewloom.params import LIMITED_DETAILS, PROMPT_EXCERPT, PROMPT_HEADER


def _per_topic(
    retrieved: DataFrame,
    topics: Sequence[str],
    values: dict[str, Column],
    entities: DataFrame | None,
) -> DataFrame:
    """Aggregate the few ranked chunks of each (business, topic).

    Every business gets a row for every topic, with nulls where nothing was found.
    The topic list is part of the call, so the missing pairs come from unfolding a
    map per business and not from pairing tables.
    """
    found = retrieved.groupBy("business_id", "topic").agg(
        F.min("restaurant_name").alias("restaurant_name"),
        *[v.alias(n) for n, v in values.items()],
    )
    folded = found.groupBy("business_id").agg(
        F.min("restaurant_name").alias("restaurant_name"),
        F.map_from_entries(F.collect_list(F.struct("topic", F.struct(*values)))).alias("by_topic"),
    )
    if entities is not None:
        named = entities.select("business_id", "restaurant_name")
        folded = named.join(folded.drop("restaurant_name"), "business_id", "left")
    pairs = folded.select(
        "business_id",
        "restaurant_name",
        "by_topic",
        F.explode(F.array(*map(F.lit, topics))).alias("topic"),
    )
    value = F.col("by_topic")[F.col("topic")]
    return pairs.select(
        "business_id", "restaurant_name", "topic", *[value[n].alias(n) for n in values]
    )


def _joined_in_rank_order(part: Column, delimiter: str) -> Column:
    """Concatenate a string over the group by rank."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", part.alias("part"))))
    return F.array_join(F.transform(ordered, lambda s: s["part"]), delimiter)


def build_prompts(
    retrieved: DataFrame, topics: Sequence[str], entities: DataFrame | None = None
) -> DataFrame:
    """One prompt per business and topic, excerpts in rank order from 0."""
    excerpt = T.fill(
        PROMPT_EXCERPT,
        I=(F.col("rank") - 1).cast("string"),
        STARS=F.col("stars").cast("string"),
        CHUNK=F.col("chunk"),
    )
    grouped = _per_topic(
        retrieved,
        topics,
        {"excerpts": _joined_in_rank_order(excerpt, ""), "n_excerpts": F.count("*")},
        entities,
    )
    header = T.fill(
        PROMPT_HEADER,
        NAME=F.col("restaurant_name"),
        TOPIC=F.upper("topic"),
        topic=F.col("topic"),
    )
    return grouped.select(
        "business_id",
        "restaurant_name",
        "topic",
        F.concat(header, F.coalesce("excerpts", F.lit(""))).alias("prompt"),
        F.coalesce("n_excerpts", F.lit(0)).alias("n_excerpts"),
    )


def offline_summaries(
    retrieved: DataFrame,
    topics: Sequence[str],
    entities: DataFrame | None = None,
    max_excerpts: int | None = None,
) -> DataFrame:
    """Summaries without a model: a polarity word and the first sentence of each excerpt.

    A stand-in for a language model, not an imitation of one. ``max_excerpts`` keeps
    the best ones only.
    """
    sentence = T.first_sentence(F.col("chunk"))
    if max_excerpts is not None:
        sentence = F.when(F.col("rank") <= max_excerpts, sentence)
    grouped = _per_topic(
        retrieved,
        topics,
        {"mean_stars": F.avg("stars"), "sentences": _joined_in_rank_order(sentence, " ")},
        entities,
    )
    polarity = (
        F.when(F.col("mean_stars") >= 3.5, F.lit("positive"))
        .when(F.col("mean_stars") <= 2.5, F.lit("negative"))
        .otherwise(F.lit("mixed"))
    )
    text = F.concat(F.initcap(polarity), F.lit(" reviews. "), F.col("sentences"))
    limited = T.fill(LIMITED_DETAILS, topic=F.col("topic"))
    return grouped.select(
        "business_id",
        "restaurant_name",
        "topic",
        T.one_line(F.coalesce(text, limited)).alias("summary"),
    )


def generate(
    df: DataFrame,
    prompt_col: str,
    client_factory: Callable[[], Callable[[str], str]],
    out: str = "summary",
    retries: int = 2,
    backoff: float = 1.0,
    on_error: str = "raise",
    parallelism: int | None = None,
    timeout: float | None = 120,
) -> DataFrame:
    """Send each prompt to a user client and add its one-line response.

    ``client_factory()`` runs once per task and returns ``prompt -> response``. A call
    that takes more than ``timeout`` seconds counts as failed (its thread is left
    behind, so clients should give up by themselves too). ``parallelism`` bounds the number of concurrent
    clients. With ``on_error="column"`` a failed row gets a null response and its
    message in ``error`` instead of failing the job. A retried task repeats calls,
    so clients should be idempotent.
    """
    if on_error not in ("raise", "column"):
        raise ValueError(f"on_error must be 'raise' or 'column', got {on_error!r}")

    def limited(client: Callable[[str], str], prompt: str) -> str:
        if timeout is None:
            return client(prompt)
        answer: queue.Queue = queue.Queue()

        def call() -> None:
            try:
                answer.put((client(prompt), None))
            except Exception as e:
                answer.put((None, e))

        threading.Thread(target=call, daemon=True).start()
        try:
            said, error = answer.get(timeout=timeout)
        except queue.Empty:
            raise TimeoutError(f"no answer within {timeout} seconds") from None
        if error is not None:
            raise error
        return said

    def ask(client: Callable[[str], str], prompt: str) -> tuple[str | None, str | None]:
        for attempt in range(retries + 1):
            try:
                return limited(client, prompt), None
            except Exception as e:  # any client failure counts as an attempt
                if attempt == retries:
                    if on_error == "raise":
                        raise
                    return None, str(e)
                time.sleep(backoff * 2**attempt)
        return None, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in batches:
            answers = [ask(client, p) for p in pdf[prompt_col]]
            pdf[out] = [a for a, _ in answers]
            if on_error == "column":
                pdf["error"] = [e for _, e in answers]
            yield pdf

    schema = ST.StructType([*df.schema.fields, ST.StructField(out, ST.StringType())])
    if on_error == "column":
        schema = schema.add("error", ST.StringType())
    source = df.repartition(parallelism) if parallelism else df
    return source.mapInPandas(run, schema).withColumn(out, T.one_line(F.col(out)))


def pivot_summaries(long: DataFrame, topics: Sequence[str]) -> DataFrame:
    """One row per business, one column per topic."""
    return (
        long.groupBy("business_id", "restaurant_name")
        .pivot("topic", list(topics))
        .agg(F.first("summary"))
    )


def summaries_by_name(wide: DataFrame, topics: Sequence[str]) -> DataFrame:
    """One row per name; of businesses with one name the largest id wins."""
    return (
        wide.groupBy("restaurant_name")
        .agg(F.max_by(F.struct(*topics), "business_id").alias("s"))
        .select("restaurant_name", *[F.col("s")[t].alias(t) for t in topics])
    )
