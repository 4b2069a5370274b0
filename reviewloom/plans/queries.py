"""One query per operator, each over whole test tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import vectors as V
from reviewloom.operators import (
    clean,
    embed,
    explore,
    present,
    quality,
    ranking,
    retrieve,
    select,
    summarize,
)
from reviewloom.params import TOPICS
from reviewloom.plans import incremental, insights, views
from reviewloom.plans.views import PARAMS, table
from reviewloom.sources import jsonl, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SELECTION = dataclasses.replace(
    PARAMS, include="widget", exclude="hot|cold", min_reviews=20, head_rows=None, strict_sample=False
)
# small enough for the smallest test tables; the sources are split by language
INSIGHTS = dataclasses.replace(
    PARAMS, include="e", exclude="de|fr", min_reviews=3, n_entities=10, head_rows=None
)
INSIGHTS_ALL = dataclasses.replace(INSIGHTS, n_entities=None)
FEW_FOLDERS = dataclasses.replace(PARAMS, vector_buckets=8)
HEAD = 5000
HEAD_LINES = 300
HOT_PARTS = 16
AD_HOC = "quiet table, slow service and cold soup"
TOPIC_LIST = list(TOPICS)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    return views.document_reviews(_documents(spark, folder))


def _lang_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return views.document_reviews(_documents(spark, folder), views.source_lang())


def _retrieved(reviews: DataFrame) -> DataFrame:
    chunks = insights.prepared_chunks(reviews, PARAMS)
    return insights.retrieved_chunks(embed.embed(chunks, "chunk"), PARAMS)


# --- ingest and selection -----------------------------------------------------


@query
def head_rows(spark, folder):
    orders = table(spark, folder, "orders")
    return ranking.head_rows(orders, HEAD, "o_orderkey").select("o_orderkey", "o_custkey")


@query
def json_props(spark, folder):
    events = table(spark, folder, "events")
    props = F.from_json("props", "k bigint", {"mode": "FAILFAST"})
    return events.select("event_id", props["k"].alias("k"))


@query
def drop_any_null(spark, folder):
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    kept = select.drop_nulls(labelled.select("doc_id", "source", "quality", "toxic"))
    return _big(kept, "quality", "toxic")


@query
def join_suffix(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("business_id"),
        F.col("o_orderkey").alias("review_id"),
        F.col("o_totalprice").alias("amount"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("business_id"), F.col("c_acctbal").alias("amount")
    )
    return select.join_entities(orders, customers)


@query
def review_business_join(spark, folder):
    joined = select.join_entities(views.part_reviews(spark, folder), views.parts(spark, folder))
    return _big(joined, "line").drop("categories")


@query
def hot_key_join(spark, folder):
    """As review_business_join, with half of all reviews moved to one business."""
    key = F.when(F.col("line") % 2 == 1, F.lit(1).cast("bigint")).otherwise(F.col("business_id"))
    reviews = views.part_reviews(spark, folder).withColumn("business_id", key)
    joined = select.join_entities(reviews, views.parts(spark, folder), parts=HOT_PARTS)
    return _big(joined, "line").drop("categories")


@query
def category_filter(spark, folder):
    kept = select.category_filter(
        views.parts(spark, folder), "categories", SELECTION.include, SELECTION.exclude
    )
    return kept.select("business_id", "name")


@query
def eligible_keys(spark, folder):
    reviews = views.part_reviews(spark, folder)
    return select.eligible_keys(reviews, "business_id", "review_id", SELECTION.min_reviews)


@query
def sample_entities(spark, folder):
    return select.sample_keys(eligible_keys(spark, folder), "business_id", 10, seed=1)


@query
def select_entities(spark, folder):
    sampled = select.sample_reviews(
        views.part_reviews(spark, folder), views.parts(spark, folder), SELECTION
    )
    return _big(sampled, "line").drop("categories")


@query
def union_batches(spark, folder):
    first = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), "source", F.length("text").alias("n_chars")
    )
    second = table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("review_id"), F.length("text").alias("n_chars")
    )
    return _big(explore.union_batches(first, second), "n_chars")


# --- stored and read again -------------------------------------------------------

JSON_FIELDS = "review_id string, business_id string, name string, stars_reviews double, date string, text string"


def _json_lines(spark, folder):
    """The reviews as JSON Lines in the shared folder, several files in order of ids."""
    path = tables.scratch(spark)
    jsonl.write_jsonl(_reviews(spark, folder), path, "ordinal")
    return path, T._parse_datatype_string(JSON_FIELDS)


@query
def json_lines(spark, folder):
    path, schema = _json_lines(spark, folder)
    return jsonl.read_jsonl(spark, path, schema).drop("ordinal")


@query
def json_head(spark, folder):
    """The first lines of several files."""
    path, schema = _json_lines(spark, folder)
    return jsonl.read_jsonl(spark, path, schema, HEAD_LINES).drop("ordinal")


@query
def csv_round_trip(spark, folder):
    """Texts with line ends and quotes, in small CSV files and back; an empty text comes back as null."""
    path, reviews = tables.scratch(spark), _reviews(spark, folder).drop("ordinal")
    tables.write_csv(reviews, path, rows_per_file=500)
    return tables.read_csv(spark, path, T._parse_datatype_string(JSON_FIELDS))


@query
def parquet_round_trip(spark, folder):
    """A stage table that is replaced: only what was written last is read."""
    path, reviews = tables.scratch(spark), _reviews(spark, folder)
    tables.write_table(reviews.limit(1), path)
    tables.write_table(reviews, path)
    return tables.read_table(spark, path)


@query
def vector_refresh(spark, folder):
    """Stored vectors by business, then the vectors of one business halved and put in place of the old ones."""
    path, vectors = tables.scratch(spark), views.stored_vectors(spark, folder)
    tables.write_vectors(vectors, path)
    first = vectors.agg(F.min("business_id")).first()[0]
    half = F.transform("embedding", lambda x: (x / 2).cast("float"))
    tables.write_vectors(vectors.filter(F.col("business_id") == first).withColumn("embedding", half), path, refresh=True)
    stored = tables.read_vectors(spark, path)
    return stored.select("chunk_id", "business_id", "review_id", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first"))


# --- text ----------------------------------------------------------------------


@query
def clean_text(spark, folder):
    return clean.clean_text(_reviews(spark, folder)).select("review_id", "text")


@query
def clean_unicode(spark, folder):
    """Other characters of the same meaning clean to the same text."""
    plain = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \"'"
    odd = "".join(chr(ord(c) + 0xFEE0) for c in plain[:62]) + "\u00a0\u201c\u2019"
    text = F.translate(F.replace("text", F.lit("\n"), F.lit("\x0b")), plain, odd)
    return clean.clean_text(_reviews(spark, folder).withColumn("text", text)).select("review_id", "text")


@query
def dedup_text(spark, folder):
    """By way of a stored table, as a staged run does; the lazy form is in every query with chunks."""
    cleaned = clean.clean_text(_reviews(spark, folder))
    return clean.stored_unique(cleaned, tables.scratch(spark))[0].select("review_id", "text")


def _chunks(spark, folder, mode):
    params = dataclasses.replace(PARAMS, chunk_mode=mode)
    made = insights.prepared_chunks(_reviews(spark, folder), params)
    return _big(made, "chunk_index", "n_chars")


@query
def chunk_first(spark, folder):
    return _chunks(spark, folder, "first")


@query
def chunk_sliding(spark, folder):
    return _chunks(spark, folder, "sliding")


@query
def cleaning_report(spark, folder):
    return quality.cleaning_report(table(spark, folder, "documents"))


@query
def cleaning_counted(spark, folder):
    """The same numbers, counted while the cleaned table is written."""
    unique, counts = clean.clean_stage(_reviews(spark, folder), tables.scratch(spark), PARAMS)
    return quality.counted_report(unique, counts)


# --- vectors ---------------------------------------------------------------------


def _exploded(df: DataFrame, key: str, vector: str, zeros: bool = False) -> DataFrame:
    # the outer form: for the inner one Spark infers a filter on the array, which
    # would compute every vector again
    places = df.select(key, F.posexplode_outer(vector).alias("pos", "weight"))
    return (places if zeros else places.filter("weight <> 0")).select(
        key,
        F.col("pos").cast("bigint").alias("bucket"),
        F.round(F.col("weight").cast("double"), 6).alias("weight"),
    )


@query
def embed_hashed(spark, folder):
    chunks = insights.prepared_chunks(_reviews(spark, folder), PARAMS)
    return _exploded(embed.embed(chunks, "chunk"), "chunk_id", "embedding")


@query
def embed_topics(spark, folder):
    """Every benchmark passage as a query text."""
    passages = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("topic"), F.col("text").alias("keywords")
    )
    return _exploded(embed.embed_topics(passages), "topic", "qvec")


@query
def normalize_vectors(spark, folder):
    """Vectors stretched by their label and brought back to unit length."""
    stretched = table(spark, folder, "embeddings").withColumn(
        "embedding",
        F.transform("embedding", lambda x: (x.cast("double") * (F.col("label") + 1)).cast("float")),
    )
    unit = stretched.withColumn("embedding", V.normalize(F.col("embedding")))
    return _exploded(unit, "vec_id", "embedding", zeros=True)


def _scored(spark, folder, metric):
    scored = retrieve.score(views.stored_vectors(spark, folder), views.topic_vectors(spark), metric)
    return _rounded(scored, "score")


@query
def score_topics(spark, folder):
    return _scored(spark, folder, "ip")


@query
def score_cosine(spark, folder):
    return _scored(spark, folder, "cosine")


@query
def score_l2(spark, folder):
    return _scored(spark, folder, "l2")


@query
def score_many(spark, folder):
    """Every benchmark passage searched in every stored vector's business: best chunk."""
    passages = table(spark, folder, "benchmark").select(
        F.col("item_id").cast("string").alias("topic"), F.col("text").alias("keywords")
    )
    best = retrieve.score_topk(
        views.stored_vectors(spark, folder), embed.embed_topics(passages), 1, few=0
    )
    return _rounded(best, "score")


@query
def topic_topk(spark, folder):
    best = retrieve.score_topk(views.stored_vectors(spark, folder), views.topic_vectors(spark))
    return _rounded(best, "score")


@query
def topic_retrieval(spark, folder):
    return _rounded(_big(_retrieved(_reviews(spark, folder)), "rank"), "score")


@query
def batch_retrieval(spark, folder):
    """The same search, after three batches of reviews."""
    reviews, store = _reviews(spark, folder), tables.scratch(spark)
    last = reviews.agg(F.max("ordinal")).first()[0]
    cuts = [-1, last // 2, last * 9 // 10, last]
    for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
        batch = reviews.filter((F.col("ordinal") > a) & (F.col("ordinal") <= z))
        found = incremental.add_batch(spark, batch, store, f"b{i}", FEW_FOLDERS)
    return _rounded(_big(found, "rank"), "score")


@query
def retrieval_l2(spark, folder):
    """The nearest stored vectors by squared distance, with the cap per review."""
    found = retrieve.topic_retrieval(
        views.stored_vectors(spark, folder), views.topic_vectors(spark), metric="l2"
    )
    return _rounded(_big(found, "rank"), "score")


@query
def adhoc_search(spark, folder):
    """The five best chunks for a free text in one drawn business."""
    chunks = insights.prepared_chunks(_reviews(spark, folder), PARAMS)
    drawn = select.sample_keys(
        _reviews(spark, folder).select("business_id").distinct(), "business_id", 1, seed=42
    )
    asked = embed.embed_topics(embed.topic_table(spark, {"query": AD_HOC}))
    narrow = embed.embed(chunks, "chunk").select("chunk_id", "business_id", "chunk", "embedding")
    found = retrieve.search(narrow, asked, drawn.scalar(), k=5)
    return _rounded(_big(found, "rank"), "score")


@query
def bucketed_lookup(spark, folder):
    """Chunks and vectors stored by business and key; the search of one business reads its folders only."""
    reviews = _reviews(spark, folder)
    chunks = insights.prepared_chunks(reviews, PARAMS)
    stored = tables.write_bucketed(chunks, tables.scratch(spark), "chunk_key")
    ids = ("chunk_key", "chunk_id", "business_id", "review_id")
    vectors = embed.embed(stored.select(*ids, "chunk"), "chunk").select(*ids, "embedding")
    vectors = tables.write_bucketed(vectors, tables.scratch(spark), "chunk_key")
    wanted = reviews.agg(F.min("business_id")).first()[0]
    one, text = (tables.one_folder(df, wanted) for df in (vectors, stored))
    found = insights.retrieved_chunks(one.select(*ids, "embedding"), PARAMS, text_from=text.select(
        "chunk_key", "restaurant_name", "stars", "chunk"
    ))
    return _rounded(_big(found, "rank"), "score")


@query
def sample_per_topic(spark, folder):
    found = _retrieved(_reviews(spark, folder))
    drawn = explore.sample_per_stratum(found, "topic", "chunk_id", n=1, seed=1)
    return drawn.select("topic", "chunk_id", "business_id", "chunk")


@query
def vector_metadata_join(spark, folder):
    details = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("chunk_id"), "source", "n_chars"
    )
    return retrieve.attach(views.stored_vectors(spark, folder).drop("embedding"), details)


# --- integrity --------------------------------------------------------------------


@query
def index_lookup(spark, folder):
    """Per source: labelled documents against all documents."""
    documents = table(spark, folder, "documents").select("doc_id", F.col("source").alias("business_id"))
    labelled = documents.join(table(spark, folder, "labels"), "doc_id")
    return quality.index_listing(labelled, documents)


@query
def index_integrity(spark, folder):
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"))
    metadata = table(spark, folder, "labels").select(F.col("doc_id").alias("chunk_id"))
    return quality.index_integrity(vectors, metadata)


@query
def index_differences(spark, folder):
    """Stored vectors against themselves with some ids swapped for others, so that all counts agree."""
    vectors = table(spark, folder, "embeddings").select(F.col("label").alias("business_id"), F.col("vec_id").alias("chunk_key"))
    other = F.when(F.col("chunk_key") % 97 == 5, F.col("chunk_key") + 1_000_000_007).otherwise(F.col("chunk_key"))
    return _big(quality.index_differences(vectors, vectors.withColumn("chunk_key", other)), "business_id")


@query
def index_stats(spark, folder):
    stats = quality.index_stats(views.stored_vectors(spark, folder))
    return _rounded(_big(stats, "min_dim", "max_dim"), "min_norm", "max_norm")


@query
def empty_topics(spark, folder):
    """Businesses whose well-rated documents yield nothing for a topic."""
    documents = table(spark, folder, "documents")
    good = table(spark, folder, "labels").filter("quality = 1")
    reviews = views.document_reviews(
        _documents(spark, folder).join(good, "doc_id", "left_semi"), views.source_lang()
    )
    entities = documents.select(views.source_lang().alias("business_id")).distinct()
    return quality.empty_topics(entities, TOPIC_LIST, _retrieved(reviews))


@query
def run_report(spark, folder):
    return quality.cleaning_funnel(_reviews(spark, folder), PARAMS)


# --- reports ----------------------------------------------------------------------


@query
def count_histogram(spark, folder):
    bins = explore.count_histogram(views.part_reviews(spark, folder), "business_id", "review_id")
    return _big(bins, "bin")


@query
def counts_by_name(spark, folder):
    joined = select.join_entities(
        views.part_reviews(spark, folder), views.parts(spark, folder), null_policy="required"
    )
    return explore.counts_by_name(joined, "name", "review_id")


@query
def distinct_names(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return explore.distinct_names(parts, "p_name", "p_partkey")


@query
def entity_list(spark, folder):
    return insights.prepared_chunks(_reviews(spark, folder)).select("business_id").distinct()


# --- summaries ----------------------------------------------------------------------


@query
def topic_prompts(spark, folder):
    return _big(summarize.build_prompts(_retrieved(_reviews(spark, folder)), TOPIC_LIST), "n_excerpts")


@query
def topic_prompts_nulls(spark, folder):
    """Stars are unknown for a third of the documents: their excerpts stay in the prompts."""
    known = F.when(F.col("ordinal") % 3 != 0, F.col("stars_reviews"))
    reviews = _reviews(spark, folder).withColumn("stars_reviews", known)
    return _big(summarize.build_prompts(_retrieved(reviews), TOPIC_LIST), "n_excerpts")


def _long(spark, folder):
    return summarize.offline_summaries(_retrieved(_lang_reviews(spark, folder)), TOPIC_LIST)


@query
def summaries_long(spark, folder):
    return _long(spark, folder)


@query
def summary_pivot(spark, folder):
    return summarize.pivot_summaries(_long(spark, folder), TOPIC_LIST)


@query
def summary_by_name(spark, folder):
    return summarize.summaries_by_name(summary_pivot(spark, folder), TOPIC_LIST)


@query
def summary_view(spark, folder):
    """The reader's view; mixed food summaries are blanked so that the fallback shows."""
    missing = F.when(~F.col("food").startswith("Mixed"), F.col("food"))
    partial = summary_pivot(spark, folder).withColumn("food", missing)
    return present.summary_view(partial, TOPIC_LIST, order="business_id")


@query
def summary_lookup(spark, folder):
    """The view's row of the first name."""
    view = present.summary_view(summary_by_name(spark, folder), TOPIC_LIST)
    first = _reviews(spark, folder).agg(F.min("name")).scalar()
    return present.lookup(view, first)


def _insights(spark, folder, params, review_id=None):
    """The whole run: a business is a source in one language."""
    documents = table(spark, folder, "documents")
    reviews = views.document_reviews(documents, views.source_lang(), stars="stars").drop("name")
    if review_id is not None:
        reviews = reviews.withColumn("review_id", review_id)
    businesses = documents.groupBy(views.source_lang().alias("business_id")).agg(
        F.min("source").alias("name"),
        F.min("lang").alias("categories"),
        F.avg("n_chars").alias("stars"),
    )
    return insights.run(reviews, businesses, params)


@query
def review_insights(spark, folder):
    """Over drawn businesses."""
    return _insights(spark, folder, INSIGHTS)


@query
def review_insights_all(spark, folder):
    """Over all eligible businesses."""
    return _insights(spark, folder, INSIGHTS_ALL)


@query
def review_insights_repeated(spark, folder):
    """Over all eligible businesses, and three documents share a review id."""
    thirds = F.expr("cast(ordinal div 3 AS string)")
    return _insights(spark, folder, INSIGHTS_ALL, thirds)
