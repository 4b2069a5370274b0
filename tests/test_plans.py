"""The shape of plans, and results that must not hang on partitioning."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import clean, quality, ranking, retrieve, select
from reviewloom.plans import views
from reviewloom.plans.queries import PARAMS, QUERIES, SELECTION


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_scoring_moves_no_vectors(spark, folder):
    scored = retrieve.score(views.stored_vectors(spark, folder), views.topic_vectors(spark))
    text = plan(scored)
    assert "Exchange" not in text and "Join" not in text


def test_retrieval_limits_groups_before_every_shuffle(spark, folder):
    vectors = views.stored_vectors(spark, folder).withColumn("chunk", F.lit("wide"))
    top = retrieve.score_topk(vectors, views.topic_vectors(spark))
    text = plan(top)
    # one shuffle for the parts, one for the whole groups
    assert exchanges(text) == 2 and text.count("Partial") == 2 and "Join" not in text
    below = text[text.index("MapInPandas"):]
    assert "Exchange" not in below and "wide" not in below


def test_a_task_keeps_k_rows_of_a_group(spark):
    """Salts are whole map tasks, so salting does not multiply what a task keeps."""
    df = spark.range(4000).select(
        F.lit("b").alias("business_id"), F.lit("t").alias("topic"), F.col("id").cast("string").alias("chunk_id"),
        F.rand(1).alias("score"),
    ).repartition(3)
    text = plan(retrieve.topic_topk(df, 5))
    assert "SPARK_PARTITION_ID" in text and re.search(r"WindowGroupLimit .*row_number\(\), 5, Partial", text)


def test_dedup_keeps_one_row_per_text_before_the_shuffle(spark, folder):
    reviews = views.document_reviews(views.table(spark, folder, "documents"))
    text = plan(clean.clean_dedup(reviews))
    assert exchanges(text) == 1
    before = text[text.index("Exchange hashpartitioning"):]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", before)


@pytest.mark.parametrize("name", ["topic_retrieval", "review_insights", "chunk_sliding"])
def test_the_python_step_runs_once(spark, folder, name):
    # once in every branch that reads the text: clean, for the vectors and for the winners' text
    assert plan(QUERIES[name](spark, folder)).count("normalize(") in (1, 2)


SQL_ONLY = [
    "head_rows", "eligible_keys", "select_entities", "index_stats", "count_histogram", "review_business_join",
]


@pytest.mark.parametrize("name", SQL_ONLY)
def test_no_python_in_pure_expressions(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_anywhere(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_what_is_needed(spark, folder):
    text = plan(QUERIES["eligible_keys"](spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    text = plan(QUERIES["category_filter"](spark, folder))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_selection_never_shuffles_wide_reviews(spark, folder):
    """Also when Spark may not broadcast by itself: no shuffle lies above the wide scan."""
    reviews = views.part_reviews(spark, folder).withColumn("text", F.rpad(F.col("review_id").cast("string"), 9, "w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(select.sample_reviews(reviews, views.parts(spark, folder), SELECTION))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = text.index("BroadcastHashJoin")
    wide = text[join : text.index("BroadcastExchange")]  # the left, wide side comes first
    assert "rpad" in wide and "Exchange hashpartitioning" not in wide


def test_a_run_without_a_sample_takes_all_eligible_businesses(spark, folder):
    everything = dataclasses.replace(SELECTION, n_entities=None)
    reviews, parts = views.part_reviews(spark, folder), views.parts(spark, folder)
    wanted = select.category_filter(parts, "categories", SELECTION.include, SELECTION.exclude)
    eligible = select.eligible_keys(reviews, "business_id", "review_id", SELECTION.min_reviews)
    want = {r[0] for r in eligible.join(wanted, "business_id", "left_semi").select("business_id").collect()}
    got = select.sample_reviews(reviews, parts, everything)
    assert {r[0] for r in got.select("business_id").distinct().collect()} == want


def test_hot_business_in_the_join(spark):
    """One business holds half of all reviews."""
    reviews = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 97).alias("business_id"), F.col("id").alias("review_id")
    )
    businesses = spark.range(97).select(F.col("id").alias("business_id"), F.lit("n").alias("name"))
    assert select.join_entities(reviews, businesses).count() == 20_000


def test_broadcast_hint_needs_a_small_bound(spark):
    df = spark.range(10)
    assert "hint" in ranking.hint_small(df, 10)._jdf.queryExecution().logical().toString().lower()
    large = ranking.hint_small(df, ranking.BROADCAST_ROWS + 1)
    assert "hint" not in large._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("name", ["select_entities", "dedup_text", "topic_retrieval", "summary_by_name", "head_rows"])
def test_results_do_not_hang_on_partitioning(spark, folder, name, monkeypatch):
    want = sorted(map(str, QUERIES[name](spark, folder).collect()))
    read = views.table
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def shuffled(s, f, t):
        return read(s, f, t).orderBy(F.rand(5)).repartition(11)

    monkeypatch.setattr("reviewloom.plans.queries.table", shuffled)
    monkeypatch.setattr("reviewloom.plans.views.table", shuffled)
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(map(str, QUERIES[name](spark, folder).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_report_of_a_table_that_is_mostly_one_text(spark):
    df = spark.range(3000).select(
        F.col("id").alias("ordinal"),
        F.when(F.col("id") % 3 < 2, F.lit("the same words " * 4)).otherwise(
            F.concat(F.lit("a longer text with a number of its own "), "id")
        ).alias("text"),
    ).repartition(13)
    report = quality.cleaning_report(df).first().asDict()
    assert report == {"n_input": 3000, "n_clean": 3000, "n_unique": 1001, "dropped_cleaning": 0, "dropped_dedup": 1999}
    kept = clean.clean_dedup(df, dataclasses.replace(PARAMS))
    assert kept.count() == 1001 and kept.agg(F.min("ordinal")).first()[0] == 0


def test_cleaning_and_chunking_run_on_a_stream(spark, folder, tmp_path):
    from reviewloom.streaming.chunks import append_chunks

    read = views.table(spark, folder, "documents")
    read.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(read.schema).parquet(str(tmp_path / "in"))
    reviews = views.document_reviews(source)
    append_chunks(reviews, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("chunk_id", "chunk")
    from reviewloom.operators.chunk import review_chunks

    want = review_chunks(clean.clean_text(views.document_reviews(read))).select("chunk_id", "chunk")
    assert sorted(got.collect()) == sorted(want.collect())
