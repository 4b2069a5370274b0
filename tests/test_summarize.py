"""Prompts, summaries and the reader's view."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import present, summarize
from reviewloom.params import TOPICS, Params
from reviewloom.plans import insights, views
from reviewloom.plans.queries import INSIGHTS
from reviewloom.sources import tables

FOUND = "topic string, rank int, business_id string, restaurant_name string, stars double, chunk string"
ROWS = [
    ("food", 2, "b1", "Joe's", 4.0, "Second one. More."),
    ("food", 1, "b1", "Joe's", 5.0, "Best one! More."),
    ("service", 1, "b1", "Joe's", 1.0, "Slow."),
    ("food", 1, "b2", "Ann", 3.0, "Fair"),
]


@pytest.fixture
def found(spark):
    return spark.createDataFrame(ROWS, FOUND)


def by_key(df, value):
    return {(r.business_id, r.topic): r[value] for r in df.collect()}


def test_prompt_text_is_exact(found):
    prompts = by_key(summarize.build_prompts(found, list(TOPICS)), "prompt")
    assert len(prompts) == 6
    text = prompts[("b1", "food")]
    pad, deep = "\n" + " " * 16, "\n" + " " * 20
    assert text.startswith(pad + "You are analyzing and synthesizing customer reviews for a restaurant called Joe's, where")
    assert pad + pad + "Topic: FOOD\n" in text
    assert "summary of Joe's's performance in the area of food.\n" in text
    first = deep + "[0] Review (5.0 stars):" + deep + "Best one! More." + deep
    second = deep + "[1] Review (4.0 stars):" + deep + "Second one. More." + deep
    assert text.endswith("reviews.’”\n" + pad + first + second)
    assert prompts[("b1", "ambiance")].endswith("reviews.’”\n" + pad)
    counts = by_key(summarize.build_prompts(found, list(TOPICS)), "n_excerpts")
    assert counts[("b1", "food")] == 2 and counts[("b1", "ambiance")] == 0


def test_entities_without_any_excerpt_get_prompts(spark, found):
    entities = spark.createDataFrame([("b1", "Joe's"), ("b9", "New")], "business_id string, restaurant_name string")
    counts = by_key(summarize.build_prompts(found, ["food", "service"], entities), "n_excerpts")
    assert counts == {("b1", "food"): 2, ("b1", "service"): 1, ("b9", "food"): 0, ("b9", "service"): 0}


def test_offline_summaries(found):
    got = by_key(summarize.offline_summaries(found, list(TOPICS)), "summary")
    assert got[("b1", "food")] == "Positive reviews. Best one! Second one."
    assert got[("b1", "service")] == "Negative reviews. Slow."
    assert got[("b2", "food")] == "Mixed reviews. Fair"
    assert got[("b2", "service")] == "service details are limited in the provided reviews."


def test_generated_summaries_are_one_line(found):
    prompts = summarize.build_prompts(found, ["food"])
    made = summarize.generate(prompts, "prompt", lambda: lambda p: f"\n a\n{p.count('Review (')} ", parallelism=2)
    assert by_key(made, "summary") == {("b1", "food"): "a 2", ("b2", "food"): "a 1"}


def test_failing_client(spark):
    def factory():
        failed = []

        def client(prompt):
            if prompt == "bad":
                raise TimeoutError("too slow")
            if prompt not in failed:
                failed.append(prompt)
                raise ConnectionError("once")
            return prompt.upper()

        return client

    df = spark.createDataFrame([("ok",), ("bad",)], "prompt string").coalesce(1)
    made = summarize.generate(df, "prompt", factory, retries=1, backoff=0.0, on_error="column")
    assert {tuple(r) for r in made.collect()} == {("ok", "OK", None), ("bad", None, "too slow")}
    with pytest.raises(Exception, match="too slow"):
        summarize.generate(df, "prompt", factory, retries=1, backoff=0.0).collect()
    with pytest.raises(ValueError):
        summarize.generate(df, "prompt", factory, on_error="ignore")


def test_two_businesses_with_one_name(spark):
    rows = [(b, "Same", t, f"{b} {t}") for b in ("a", "b") for t in TOPICS]
    long = spark.createDataFrame(rows, "business_id string, restaurant_name string, topic string, summary string")
    wide = summarize.pivot_summaries(long, list(TOPICS))
    assert wide.count() == 2
    named = summarize.summaries_by_name(wide, list(TOPICS)).collect()
    assert [tuple(r) for r in named] == [("Same", "b food", "b service", "b ambiance")]


def test_view(spark):
    rows = [
        (" Zed ", "f", None, "a", 1), (" Ann\t", "f2", "s2", "a2", 3), ("Ann", "f1", "s1", "a1", 2), (None, "x", "x", "x", 4),
    ]
    df = spark.createDataFrame(rows, "restaurant_name string, food string, service string, ambiance string, ordinal int")
    view = present.summary_view(df, order="ordinal")
    assert [tuple(r) for r in view.collect()] == [
        ("Ann", "f1", "s1", "a1"),
        ("Zed", "f", "No service summary available.", "a"),
    ]
    assert present.lookup(view, "Zed").first().food == "f"
    with pytest.raises(ValueError, match="service"):
        present.summary_view(df.drop("service"))


def inputs(spark, folder):
    documents = views.table(spark, folder, "documents")
    reviews = views.document_reviews(documents, views.source_lang(), stars="stars").drop("name")
    businesses = documents.groupBy(views.source_lang().alias("business_id")).agg(
        F.min("source").alias("name"), F.min("lang").alias("categories"), F.avg("n_chars").alias("stars"),
        F.min("doc_id").alias("ordinal"),
    )
    return reviews, businesses


def test_staged_run_equals_lazy_run(spark, folder, tmp_path):
    reviews, businesses = inputs(spark, folder)
    lazy = sorted(insights.run(reviews, businesses, INSIGHTS).collect())
    out = str(tmp_path / "out")
    staged = insights.run(reviews, businesses, INSIGHTS, out=out)
    assert sorted(staged.collect()) == lazy and lazy
    chunks = tables.read_table(spark, f"{out}/review_chunks")
    vectors = tables.read_vectors(spark, f"{out}/chunk_vectors", buckets=INSIGHTS.vector_buckets)
    assert chunks.count() == vectors.count() > 0
    found = tables.read_table(spark, f"{out}/topic_relevant_review_chunks")
    assert found.columns == list(insights.retrieve.RESULT_COLUMNS)
    report = {r.stage: (r.n_rows, r.n_keys) for r in tables.read_table(spark, f"{out}/run_report").collect()}
    assert report["review_chunks"] == (chunks.count(), 10)
    assert report["summaries_long"] == (30, 10)
    cleaning = tables.read_table(spark, f"{out}/cleaning_report").first()
    assert cleaning.n_input == report["reviews_df"][0] >= cleaning.n_clean >= cleaning.n_unique > 0
    empty = tables.read_table(spark, f"{out}/empty_topics").count()
    assert empty + found.select("business_id", "topic").distinct().count() == 30


def test_staged_run_equals_lazy_run_when_review_ids_repeat(spark, folder, tmp_path):
    """Every review has the id of its business: one excerpt each, under a cap of one."""
    reviews, businesses = inputs(spark, folder)
    reviews = reviews.withColumn("review_id", F.expr("cast(ordinal div 4 AS string)"))
    params = dataclasses.replace(INSIGHTS, n_entities=None, min_reviews=1)
    lazy = sorted(insights.run(reviews, businesses, params).collect())
    out = str(tmp_path / "out")
    assert sorted(insights.run(reviews, businesses, params, out=out).collect()) == lazy and lazy
    found = tables.read_table(spark, f"{out}/topic_relevant_review_chunks")
    assert found.groupBy("business_id", "topic", "review_id").count().agg(F.max("count")).first()[0] == 1
    assert found.groupBy("business_id", "topic", "rank").count().agg(F.max("count")).first()[0] == 1


def test_excerpts_without_stars_stay_in_the_prompt(spark):
    rows = [("b", "n", "food", 1, None, "first"), ("b", "n", "food", 2, 3.0, "second")]
    found = spark.createDataFrame(rows, "business_id string, restaurant_name string, topic string, rank int, stars double, chunk string")
    row = summarize.build_prompts(found, ["food"]).first()
    assert row.n_excerpts == row.prompt.count("Review (") == 2 and "first" in row.prompt


def test_a_call_without_an_answer_is_given_up(spark):
    def factory():
        import time

        return lambda p: time.sleep(30) or "late"

    df = spark.createDataFrame([("p",)], "prompt string")
    made = summarize.generate(df, "prompt", factory, retries=0, on_error="column", timeout=0.5).first()
    assert made.summary is None and "no answer" in made.error


def json_inputs(folder):
    """Four restaurants; the hotel is excluded, and one has too few reviews."""
    names = [("b0", "Grand Hotel", "Hotels, Restaurants"), ("b1", "Joe's", "Restaurants"),
             ("b2", "Ann", "Pizza, Restaurants"), ("b3", "Tiny", "Restaurants")]
    texts = ["The food had fresh taste and spicy flavor. Nice number {}.", "The staff was rude, wait time {} minutes. Never."]
    businesses = [
        {"business_id": b, "name": n, "address": "a", "city": "c", "state": "s", "postal_code": "p", "latitude": 1.0,
         "longitude": 2.0, "stars": 4.0, "review_count": 3, "is_open": 1, "attributes": {"x": "y"}, "categories": c,
         "hours": {"Monday": "9-5"}}
        for b, n, c in names
    ]
    reviews = [
        {"review_id": f"r{b}{i}", "user_id": "u", "business_id": b, "stars": 5.0 - i % 2 * 4, "useful": 0, "funny": 0,
         "cool": 0, "text": texts[i % 2].format(f"{b} {i}"), "date": "2020-01-01 00:00:00"}
        for b, n in (("b0", 9), ("b1", 6), ("b2", 8), ("b3", 2)) for i in range(n)
    ]
    for name, rows in (("reviews", reviews), ("businesses", businesses)):
        (folder / name).mkdir()
        (folder / name / "part.json").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    return str(folder / "reviews"), str(folder / "businesses")


def test_run_on_files(spark, tmp_path):
    paths = json_inputs(tmp_path)
    params = Params(min_reviews=4, n_entities=2, max_per_topic=1)
    rows = {r.restaurant_name: r for r in insights.run_files(spark, *paths, params).collect()}
    assert set(rows) == {"Joe's", "Ann"}
    assert rows["Ann"].food.startswith("Positive reviews. The food had fresh taste")
    assert rows["Ann"].service.startswith("Negative reviews. The staff was rude, wait time b2")
    capped = Params(min_reviews=4, n_entities=2, head_rows=3)
    with pytest.raises(Exception, match="cannot draw 2 entities, eligible: 0"):
        insights.run_files(spark, *paths, capped).collect()


def test_run_with_a_client(spark, tmp_path):
    calls = insights.generated(lambda: lambda p: "said\nso", parallelism=2)
    params = Params(min_reviews=4, n_entities=2)
    rows = insights.run_files(
        spark, *json_inputs(tmp_path), params, summarizer=calls, out=str(tmp_path / "out")
    ).collect()
    assert sorted(tuple(r) for r in rows) == [(n, *["said so"] * 3) for n in ("Ann", "Joe's")]


def test_defaults_match_the_documented_ones():
    p = Params()
    assert (p.head_rows, p.min_reviews, p.n_entities, p.seed) == (None, 100, 10, 1)
    assert (p.min_chars, p.chunk_size, p.overlap, p.min_chunk) == (30, 1000, 200, 230)
    assert (p.top_k, p.max_per_topic, p.max_per_review, p.batch_size) == (25, 12, 1, 64)
