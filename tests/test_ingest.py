"""Inputs, outputs and selection."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from reviewloom import schemas
from reviewloom.operators import select
from reviewloom.operators.present import require_columns
from reviewloom.operators.clean import clean_dedup
from reviewloom.operators.ranking import head_rows
from reviewloom.params import Params
from reviewloom.sources import jsonl, tables

REVIEW = "review_id string, business_id string, stars double, text string"
BUSINESS = "business_id string, name string, categories string, stars double, hours map<string,string>"


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_jsonl_with_schema(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [json.dumps({"review_id": "r1", "stars": 4.0, "text": "é"}), ""])
    df = jsonl.read_jsonl(spark, str(tmp_path / "in"), schemas.REVIEWS)
    assert df.drop("ordinal").schema == schemas.REVIEWS
    assert [(r.review_id, r.stars, r.text, r.date) for r in df.collect()] == [("r1", 4.0, "é", None)]


@pytest.mark.parametrize("head", [None, 10])
def test_malformed_line_fails(spark, tmp_path, head):
    write_lines(tmp_path / "in", "a.json", ['{"review_id": "r1"}', '{"review_id":'])
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_jsonl(spark, str(tmp_path / "in"), schemas.REVIEWS, head).collect()


def test_lenient_reader_keeps_bad_lines_apart(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", ['{"review_id": "r1"}', '{"review_id":', "", '{"review_id": "r2"}'])
    good, bad = jsonl.read_jsonl_lenient(spark, str(tmp_path / "in"), schemas.REVIEWS)
    assert sorted(r.review_id for r in good.collect()) == ["r1", "r2"]
    assert [r.line for r in bad.collect()] == ['{"review_id":']
    assert good.columns == schemas.REVIEWS.names


def test_lines_are_ordered_as_in_the_files_over_many_splits(spark, tmp_path):
    want = []
    for name, n in (("a.txt", 50), ("b.txt", 4000), ("c.txt", 7)):
        lines = [f"{name} {i} {'x' * (i % 50)}" for i in range(n)]
        write_lines(tmp_path / "in", name, lines)
        want += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = jsonl.ordered_lines(spark, str(tmp_path / "in"))
        assert df.rdd.getNumPartitions() > 8
        assert [r.value for r in df.orderBy("ordinal").collect()] == want
        for n in (0, 50, 53, 2500, len(want), 10**6):
            head = jsonl.head_lines(spark, str(tmp_path / "in"), n)
            assert [r.value for r in head.orderBy("ordinal").collect()] == want[:n]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_head_applies_to_each_input_before_the_join(spark, tmp_path):
    write_lines(tmp_path / "b", "b.json", [json.dumps({"business_id": f"b{i}"}) for i in range(5)])
    schema = ST.StructType().add("business_id", "string")
    businesses = jsonl.read_jsonl(spark, str(tmp_path / "b"), schema, head=3)
    reviews = spark.createDataFrame([("r1", "b3"), ("r2", "b2")], "review_id string, business_id string")
    joined = select.join_entities(reviews, businesses.drop("ordinal"))
    assert [r.review_id for r in joined.collect()] == ["r2"]


def test_head_rows_of_sparse_ids(spark):
    """Ids over the whole 64-bit range; windows without partition would sort them in one task."""
    ids = [(i * 6364136223846793005 + 1442695040888963407) % 2**64 - 2**63 for i in range(3000)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(5)
    for n in (1, 1234, 2999):
        got = head_rows(df, n, "id", fan_out=16, enough=50)
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in got.collect()) == sorted(ids)[:n]


def test_dedup_winner_does_not_depend_on_a_cap(spark, tmp_path):
    text = "one text that is long enough to be kept as a review"
    rows = [json.dumps({"review_id": r, "business_id": "b", "text": text}) for r in ("z9", "a1")]
    write_lines(tmp_path / "r", "r.json", rows)
    for head in (None, 2, 1000):
        reviews = jsonl.read_jsonl(spark, str(tmp_path / "r"), schemas.REVIEWS, head)
        assert [r.review_id for r in clean_dedup(reviews).collect()] == ["z9"]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 500, 999, 1000, 5000])
def test_head_rows_is_exact(spark, n):
    df = spark.range(-300, 2700, 3).withColumn("v", F.col("id") * 2).repartition(7)
    got = sorted(r.id for r in head_rows(df, n, "id", fan_out=7, enough=5).collect())
    assert got == sorted(r.id for r in df.collect())[:n]


def test_csv_round_trip_with_newlines_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "q"\ny, z'), ("b", None)], "id string, text string")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_of_nested_columns(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS id, map('k', 'v') AS m, array(1, 2) AS l")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), ST.StructType().add("id", "string").add("m", "string").add("l", "string"))
    assert tuple(back.first()) == ("a", '{"k":"v"}', "[1,2]")


VECTORS = [("007", "c1", [1.0, 0.0]), ("7", "c2", [0.0, 1.0]), ("x/y", "c3", [1.0, 1.0]), ("7", "c4", [2.0, 0.0])]


@pytest.mark.parametrize("buckets", [None, 3])
def test_vector_table_by_business(spark, tmp_path, buckets):
    path = str(tmp_path / "v")
    df = spark.createDataFrame(VECTORS, "business_id string, chunk_id string, embedding array<float>")
    tables.write_vectors(df, path, buckets=buckets)
    assert sorted(map(tuple, tables.read_vectors(spark, path).select("business_id", "chunk_id").collect())) == sorted(
        (b, c) for b, c, _ in VECTORS
    )
    one = tables.read_vectors(spark, path, "7", buckets=buckets)
    assert sorted(r.chunk_id for r in one.collect()) == ["c2", "c4"]
    assert "PartitionFilters: [isnotnull(vector_folder" in one._jdf.queryExecution().toString()


def test_vector_refresh_replaces_only_its_business(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.createDataFrame(VECTORS, "business_id string, chunk_id string, embedding array<float>")
    tables.write_vectors(df, path)
    fresh = spark.createDataFrame([("7", "c9", [1.0, 1.0])], df.schema)
    tables.write_vectors(fresh, path, refresh=True)
    ids = sorted(r.chunk_id for r in tables.read_vectors(spark, path).collect())
    assert ids == ["c1", "c3", "c9"]
    tables.write_vectors(fresh, path)
    assert [r.chunk_id for r in tables.read_vectors(spark, path).collect()] == ["c9"]


def test_stage_table_is_replaced(spark, tmp_path):
    for n in (3, 2):
        tables.write_table(spark.range(n), str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 2


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['b'\]"):
        require_columns(spark.range(1).toDF("a"), ["a", "b"])


def test_null_policies_and_null_keys(spark):
    reviews = spark.createDataFrame(
        [("r1", "b1", 5.0, "t"), ("r2", None, 5.0, "t"), ("r3", "b2", float("nan"), "t")], REVIEW
    )
    businesses = spark.createDataFrame(
        [("b1", "n", "c", 3.0, None), (None, "n", "c", 3.0, {"a": None}), ("b2", "m", "c", 3.0, {"a": None})], BUSINESS
    )
    assert select.join_entities(reviews, businesses).count() == 0
    loose = select.join_entities(reviews, businesses, null_policy="required")
    assert sorted(r.review_id for r in loose.collect()) == ["r1", "r3"]
    assert {"stars_reviews", "stars_restaurant"} <= set(loose.columns)
    full = select.join_entities(reviews.fillna(1.0), businesses)
    assert [r.review_id for r in full.collect()] == ["r3"]
    with pytest.raises(ValueError):
        select.drop_nulls(reviews, "some")


def test_category_filter(spark):
    names = ["RESTAURANTS, Bars", "Restaurants, Hotels", "Cinema restaurant", "Bars", None]
    df = spark.createDataFrame([(n,) for n in names], "categories string")
    kept = select.category_filter(df, "categories", "restaurant", "hotel|cinema")
    assert [r.categories for r in kept.collect()] == ["RESTAURANTS, Bars"]


def test_threshold_is_strict_and_counts_distinct_reviews(spark):
    rows = [("a", f"r{i}") for i in range(3)] + [("b", f"r{i}") for i in range(4)] + [("c", "r")] * 9
    df = spark.createDataFrame(rows, "business_id string, review_id string")
    assert [r.business_id for r in select.eligible_keys(df, "business_id", "review_id", 3).collect()] == ["b"]


def test_sample_is_stable_and_strict(spark):
    keys = spark.range(50).select(F.col("id").cast("string").alias("k"))
    drawn = [
        sorted(r.k for r in select.sample_keys(keys.repartition(n), "k", 7, seed=3).collect()) for n in (1, 8)
    ]
    assert drawn[0] == drawn[1] and len(set(drawn[0])) == 7
    strict = select.sample_keys(keys, "k", 7, seed=3, strict=True)
    assert sorted(r.k for r in strict.collect()) == drawn[0]
    assert sorted(r.k for r in select.sample_keys(keys, "k", 7, seed=4).collect()) != drawn[0]
    assert select.sample_keys(keys, "k", 7, seed=None).count() == 7
    for few in (keys, keys.limit(0)):
        with pytest.raises(Exception, match="cannot draw 51"):
            select.sample_keys(few, "k", 51, strict=True).collect()


def test_sample_reviews_joins_whole_businesses(spark):
    reviews = spark.createDataFrame(
        [(f"r{b}{i}", f"b{b}", 4.0, "t") for b in range(4) for i in range(b + 2)], REVIEW
    )
    businesses = spark.createDataFrame(
        [(f"b{b}", "n", "Restaurant" if b else "Hotel restaurant", 3.0, {"a": "b"}) for b in range(4)], BUSINESS
    )
    p = Params(min_reviews=2, n_entities=3)
    got = select.sample_reviews(reviews, businesses, p)
    assert sorted({r.business_id for r in got.select("business_id").collect()}) == ["b1", "b2", "b3"]
    assert got.count() == 3 + 4 + 5
