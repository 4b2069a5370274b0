"""Forms that move no text, no vectors and no hot key: their plans, and results under small bounds."""

import re
import unicodedata

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import text
from reviewloom.functions import vectors as V
from reviewloom.operators import clean, embed, quality, ranking, retrieve, select
from reviewloom.plans import incremental, insights, queries, views
from reviewloom.plans.queries import INSIGHTS, PARAMS, _insights
from reviewloom.sources import jsonl, tables

from test_plans import plan


@pytest.fixture
def by_hand(spark):
    """Spark may neither broadcast nor split skewed partitions by itself."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for n, value in zip(names, ("-1", "false")):
        spark.conf.set(n, value)
    yield
    for n, value in zip(names, before):
        spark.conf.set(n, value)


# --- duplicates by digest -----------------------------------------------------------


@pytest.mark.parametrize("most", [1 << 20, 40, 1])
def test_stored_dedup_equals_the_lazy_one(spark, folder, tmp_path, most):
    """Also when places go out in several blocks of files; one text is a third of all rows."""
    reviews = views.document_reviews(views.table(spark, folder, "documents"))
    hot = F.when(F.col("ordinal") % 3 == 0, F.lit("one text that stands in a third of all rows")).otherwise(F.col("text"))
    cleaned = clean.clean_text(reviews.withColumn("text", hot)).repartition(5)
    unique, dropped = clean.stored_unique(cleaned, str(tmp_path), most=most)
    want = {(r.review_id, r.text) for r in clean.dedup_text(cleaned).collect()}
    got = [(r.review_id, r.text) for r in unique.collect()]
    assert len(got) == len(want) and set(got) == want and unique.columns == cleaned.columns
    assert dropped == cleaned.count() - len(want)
    scans = plan(unique.select("*")).count("LeftAnti")
    assert scans == 1 if most > 1000 else scans > 1


def test_stored_dedup_moves_no_text(spark, folder, tmp_path, by_hand):
    cleaned = clean.clean_text(views.document_reviews(views.table(spark, folder, "documents")))
    unique, _ = clean.stored_unique(cleaned, str(tmp_path))
    text = plan(unique)
    assert "Exchange hashpartitioning" not in text and "Sort " not in text and "BroadcastHashJoin" in text
    stored = tables.read_table(spark, f"{tmp_path}/clean")
    narrow = plan(clean.repeated_places(stored, "ordinal"))
    assert "text" not in narrow  # the scan itself reads digests and orders only


def test_stored_dedup_of_repeated_and_null_orders(spark, tmp_path):
    rows = [("a", "same", 1), ("b", "same", 1), ("c", "same", None), ("d", "other", None), ("e", "other", 7)]
    df = spark.createDataFrame(rows, "review_id string, text string, ordinal int").repartition(3)
    unique, dropped = clean.stored_unique(df, str(tmp_path))
    assert sorted(r.text for r in unique.collect()) == ["other", "same"] and dropped == 3
    none, dropped = clean.stored_unique(df.limit(0), str(tmp_path / "none"))
    assert none.count() == 0 and dropped == 0


def test_file_blocks():
    for most in (1, 6, 100):
        counts = {3: 5, -1: 2, 2: 4, 9: 50, 10: 0}
        blocks = tables.file_blocks(counts, most)
        held = [[c for f, c in counts.items() if a <= f <= z] for a, z in blocks]
        assert sum(map(sum, held)) == 61 and sum(map(len, held)) == 5
        assert all(sum(h) <= most or len([c for c in h if c]) == 1 for h in held)


def test_a_staged_run_cleans_once_and_reports_the_same(spark, folder, tmp_path, monkeypatch):
    reviews = views.document_reviews(views.table(spark, folder, "documents"), views.source_lang())
    _, counts = clean.clean_stage(reviews, str(tmp_path / "c"), PARAMS)
    want = quality.cleaning_report(reviews).first().asDict()
    assert quality.counted_report(reviews, counts).first().asDict() == want

    calls = []
    monkeypatch.setattr(clean, "clean_text", lambda *a, f=clean.clean_text, **k: calls.append(1) or f(*a, **k))
    monkeypatch.setattr(insights, "run", lambda *a, f=insights.run: f(*a, out=str(tmp_path / "run")))
    staged = sorted(map(tuple, _insights(spark, folder, INSIGHTS).collect()))
    monkeypatch.undo()
    assert len(calls) == 1
    assert staged == sorted(map(tuple, _insights(spark, folder, INSIGHTS).collect()))
    assert tables.read_table(spark, str(tmp_path / "run/cleaning_report")).count() == 1


# --- many queries --------------------------------------------------------------------


def search_tables(spark):
    vectors = spark.range(700).select(
        F.col("id").cast("string").alias("chunk_id"), (F.col("id") % 3).cast("string").alias("business_id"),
        F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(5)).cast("float")).alias("embedding"),
    ).repartition(3)
    queries = spark.range(90).select(
        F.col("id").cast("string").alias("topic"),
        F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.pmod(F.hash("id", i), F.lit(3)).cast("float")).alias("qvec"),
    )
    return vectors, queries


@pytest.mark.parametrize("metric", ["ip", "l2", "cosine"])
@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_block_search_equals_search_with_a_list(spark, monkeypatch, metric, broadcast):
    """Several query blocks, broadcast or dealt; small numbers make many ties."""
    vectors, queries = search_tables(spark)
    listed = [(r.topic, r.qvec) for r in queries.collect()]
    want = sorted(map(tuple, retrieve.score_topk(vectors, listed, 4, metric).collect()))
    monkeypatch.setattr(retrieve, "BLOCK_BYTES", 300)
    monkeypatch.setattr(retrieve, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(retrieve, "BLOCK_ROWS", 50)
    got = retrieve.score_topk(vectors, queries, 4, metric)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 90 * 3 * 4


def test_the_plan_of_a_block_search_does_not_grow_with_queries(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "BLOCK_BYTES", 300)
    vectors, queries = search_tables(spark)
    plans = [plan(retrieve.score_topk(vectors, queries.limit(n), 4, few=0)) for n in (30, 90)]
    shapes = [re.findall(r"[A-Z][A-Za-z]+(?= |\n)", p) for p in plans]
    assert shapes[0] == shapes[1] and "BroadcastHashJoin" in plans[0] and "NestedLoop" not in plans[0]
    below = plans[0][plans[0].index("BroadcastHashJoin") : plans[0].index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in below  # vectors stay in place


def test_block_search_without_queries(spark):
    vectors, queries = search_tables(spark)
    assert retrieve.score_topk(vectors, queries.limit(0), 4, few=-1).count() == 0
    assert retrieve.score_topk(vectors, queries.limit(0), 4).count() == 0
    with pytest.raises(ValueError, match="use score_topk"):
        retrieve.score(vectors, queries)


def test_best_of_a_block_breaks_ties_by_id():
    own = pd.DataFrame({"business_id": ["x"] * 5 + [None] * 2, "chunk_id": list("edcbafg")})
    import numpy as np

    rows, queries = retrieve.block_best(own, np.ones((7, 2)), 2, "ip", ["chunk_id"])
    assert sorted(own.chunk_id[rows[queries == 1]]) == ["a", "b", "f", "g"]


# --- Python workers -------------------------------------------------------------------


def test_a_worker_holds_short_runs_and_few_terms():
    """Neither the batch nor the vocabulary nor the dimension says how much Python holds beside the batch."""
    import tracemalloc

    texts = [" ".join(f"t{i}x{j}" for j in range(50)) + " " + "q" * 3000 for i in range(2000)] + [None, ""]
    batch = pa.array(texts)
    plain = V.term_counter(64, known=10**9, values=1 << 40, size=1 << 40)
    whole = [row for part in plain(iter([batch])) for row in part.to_pylist()]
    tracemalloc.start()
    parts = list(V.term_counter(64, known=500, values=64 * 300, size=100_000)(iter([batch, batch.slice(0, 0)])))
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 4 << 20  # the texts alone are 7 MB
    assert max(map(len, parts)) < 60 and [row for part in parts for row in part.to_pylist()] == whole
    assert max(len(p) for p in V.term_counter(1 << 16)(iter([batch.slice(0, 20)]))) <= 4


def test_unstable_texts_are_normalized_in_runs(spark, monkeypatch):
    monkeypatch.setattr(text, "RUN_BYTES", 200)
    rows = [("ﬁ" * n + "Å",) for n in range(150)] + [(None,), ("plain",), ("x" * 999 + "²",)]
    df = spark.createDataFrame(rows, "t string").repartition(2).select("t", text.nfkc(F.col("t")).alias("n"))
    for r in df.collect():
        assert r.n == (r.t and unicodedata.normalize("NFKC", r.t))


# --- hot keys ------------------------------------------------------------------------


def skewed(spark, n=40_000):
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 997).alias("business_id"), F.col("id").alias("review_id")
    )


def test_heavy_keys_are_found_by_one_bounded_sketch(spark):
    heavy = select.heavy_keys(skewed(spark), "business_id", 8)
    assert list(heavy) == ["0"] and heavy["0"] >= 8
    assert select.heavy_keys(skewed(spark).limit(0), "business_id", 8) == {}
    assert select.heavy_keys(spark.range(1000).withColumnRenamed("id", "business_id"), "business_id", 8) == {}


def test_a_key_with_half_of_all_rows_is_spread(spark, by_hand):
    reviews, parts = skewed(spark), 8
    businesses = spark.range(997).select(F.col("id").alias("business_id"), F.lit("n").alias("name"))

    def sizes(df):
        counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return sorted([r["count"] for r in counts] + [0] * (parts - len(counts)))

    plain = sizes(select.join_entities(reviews, businesses))
    spread = sizes(select.join_entities(reviews, businesses, parts=parts))
    assert sum(plain) == sum(spread) == 40_000
    assert plain[-1] > 3 * plain[parts // 2] and spread[-1] < 3 * spread[parts // 2]


def test_a_hot_join_gives_the_rows_of_a_plain_one(spark):
    reviews = skewed(spark, 4000).withColumn("x", F.lit(1))
    businesses = spark.range(600).select((F.col("id") % 300).alias("business_id"), F.col("id").alias("x"))
    want = sorted(map(tuple, select.join_entities(reviews, businesses).collect()))
    assert sorted(map(tuple, select.join_entities(reviews, businesses, parts=4).collect())) == want


def test_broadcast_needs_a_measured_bound(spark):
    """Few keys, but one of them with many wide rows."""
    wide = spark.range(300).select((F.col("id") % 3).alias("business_id"), F.repeat(F.lit("w"), 1000).alias("name"))
    assert "broadcast" in ranking.hint_measured(wide, wide, "business_id", 2)._jdf.queryExecution().logical().toString().lower()
    small = ranking.hint_measured(wide, wide, "business_id", 2, most=150_000)
    assert "broadcast" not in small._jdf.queryExecution().logical().toString().lower()
    assert wide.agg(F.max(ranking.row_bytes(wide))).first()[0] == 1032


# --- lookups in place -----------------------------------------------------------------


def test_winners_are_looked_up_where_the_text_lies(spark, folder, tmp_path, by_hand):
    chunks = insights.prepared_chunks(views.document_reviews(views.table(spark, folder, "documents")), PARAMS)
    stored = tables.write_bucketed(chunks, str(tmp_path / "c"), "chunk_key")
    source = chunks.agg(F.min("business_id")).first()[0]
    details = tables.one_folder(stored, source).select("chunk_key", "chunk")
    ranked = tables.one_folder(stored, source).select("chunk_key", "business_id").limit(7)
    found = retrieve.attach(ranked.withColumns({"topic": F.lit("t"), "rank": F.lit(1)}), details)
    text = plan(found)
    join = text.index("ShuffledHashJoin")
    left = text[join : text.index("Exchange", join)]  # the first Exchange below the join is that of the winners
    assert "SelectedBucketsCount" in left and re.search(r"PartitionFilters: \[.*vector_folder", left) and "Sort" not in left
    assert found.count() == 7


# --- integrity ------------------------------------------------------------------------


def ids(spark, rows):
    return spark.createDataFrame(rows, "business_id string, chunk_key string")


def test_a_swapped_id_of_equal_counts_is_found(spark):
    v = ids(spark, [("a", "1"), ("a", "2"), ("b", "3"), (None, "4")])
    m = ids(spark, [("a", "1"), ("a", "9"), ("b", "3"), (None, "4")])
    assert [r.business_id for r in quality.differing_keys(v, m).collect()] == ["a"]
    got = sorted(map(tuple, quality.index_differences(v, m).collect()))
    assert got == [("a", "2", "metadata"), ("a", "9", "vector")]
    with pytest.raises(KeyError, match="do not pair"):
        quality.require_pairs(v, m)
    quality.require_pairs(v, v)
    with pytest.raises(KeyError, match="repeats"):
        quality.require_pairs(v, v.unionAll(ids(spark, [("b", "3")])))


# --- first lines of many files ----------------------------------------------------------


@pytest.mark.parametrize("at_once", [1000, 7, 1])
def test_first_lines_of_many_files(spark, tmp_path, at_once):
    want = []
    for i in range(40):
        lines = [f"{i}-{j}" for j in range(i % 5)]
        (tmp_path / f"f{i:03}.txt").write_text("".join(x + "\n" for x in lines))
        want += lines
    for n in (0, 1, 3, len(want) - 1, len(want), len(want) + 5):
        got = jsonl.head_lines(spark, str(tmp_path), n, at_once)
        assert [r.value for r in got.orderBy("ordinal").collect()] == want[:n]


def test_json_files_follow_the_bytes_of_the_rows(spark, folder, tmp_path, monkeypatch):
    """A task of the write takes about FILE_BYTES, however large the input is; order and lines stay."""
    reviews = views.document_reviews(views.table(spark, folder, "documents"))
    size = reviews.agg(F.sum(ranking.row_bytes(reviews))).first()[0]
    monkeypatch.setattr(jsonl, "FILE_BYTES", size // 20)
    jsonl.write_jsonl(reviews, str(tmp_path / "in"), "ordinal")
    files = sorted((tmp_path / "in").glob("part-*"))
    assert len(files) >= 16 and max(f.stat().st_size for f in files) < size / 4
    want = [r.review_id for r in reviews.orderBy("ordinal").collect()]
    got = jsonl.read_jsonl(spark, str(tmp_path / "in"), reviews.drop("ordinal").schema)
    assert [r.review_id for r in got.orderBy("ordinal").collect()] == want
    for name in ("json_lines", "json_head"):
        monkeypatch.setattr(queries.tables, "scratch", lambda spark, name=name: str(tmp_path / name))
        queries.QUERIES[name](spark, folder)
        assert len(list((tmp_path / name).glob("part-*"))) >= 16


def test_json_files_take_equal_bytes_where_long_texts_lie_together(spark, folder, tmp_path, monkeypatch):
    """A tenth of the rows, side by side, holds most of the bytes; they are spread over files like all others."""
    reviews = views.document_reviews(views.table(spark, folder, "documents"))
    last = reviews.agg(F.max("ordinal")).first()[0]
    long = F.when(F.col("ordinal") > 0.9 * last, F.repeat(F.lit("0123456789"), F.lit(10_000))).otherwise(F.col("text"))
    reviews = reviews.withColumn("text", long)
    monkeypatch.setattr(jsonl, "FILE_BYTES", reviews.agg(F.sum(ranking.row_bytes(reviews))).first()[0] // 20)
    want = [r.review_id for r in reviews.orderBy("ordinal").collect()]
    place = F.struct(F.lit("a").alias("file"), F.col("ordinal").alias("position"))  # as read_jsonl gives it
    for name, rows in (("number", reviews), ("struct", reviews.withColumn("ordinal", place))):
        jsonl.write_jsonl(rows, str(tmp_path / name), "ordinal")
        sizes = [f.stat().st_size for f in (tmp_path / name).glob("part-*")]
        assert len(sizes) >= 12 and max(sizes) < sum(sizes) / 6
        got = jsonl.read_jsonl(spark, str(tmp_path / name), reviews.drop("ordinal").schema)
        assert [r.review_id for r in got.orderBy("ordinal").collect()] == want


def test_json_of_few_rows_of_repeated_and_of_missing_places(spark, tmp_path):
    for i, places in enumerate(([], [7], [None, None], [3, 3, 3, 3, 3], [5, None, 1, 4, 2, 2, 3])):
        rows = spark.createDataFrame([(str(p), p) for p in places], "a string, place bigint")
        jsonl.write_jsonl(rows, str(tmp_path / str(i)), "place")
        want = [str(p) for p in sorted(places, key=lambda p: p or 0)]
        for head in (None, 3):
            got = jsonl.read_jsonl(spark, str(tmp_path / str(i)), rows.drop("place").schema, head)
            assert [r.a for r in got.orderBy("ordinal").collect()] == want[:head]


# --- batches ------------------------------------------------------------------------------


def test_a_batch_leaves_other_businesses_alone(spark, folder, tmp_path):
    store, calls = str(tmp_path / "store"), []

    class Counting(embed.HashedTermEmbedder):
        def add_vectors(self, df, text_col, out):
            calls.append(df.count())
            return super().add_vectors(df, text_col, out)

    def files(name):
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "store" / name).rglob("*.parquet")}

    def result(df):
        return sorted(map(str, df.collect()))

    reviews = views.document_reviews(views.table(spark, folder, "documents"), views.source_lang())
    sources = sorted(r[0] for r in reviews.select("business_id").distinct().collect())
    first = reviews.filter("ordinal % 7 <> 0")
    # the second batch: new texts of one business, and texts of the first again under other ids
    new = reviews.filter(F.col("business_id") == sources[0]).filter("ordinal % 7 = 0").withColumn("ordinal", F.col("ordinal") + 10**6)
    again = first.limit(50).withColumns({"ordinal": F.col("ordinal") + 2 * 10**6, "review_id": F.concat(F.lit("x"), "review_id")})
    second = new.unionByName(again)
    incremental.add_batch(spark, first, store, "one", PARAMS, Counting())
    before = {n: files(n) for n in ("chunks", "vectors", "retrieved")}
    calls.clear()
    got = result(incremental.add_batch(spark, second, store, "two", PARAMS, Counting()))
    whole = first.unionByName(second)
    want = insights.retrieved_chunks(embed.embed(insights.prepared_chunks(whole, PARAMS), "chunk"), PARAMS)
    assert got == result(want)
    fresh = insights.prepared_chunks(whole, PARAMS).filter(F.col("business_id") == sources[0]).count()
    assert calls[0] < fresh  # vectors were made for new chunks of one business
    for name in ("chunks", "vectors"):
        assert before[name].items() <= files(name).items()
    kept = before["retrieved"].items() & files("retrieved").items()
    assert len(before["retrieved"]) - len(kept) <= len({f.rsplit("/", 1)[0] for f in before["retrieved"]}) // 4 + 1
    # a batch run again changes nothing, and one without rows neither
    assert result(incremental.add_batch(spark, second, store, "two", PARAMS)) == got
    assert result(incremental.add_batch(spark, second.limit(0), store, "three", PARAMS)) == got


@pytest.mark.parametrize("most", [100_000, 0])
def test_winners_go_to_the_texts(spark, folder, tmp_path, by_hand, monkeypatch, most):
    """Winners that were counted as few are broadcast, and no text is shuffled; the rows are the same either way."""
    monkeypatch.setattr(retrieve, "FEW_WINNERS", most)
    reviews = views.document_reviews(views.table(spark, folder, "documents"))
    tables.write_table(insights.prepared_chunks(reviews, PARAMS), str(tmp_path / "c"))
    chunks = tables.read_table(spark, str(tmp_path / "c"))
    vectors = embed.embed(chunks.select("chunk_key", "chunk_id", "business_id", "review_id", "chunk"), "chunk").drop("chunk")
    details = chunks.select("chunk_key", "restaurant_name", "stars", "chunk")
    found = insights.retrieved_chunks(vectors, PARAMS, text_from=details, work=str(tmp_path / "ranked"))
    joins = re.findall("BroadcastHashJoin|ShuffledHashJoin", plan(found))
    assert joins == ["BroadcastHashJoin" if most else "ShuffledHashJoin"]
    want = insights.retrieved_chunks(vectors, PARAMS, text_from=details)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
