"""Vectors, search and integrity on small hand-made tables and by brute force."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import vectors as V
from reviewloom.operators import embed, explore, quality, retrieve

CHUNK = "chunk_id string, business_id string, review_id string, embedding array<float>"
TOPIC = "topic string, qvec array<float>"


def search(spark, rows, topics, **kw):
    found = retrieve.topic_retrieval(
        spark.createDataFrame(rows, CHUNK), spark.createDataFrame(topics, TOPIC), **kw
    )
    return found.orderBy("business_id", "topic", "rank").collect()


def brute_force(rows, topics, metric, k, per_review, per_topic):
    """All scores in numpy, sorted; the caps in plain Python."""
    out = []
    for topic, q in topics:
        q = np.asarray(q, dtype=np.float32).astype(float)
        for business in sorted({r[1] for r in rows}):
            scored = []
            for cid, b, rid, v in rows:
                if b != business:
                    continue
                v = np.asarray(v, dtype=np.float32).astype(float)
                if metric == "l2":
                    s = float(((v - q) ** 2).sum())
                else:
                    s = float((v * q).sum())
                    if metric == "cosine":
                        n = np.linalg.norm(v) * np.linalg.norm(q)
                        s = s / n if n else 0.0
                scored.append((round(s, 9), cid, rid))
            scored.sort(key=lambda x: (x[0] if metric == "l2" else -x[0], x[1]))
            seen, kept = {}, []
            for s, cid, rid in scored[:k]:
                seen[rid] = seen.get(rid, 0) + 1
                if seen[rid] <= per_review:
                    kept.append((business, topic, cid, s))
            out += kept[:per_topic]
    return sorted(out)


@pytest.mark.parametrize("metric", V.METRICS)
@pytest.mark.parametrize("dense", [True, False])
def test_search_equals_brute_force(spark, metric, dense):
    rng = np.random.default_rng(7)
    # integer vectors, so that many scores tie
    rows = [
        (f"c{i}", f"b{i % 4 if i % 3 else 0}", f"r{i // 3}", rng.integers(-2, 3, 40).tolist())
        for i in range(300)
    ]
    topics = [(t, (rng.integers(1, 4, 40) * (1 if dense else rng.integers(0, 2, 40))).tolist()) for t in "xyz"]
    rows = [(c, b, r, [float(x) for x in v]) for c, b, r, v in rows]
    topics = [(t, [float(x) for x in q]) for t, q in topics]
    got = search(spark, rows, topics, metric=metric, k=9, max_per_review=2, max_per_topic=6)
    want = brute_force(rows, topics, metric, 9, 2, 6)
    found = sorted((r.business_id, r.topic, r.chunk_id, r.score) for r in got)
    assert [x[:3] for x in found] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in found], [x[3] for x in want], atol=1e-8)


@pytest.mark.parametrize("metric", V.METRICS)
def test_blocks_of_topics_agree(spark, metric, monkeypatch):
    rng = np.random.default_rng(3)
    chunks = spark.createDataFrame(
        [(f"c{i}", f"b{i % 3}", f"r{i}", rng.normal(size=8).tolist()) for i in range(60)], CHUNK
    )
    topics = spark.createDataFrame([(f"t{i}", rng.normal(size=8).tolist()) for i in range(23)], TOPIC)
    whole = {(r.chunk_id, r.topic): r.score for r in retrieve.score(chunks, topics, metric).collect()}
    top = sorted(retrieve.score_topk(chunks, topics, 2, metric).collect())
    assert len(whole) == 60 * 23 and all(abs(whole[r.chunk_id, r.topic] - r.score) < 1e-8 for r in top)
    monkeypatch.setattr(retrieve, "BLOCK_BYTES", 5 * 8 * 4)
    assert sorted(retrieve.score_topk(chunks, topics, 2, metric, few=0).collect()) == top and len(top) == 23 * 3 * 2


def test_many_dense_topics(spark):
    rng = np.random.default_rng(5)
    chunks = spark.createDataFrame(
        [(f"c{i}", "b", f"r{i}", rng.normal(size=384).tolist()) for i in range(30)], CHUNK
    )
    vectors = {r.chunk_id: r.embedding for r in chunks.collect()}
    queries = [(f"t{i}", rng.normal(size=384).tolist()) for i in range(64)]
    scored = retrieve.score(chunks, queries).collect()
    assert len(scored) == 30 * 64
    by_name = dict(queries)
    assert all(abs(np.dot(vectors[r.chunk_id], by_name[r.topic]) - r.score) < 1e-8 for r in scored)


def test_repeated_chunk_ids_are_told_apart_by_their_key(spark):
    rows = [("c", "k1", "b", "r", [0.5, 0.0]), ("c", "k2", "b", "r", [0.9, 0.0]), ("d", "k3", "b", "q", [0.1, 0.0])]
    chunks = spark.createDataFrame(rows, "chunk_id string, chunk_key string, business_id string, review_id string, embedding array<float>")
    text = chunks.select("chunk_key", F.concat(F.lit("text of "), "chunk_key").alias("chunk"))
    found = retrieve.topic_retrieval(chunks, [("t", [1.0, 0.0])], text_from=text).orderBy("rank").collect()
    assert [(r.rank, r.chunk) for r in found] == [(1, "text of k2"), (2, "text of k3")]
    with pytest.raises(Exception, match="not unique"):
        retrieve.topic_retrieval(chunks.drop("chunk_key"), [("t", [1.0, 0.0])], text_from=text.withColumn("chunk_id", F.lit("c")).drop("chunk_key")).collect()


def test_cap_comes_after_top_k(spark):
    rows = [(f"c{i:02d}", "b", f"r{i % 2}", [1.0 - i / 100, 0.0]) for i in range(26)]
    assert len(search(spark, rows, [("t", [1.0, 0.0])])) == 2


def test_only_the_better_chunk_of_a_review(spark):
    rows = [("c1", "b", "r", [0.5, 0.0]), ("c2", "b", "r", [0.9, 0.0]), ("c3", "b", "q", [0.1, 0.0])]
    assert [r.chunk_id for r in search(spark, rows, [("t", [1.0, 0.0])])] == ["c2", "c3"]


def test_ties_go_to_the_smaller_chunk_id(spark):
    rows = [(f"c{i}", "b", f"r{i}", [1.0, 0.0]) for i in (3, 1, 2)]
    got = search(spark, rows, [("t", [1.0, 0.0])])
    assert [(r.rank, r.chunk_id) for r in got] == [(1, "c1"), (2, "c2"), (3, "c3")]


def test_few_chunks_are_not_padded(spark):
    rows = [(f"c{i}", "b", f"r{i}", [1.0, 0.0]) for i in range(3)]
    assert len(search(spark, rows, [("t", [1.0, 0.0])], k=25)) == 3


def test_metrics_differ_off_the_unit_sphere(spark):
    rows = [("long", "b", "r1", [3.0, 3.0]), ("near", "b", "r2", [1.0, 0.1]), ("zero", "b", "r3", [0.0, 0.0])]
    best = {m: search(spark, rows, [("t", [1.0, 0.0])], metric=m)[0].chunk_id for m in V.METRICS}
    assert best == {"ip": "long", "cosine": "near", "l2": "near"}
    cosine = search(spark, rows, [("t", [1.0, 0.0])], metric="cosine")
    assert [r.score for r in cosine if r.chunk_id == "zero"] == [0.0]


def test_unknown_metric_and_wrong_dimension(spark):
    with pytest.raises(ValueError, match="dot"):
        search(spark, [("c", "b", "r", [1.0])], [("t", [1.0])], metric="dot")
    with pytest.raises(Exception, match="expected 2 dimensions, found 1"):
        search(spark, [("c", "b", "r", [1.0])], [("t", [1.0, 0.0])])


def test_hot_business_over_many_tasks(spark):
    """A business with most rows, spread over many partitions, ranks as a whole."""
    df = spark.range(20_000).select(
        F.concat(F.lit("c"), "id").alias("chunk_id"),
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("b"), F.col("id") % 50)).alias("business_id"),
        F.col("id").cast("string").alias("review_id"),
        F.lit("t").alias("topic"),
        ((F.col("id") * 7919) % 10_007).cast("double").alias("score"),
    ).repartition(40)
    got = {(r.business_id, r.chunk_id) for r in retrieve.topic_topk(df, 5).collect()}
    plain = {(r.business_id, r.chunk_id) for r in retrieve.topic_topk(df, 5, salts=1).collect()}
    rows = df.collect()
    want = set()
    for b in {r.business_id for r in rows}:
        mine = sorted((r for r in rows if r.business_id == b), key=lambda r: (-r.score, r.chunk_id))
        want |= {(b, r.chunk_id) for r in mine[:5]}
    assert got == plain == want


def test_hashed_embedding_equals_python(spark):
    texts = ["Crêpes, crêpes & 2 more!", "", "ÉTÉ été Ete", "a " * 500, "???"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, chunk string")
    rows = {r.i: r.embedding for r in embed.embed(df, "chunk").collect()}
    for i, text in enumerate(texts):
        counts = [0] * 64
        for token in re.findall("[a-zà-ÿ0-9]+", text.lower()):
            counts[int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % 64] += 1
        n = math.sqrt(sum(c * c for c in counts))
        assert np.allclose(rows[i], [c / n if n else 0.0 for c in counts])


def test_model_embedder_batches(spark):
    def factory():
        def encode(texts):
            assert len(texts) <= 3
            return [[float(len(t)), 0.0] for t in texts]

        return encode

    df = spark.createDataFrame([("x" * i,) for i in range(20)], "chunk string").coalesce(1)
    raw = embed.embed(df, "chunk", embed.ModelEmbedder(factory, batch_size=3), normalize=False)
    assert {(len(r.chunk), *r.embedding) for r in raw.collect()} == {(i, float(i), 0.0) for i in range(20)}
    unit = embed.embed(df, "chunk", embed.ModelEmbedder(factory, batch_size=3))
    assert {tuple(r.embedding) for r in unit.collect()} == {(0.0, 0.0), (1.0, 0.0)}
    assert unit.schema["embedding"].dataType.simpleString() == "array<float>"


def test_precomputed_embedder(spark):
    df = spark.createDataFrame([("c1", "text"), ("c2", "text")], "chunk_id string, chunk string")
    stored = spark.createDataFrame([("c1", [3.0, 4.0])], "chunk_id string, embedding array<float>")
    rows = embed.embed(df, "chunk", embed.PrecomputedEmbedder(stored, "chunk_id")).collect()
    assert [(r.chunk_id, [round(x, 6) for x in r.embedding]) for r in rows] == [("c1", [0.6, 0.8])]


def test_text_lookup_gives_the_same_result(spark):
    rows = [(f"c{i}", f"b{i % 3}", f"r{i // 2}", [float(i % 7), 1.0]) for i in range(50)]
    chunks = spark.createDataFrame(rows, CHUNK).withColumn("chunk", F.concat(F.lit("text "), "chunk_id"))
    topics = spark.createDataFrame([("t", [1.0, 0.5])], TOPIC)
    carried = retrieve.topic_retrieval(chunks, topics)
    looked_up = retrieve.topic_retrieval(
        chunks.drop("chunk"), topics, text_from=chunks.select("chunk_id", "chunk")
    )
    assert carried.columns == looked_up.columns
    assert sorted(carried.collect()) == sorted(looked_up.collect())


def test_ad_hoc_search(spark):
    rows = [(f"c{i}", f"b{i % 2}", f"r{i}", [float(i), 0.0]) for i in range(10)]
    topics = spark.createDataFrame([("q", [1.0, 0.0])], TOPIC)
    got = retrieve.search(spark.createDataFrame(rows, CHUNK), topics, "b1", k=3).orderBy("rank").collect()
    assert [(r.rank, r.chunk_id) for r in got] == [(1, "c9"), (2, "c7"), (3, "c5")]


def test_integrity_and_empty_topics(spark):
    vectors = spark.createDataFrame([("c1", "a"), ("c2", "a"), ("c3", "b")], "chunk_id string, business_id string")
    metadata = spark.createDataFrame([("c1", "a"), ("c3", "b"), ("c4", "b"), ("c5", "c")], vectors.schema)
    broken = quality.index_integrity(vectors, metadata).collect()
    assert {(r.chunk_id, r.missing) for r in broken} == {("c2", "metadata"), ("c4", "vector"), ("c5", "vector")}
    listing = {r.business_id: (r.n_vectors, r.n_metadata, r.paired) for r in quality.index_listing(vectors, metadata).collect()}
    assert listing == {"a": (2, 1, False), "b": (1, 2, False), "c": (0, 1, False)}
    quality.require_metadata(vectors, metadata)
    with pytest.raises(KeyError, match="business_id c"):
        quality.require_metadata(metadata, vectors)
    found = spark.createDataFrame([("a", "food")], "business_id string, topic string")
    empty = quality.empty_topics(vectors.select("business_id").distinct(), ["food", "service"], found)
    assert {tuple(r) for r in empty.collect()} == {("a", "service"), ("b", "food"), ("b", "service")}


def test_vector_stats_show_mixed_dimensions(spark):
    df = spark.createDataFrame([("c1", "a", "r", [3.0, 4.0]), ("c2", "a", "r", [1.0])], CHUNK)
    assert tuple(quality.index_stats(df).first()) == ("a", 2, 1, 2, 1.0, 5.0)


def test_histogram_shows_empty_bins(spark):
    rows = [("a", f"r{i}") for i in range(5)] + [("b", f"r{i}") for i in range(6)] + [("c", f"r{i}") for i in range(101)]
    df = spark.createDataFrame(rows, "k string, r string")
    bins = {r.label: r.n_keys for r in explore.count_histogram(df, "k", "r").collect()}
    assert bins == {"0-5": 1, "6-10": 1, "11-20": 0, "21-50": 0, "51-80": 0, "81-100": 0, "100+": 1}


def test_observed_counts(spark):
    df, seen = quality.observed(spark.range(12), "stage")
    df.filter("id > 3").collect()
    assert seen.get == {"rows": 12}
