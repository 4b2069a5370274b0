"""Integrity checks and run reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import text as T
from reviewloom.functions import vectors as V
from reviewloom.operators.chunk import chunk_array
from reviewloom.operators.clean import clean_text, observed  # noqa: F401
from reviewloom.params import Params


def index_listing(vectors: DataFrame, metadata: DataFrame, key: str = "business_id") -> DataFrame:
    """Per business: how many vectors and metadata rows there are, and whether they pair."""
    v = vectors.groupBy(key).agg(F.count("*").alias("n_vectors"))
    m = metadata.groupBy(key).agg(F.count("*").alias("n_metadata"))
    both = v.join(m, key, "full")
    nv, nm = (F.coalesce(c, F.lit(0)) for c in ("n_vectors", "n_metadata"))
    return both.select(
        key, nv.alias("n_vectors"), nm.alias("n_metadata"), (nv == nm).alias("paired")
    )


def index_integrity(vectors: DataFrame, metadata: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Ids that have a vector but no metadata, or the reverse."""
    v = vectors.select(key, F.lit(True).alias("in_vectors"))
    m = metadata.select(key, F.lit(True).alias("in_metadata"))
    missing = F.when(F.col("in_metadata").isNull(), "metadata").when(
        F.col("in_vectors").isNull(), "vector"
    )
    return v.join(m, key, "full").select(key, missing.alias("missing")).filter("missing IS NOT NULL")


def fingerprints(df: DataFrame, key: str = "business_id", ids: str = "chunk_key") -> DataFrame:
    """Per key: rows and the sum of the hashes of their ids, which no order of rows changes."""
    hashed = F.xxhash64(F.col(ids).cast("string")).cast("decimal(38,0)")
    return df.groupBy(key).agg(F.count("*").alias("n"), F.sum(hashed).alias("total"))


def differing_keys(vectors: DataFrame, metadata: DataFrame, key: str = "business_id", ids: str = "chunk_key") -> DataFrame:
    """Keys whose sets of ids differ, by their fingerprints: one pass over each table, one small row per key."""
    v, m = fingerprints(vectors, key, ids), fingerprints(metadata, key, ids)
    both = v.select(key, F.struct("n", "total").alias("v")).alias("a").join(
        m.select(key, F.struct("n", "total").alias("m")).alias("b"), F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full"
    )
    return both.filter(~F.col("v").eqNullSafe(F.col("m"))).select(F.coalesce(f"a.{key}", f"b.{key}").alias(key))


def index_differences(vectors: DataFrame, metadata: DataFrame, key: str = "business_id", ids: str = "chunk_key") -> DataFrame:
    """Ids that one table lacks, with their key; ids are joined only for keys whose fingerprints differ."""
    wrong = differing_keys(vectors, metadata, key, ids).select(F.col(key).alias("_wrong"))

    def suspects(df: DataFrame) -> DataFrame:
        return df.select(key, F.col(ids)).join(wrong, F.col(key).eqNullSafe(F.col("_wrong")), "left_semi")

    sides = [suspects(df).groupBy(key, ids).agg(F.lit(True).alias(name)) for df, name in ((vectors, "v"), (metadata, "m"))]
    a, b = sides[0].alias("a"), sides[1].alias("b")
    same = F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")) & F.col(f"a.{ids}").eqNullSafe(F.col(f"b.{ids}"))
    missing = F.when(F.col("m").isNull(), "metadata").when(F.col("v").isNull(), "vector")
    found = a.join(b, same, "full").select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.coalesce(f"a.{ids}", f"b.{ids}").alias(ids), missing.alias("missing")
    )
    return found.filter("missing IS NOT NULL")


def require_pairs(vectors: DataFrame, metadata: DataFrame, key: str = "business_id", ids: str = "chunk_key") -> None:
    """Fail when vectors and metadata of a business do not pair one to one, and say which id is alone."""
    wrong = differing_keys(vectors, metadata, key, ids).first()
    if wrong is not None:
        alone = index_differences(vectors, metadata, key, ids).first()
        what = f"{ids} {alone[1]} of {key} {alone[0]} lacks its {alone['missing']}" if alone else f"{ids} repeats in {key} {wrong[0]}"
        raise KeyError(f"vectors and metadata do not pair: {what}")


def require_metadata(vectors: DataFrame, metadata: DataFrame, key: str = "business_id") -> None:
    """Fail when a business has vectors but no metadata."""
    names = vectors.select(key).distinct()
    missing = names.join(metadata.select(key).distinct(), key, "left_anti").first()
    if missing is not None:
        raise KeyError(f"vectors without a metadata row: {key} {missing[0]}")


def index_stats(
    vectors: DataFrame, key: str = "business_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows, dimensions and norms per business; min_dim != max_dim means a broken table."""
    measured = vectors.select(
        key, F.size(vector_col).alias("dim"), V.norm(F.col(vector_col)).alias("norm")
    )
    return measured.groupBy(key).agg(
        F.count("*").alias("n_vectors"),
        F.min("dim").alias("min_dim"),
        F.max("dim").alias("max_dim"),
        F.min("norm").alias("min_norm"),
        F.max("norm").alias("max_norm"),
    )


def empty_topics(entities: DataFrame, topics, retrieved: DataFrame) -> DataFrame:
    """Every (business, topic) for which the search found nothing."""
    pairs = entities.select(
        "business_id", F.explode(F.array(*map(F.lit, topics))).alias("topic")
    )
    return pairs.join(retrieved.select("business_id", "topic"), ["business_id", "topic"], "left_anti")


def cleaning_report(df: DataFrame, col: str = "text", min_chars: int = 30) -> DataFrame:
    """Rows before cleaning, after it, and after deduplication.

    Distinct texts are counted on a 128-bit hash, so no text is shuffled.
    """
    cleaned = clean_text(df.select(col), col, min_chars)
    after = cleaned.select(F.md5(col).alias("digest")).agg(
        F.count("*").alias("n_clean"), F.count_distinct("digest").alias("n_unique")
    )
    n_input = df.agg(F.count("*").alias("n")).scalar()
    return after.select(
        n_input.alias("n_input"),
        "n_clean",
        "n_unique",
        (n_input - F.col("n_clean")).alias("dropped_cleaning"),
        (F.col("n_clean") - F.col("n_unique")).alias("dropped_dedup"),
    )


def counted_report(df: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The report of :func:`cleaning_report` from numbers counted while a stage was written."""
    n = {name: F.lit(value).cast("bigint") for name, value in counts.items()}
    one = df.sparkSession.range(1)
    return one.select(
        *(c.alias(name) for name, c in n.items()),
        (n["n_input"] - n["n_clean"]).alias("dropped_cleaning"), (n["n_clean"] - n["n_unique"]).alias("dropped_dedup"),
    )


def cleaning_funnel(reviews: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows and distinct businesses of reviews, clean, unique and chunks, in one pass over the texts.

    Texts are cleaned and their chunks counted once per row; after that only digests and
    numbers move. One count per (business, text) serves all four stages.
    """
    p = params
    stripped = T.strip(F.col(p.col_text).cast("string"))
    text = F.when(F.length(stripped) >= p.min_chars, stripped)
    order = F.col(p.col_order if p.col_order in reviews.columns else p.col_review)
    made = reviews.select(
        F.col(p.col_entity).alias("key"), order.alias("order"), T.nfkc(T.replace_and_collapse(text)).alias("text")
    )
    chunks = F.size(chunk_array(F.col("text"), p.chunk_size, p.overlap, p.min_chunk, p.chunk_mode))
    first = F.min(F.struct("order", "chunks")).alias("first")
    texts = (
        made.select("key", "order", F.md5("text").alias("digest"), F.greatest(chunks, F.lit(0)).alias("chunks"))
        .groupBy("key", "digest").agg(F.count("*").alias("n"), first)
    )
    clean = F.when(F.col("digest").isNotNull(), F.col("n"))
    before = texts.groupBy("key").agg(F.sum("n").alias("n"), F.coalesce(F.sum(clean), F.lit(0)).alias("clean"))
    winner = F.min(F.struct("first.order", "key", "first.chunks")).alias("w")
    after = texts.filter("digest IS NOT NULL").groupBy("digest").agg(winner).groupBy("w.key").agg(
        F.count("*").alias("unique"), F.coalesce(F.sum("w.chunks"), F.lit(0)).cast("bigint").alias("chunks")
    )
    rows = before.join(after, "key", "full")
    stages = {"reviews": "n", "clean": "clean", "unique": "unique", "chunks": "chunks"}
    totals = rows.agg(*(f(c).alias(f"{name}_{c}") for c in stages.values() for name, f in (
        ("rows", lambda c: F.coalesce(F.sum(c), F.lit(0))), ("keys", lambda c: F.count_if((F.col(c) > 0) & F.col("key").isNotNull())),
    )))
    entries = [
        F.struct(F.lit(name).alias("stage"), F.col(f"rows_{c}").alias("n_rows"), F.col(f"keys_{c}").alias("n_keys"))
        for name, c in stages.items()
    ]
    return totals.select(F.inline(F.array(*entries)))


def run_report(stages: dict[str, DataFrame], key: str = "business_id") -> DataFrame:
    """Rows and distinct businesses of each stage table."""
    counted = [
        df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")).select(
            F.lit(name).alias("stage"), "n_rows", "n_keys"
        )
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)
