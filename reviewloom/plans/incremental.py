"""Reviews that arrive in batches: only new texts are embedded, only touched businesses are ranked again.

A store is a folder of tables:

    digests/batch=...                     the texts that each batch brought
    chunks/vector_folder=.../batch=...    their chunks, by business
    vectors/vector_folder=.../batch=...   the vectors of these
    retrieved/vector_folder=...           the ranked chunks of every (business, topic)

A batch writes its own folders and replaces the ranked ones of the businesses it touches; all
other files stay as they are. A batch that failed is run again under its name: what it left
is replaced, and texts are compared with those of the other batches only. The result is that
of one run over all batches, as long as a batch's rows come after those of earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from reviewloom.operators import chunk, clean, embed
from reviewloom.params import Params
from reviewloom.plans.insights import retrieved_chunks
from reviewloom.sources import tables
from reviewloom.sources.tables import _FOLDER, _folder


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table whose folder names stay text, or None if no batch has written it."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException:
        return None
    return spark.read.schema(tables.as_text(found, _FOLDER, "batch")).parquet(path)


def _replace(df: DataFrame, path: str, *folders: str) -> None:
    """Write a table's folders in place of the ones of the same names."""
    writer = df.hint("rebalance", *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).parquet(path)


def add_batch(
    spark: SparkSession, reviews: DataFrame, store: str, batch: str, params: Params = Params(), embedder: embed.Embedder | None = None
) -> DataFrame:
    """Add joined reviews to a store; returns the ranked chunks of all businesses."""
    p = params
    named = F.lit(batch).alias("batch")
    digests = _stored(spark, f"{store}/digests")
    known = None if digests is None else digests.filter(F.col("batch") != batch)
    order = p.col_order if p.col_order in reviews.columns else p.col_review
    work = f"{store}/work/{batch}"
    fresh, _ = clean.stored_unique(clean.clean_text(reviews, p.col_text, p.min_chars), work, p.col_text, order, known=known)

    # chunks of new texts only, and vectors of new chunks only
    folder = _folder(F.col("business_id"), p.vector_buckets).alias(_FOLDER)
    _replace(chunk.review_chunks(fresh, p).select("*", folder, named), f"{store}/chunks", _FOLDER, "batch")
    chunks = _stored(spark, f"{store}/chunks")
    ids = ("chunk_key", "chunk_id", "business_id", "review_id")
    new = chunks.filter(F.col("batch") == batch)
    vectors = embed.embed(new.select(*ids, "chunk", _FOLDER, "batch"), "chunk", embedder, normalize=p.normalize)
    _replace(vectors.drop("chunk"), f"{store}/vectors", _FOLDER, "batch")

    # folders are few and known; the scans below read those that the batch touched and no others
    touched = [r[0] for r in new.select(_FOLDER).distinct().collect()]
    some = F.col(_FOLDER).isin(touched) if touched else F.lit(False)
    text = chunks.filter(some).select("chunk_key", "restaurant_name", "stars", "chunk")
    vectors = _stored(spark, f"{store}/vectors")
    ranked = retrieved_chunks(vectors.filter(some).select(*ids, "embedding"), p, embedder, text, f"{work}/ranked")
    if touched:
        _replace(ranked.select("*", folder), f"{store}/retrieved", _FOLDER)
    # last, so that a batch that fails before is taken as new when it is run again
    rows = tables.read_table(spark, f"{work}/clean").select("_digest").distinct()
    fresh_digests = rows if known is None else rows.join(known.select("_digest"), "_digest", "left_anti")
    _replace(fresh_digests.select("*", named), f"{store}/digests", "batch")
    return _stored(spark, f"{store}/retrieved").drop(_FOLDER)
