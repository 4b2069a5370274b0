"""The test tables seen as reviews, businesses and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators import embed
from reviewloom.params import TOPICS, Params

# stars of the joined input are called stars_reviews; these views hold that name
PARAMS = Params()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document_reviews(
    documents: DataFrame, business: Column | None = None, stars: str = "stars_reviews"
) -> DataFrame:
    """documents as joined reviews; the source, or another column, is the business."""
    return documents.select(
        F.col("doc_id").cast("string").alias("review_id"),
        (F.col("source") if business is None else business).alias("business_id"),
        F.col("source").alias("name"),
        (F.col("doc_id") % 5 + 1).cast("double").alias(stars),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
        .cast("string")
        .alias("date"),
        "text",
        F.col("doc_id").alias("ordinal"),
    )


def source_lang() -> Column:
    """A finer business key, so that several businesses share a name."""
    return F.concat_ws("-", "source", "lang")


def stored_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """embeddings as chunk vectors of the business ``label``."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("chunk_id"),
        F.col("label").cast("string").alias("business_id"),
        F.expr("cast(vec_id div 3 AS string)").alias("review_id"),
        "embedding",
    )


def topic_vectors(spark: SparkSession) -> DataFrame:
    return embed.embed_topics(embed.topic_table(spark, TOPICS))


def part_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as reviews of parts: an order "reviews" the part it holds."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("business_id"),
        F.col("l_orderkey").alias("review_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("stars"),
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_name").alias("categories"),
        F.col("p_retailprice").alias("stars"),
    )
