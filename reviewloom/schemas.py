"""Explicit schemas of the inputs and stage tables."""

from pyspark.sql import types as T

_MAP = T.MapType(T.StringType(), T.StringType())


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


REVIEWS = _schema(
    review_id=T.StringType(),
    user_id=T.StringType(),
    business_id=T.StringType(),
    stars=T.DoubleType(),
    useful=T.IntegerType(),
    funny=T.IntegerType(),
    cool=T.IntegerType(),
    text=T.StringType(),
    date=T.StringType(),
)

BUSINESSES = _schema(
    business_id=T.StringType(),
    name=T.StringType(),
    address=T.StringType(),
    city=T.StringType(),
    state=T.StringType(),
    postal_code=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    stars=T.DoubleType(),
    review_count=T.IntegerType(),
    is_open=T.IntegerType(),
    attributes=_MAP,
    categories=T.StringType(),
    hours=_MAP,
)

CHUNKS = _schema(
    chunk_index=T.IntegerType(),
    chunk=T.StringType(),
    business_id=T.StringType(),
    review_id=T.StringType(),
    restaurant_name=T.StringType(),
    chunk_id=T.StringType(),
    n_chars=T.IntegerType(),
    stars=T.DoubleType(),
    date=T.StringType(),
)

SUMMARIES = _schema(
    restaurant_name=T.StringType(),
    food=T.StringType(),
    service=T.StringType(),
    ambiance=T.StringType(),
)
