"""Schemas of the tables the library reads and writes."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


CRAWL = _struct(
    post_id=T.LongType(), post_url=T.StringType(), status=T.IntegerType(), html=T.StringType()
)
ARTICLES = _struct(post_id=T.LongType(), text=T.StringType())
TOPIC_MAP = _struct(post_id=T.LongType(), topic=T.IntegerType())
TOPIC_TERMS = _struct(
    topic=T.IntegerType(), term=T.StringType(), weight=T.DoubleType(), rank=T.IntegerType()
)
# Ids are LONG, not FLOAT: a float cannot tell 16777217 from 16777216.
HITS = _struct(
    uuid=T.StringType(),
    session_id=T.StringType(),
    ts=T.TimestampType(),
    post_id=T.LongType(),
    post_published=T.TimestampType(),
    post_url=T.StringType(),
    device_type=T.StringType(),
    hit_revenue=T.DoubleType(),
)
BINNED = _struct(
    c0=T.IntegerType(),
    topic=T.IntegerType(),
    timeframe=T.DoubleType(),
    articles=T.LongType(),
    views=T.LongType(),
    revenue=T.DoubleType(),
)
PUBLICATIONS = _struct(post_id=T.LongType(), post_published=T.TimestampType())
INTEREST = _struct(date=T.DateType(), keyword=T.StringType(), interest=T.DoubleType())
TERM_POLARITY = _struct(term=T.StringType(), polarity=T.IntegerType())
