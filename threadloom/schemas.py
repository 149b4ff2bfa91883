"""Row shapes shared by the operators."""

from pyspark.sql import types as T

TWEETS = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.BooleanType()),
    T.StructField("text", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.LongType()),
])

PAIRS = T.StructType([
    T.StructField("input", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("customer_input", T.BooleanType()),
    T.StructField("company", T.StringType()),
])

KB_CHUNKS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("chunk_idx", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

IMAGE = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])
