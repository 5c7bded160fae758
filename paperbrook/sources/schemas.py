"""Table schemas."""

from pyspark.sql import types as T

TRACKING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_ts", T.TimestampType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("category", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("indexed_at", T.TimestampType()),
])

CHUNKS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("chunk_text", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

# The states of a tracked file.
NEW, UPDATED, DELETED, INDEXED = "NEW", "UPDATED", "DELETED", "INDEXED"
STATUSES = [NEW, UPDATED, DELETED, INDEXED]
