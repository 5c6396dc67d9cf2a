"""Column layouts of the tables this package exchanges."""

from pyspark.sql import types as T

# Ids are strings on purpose: "0052" must not be read back as 52.
LOG_ENTRY = T.StructType([
    T.StructField("cluster_id", T.StringType()),
    T.StructField("application_id", T.StringType()),
    T.StructField("app_number", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("container_seq", T.StringType()),
    T.StructField("container_id", T.StringType()),
    T.StructField("container_role", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("block_start", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("component", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("raw", T.StringType()),
])

APP_TIMELINE = T.StructType([
    T.StructField("cluster_id", T.StringType()),
    T.StructField("application_id", T.StringType()),
    T.StructField("app_number", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
])

CLUSTER_SUMMARY = T.StructType([
    T.StructField("cluster_id", T.StringType()),
    T.StructField("num_applications", T.LongType()),
    T.StructField("cluster_first_app", T.TimestampType()),
    T.StructField("cluster_last_app", T.TimestampType()),
])

LEVEL_COUNTS = T.StructType([
    T.StructField("log_level", T.StringType()),
    T.StructField("count", T.LongType()),
])

DAILY_METRICS = T.StructType([
    T.StructField("dt_year", T.IntegerType()),
    T.StructField("dt_month", T.IntegerType()),
    T.StructField("dt_day", T.IntegerType()),
    T.StructField("num_trips", T.LongType()),
    T.StructField("mean_trip_distance", T.DoubleType()),
    T.StructField("max_mta_tax", T.DoubleType()),
    T.StructField("q95_fare_amount", T.DoubleType()),
    T.StructField("min_tip_amount", T.DoubleType()),
    T.StructField("mean_passenger_count", T.LongType()),
])
