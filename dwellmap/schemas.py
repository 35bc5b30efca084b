"""Table schemas exchanged between the stages, as DDL strings for ``spark.read.schema``."""

RAW = (
    "_c0 string, _c1 string, _c2 string, _c3 string, _c4 string, _c5 string, _c6 string, "
    "_c7 string, _c8 string"
)

VISITS = (
    "prefix string, userId string, clusterId int, begin timestamp, end timestamp, offset int, "
    "year int, dayofyear int"
)

PLACES = (
    "prefix string, userId string, clusterId int, clusterLatitude double, clusterLongitude double, "
    "geohash7 string, state string"
)

INGEST_STATS = (
    "table_name string, count_line_input bigint, count_line_output bigint, "
    "start_time double, end_time double"
)
