"""Schemas of the three logical tables."""

from pyspark.sql import types as T

DETECTIONS = T.StructType(
    [
        T.StructField("tag_code", T.StringType()),
        T.StructField("site_name", T.StringType()),
        T.StructField("antenna_group", T.StringType()),
        T.StructField("obs_time", T.TimestampNTZType()),
        T.StructField("migration_year", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("species_group", T.StringType()),
    ]
)

# species_group is NULL for the main tagging table, which serves every species.
TAGGING = T.StructType(
    [
        T.StructField("tag_code", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("release_date", T.TimestampNTZType()),
        T.StructField("age", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("species_group", T.StringType()),
    ]
)

PASSAGE = T.StructType(
    [
        T.StructField("basin", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("dam", T.StringType()),
        T.StructField("tag_code", T.StringType()),
        T.StructField("spp", T.StringType()),
        T.StructField("run_type", T.StringType()),
        T.StructField("release_date", T.TimestampNTZType()),
        T.StructField("pass_date", T.TimestampNTZType()),
        T.StructField("upstream", T.IntegerType()),
        T.StructField("at_dam", T.IntegerType()),
        T.StructField("below", T.IntegerType()),
    ]
)

# What a passage row holds beside its key.
PASSAGE_VALUES = [f.name for f in PASSAGE.fields[4:]]
