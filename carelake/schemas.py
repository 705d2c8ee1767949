"""Column contracts of the tables."""

from pyspark.sql import types as T

from .fixed_values import PATIENT_COLUMNS

CORRUPT_RECORD = "_corrupt_record"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("mrn", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("sex", T.StringType()),
        T.StructField("admission_date", T.DateType()),
        T.StructField("discharge_date", T.DateType()),
        T.StructField("primary_diagnosis", T.StringType()),
        T.StructField("readmitted_30d", T.BooleanType()),
    ]
)
PATIENT_SCHEMA = T.StructType([RAW_SCHEMA[c] for c in PATIENT_COLUMNS])
STORED_PATIENT_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + PATIENT_SCHEMA.fields
    + [T.StructField("created_at", T.TimestampType())]
)
LINEAGE_COLUMNS = ["ingested_at", "source_file"]

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("pmid", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("journal", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("authors", T.ArrayType(T.StringType())),
    ]
)
ABSTRACT_SCHEMA = T.StructType(
    ARTICLE_SCHEMA.fields + [T.StructField("query", T.StringType())]
)
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("point_id", T.LongType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
    ]
    + ABSTRACT_SCHEMA.fields
)
