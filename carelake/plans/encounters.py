"""Bronze-shaped encounter rows derived from the ``orders`` table.

The text runs unchanged on Spark and on DuckDB. It plants bad ages and sexes,
missing record numbers, unlisted and empty diagnoses and repeated patients. The
label leans on age, length of stay and four diagnoses, by a rule of its own.
"""

from pyspark.sql import DataFrame, SparkSession

ENCOUNTERS_SQL = """
WITH b AS (SELECT *, 18 + o_custkey * 7 % 82 AS base_age, o_custkey * 3 % 13 AS dx_no FROM {orders})
SELECT CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN '' ELSE 'MRN-' || lpad(CAST(o_custkey AS STRING), 8, '0') END AS mrn,
 CAST(CASE WHEN o_orderkey % 37 = 0 THEN -5 WHEN o_orderkey % 41 = 0 THEN 500 ELSE base_age END AS INT) AS age,
 CASE WHEN o_orderkey % 43 = 0 THEN 'unknown' ELSE CASE o_custkey % 5 WHEN 0 THEN 'm' WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 3 THEN 'f' ELSE 'O' END END AS sex,
 CAST(o_orderdate AS DATE) AS admission_date,
 CAST(o_orderdate AS DATE) + CAST(o_orderkey % 21 AS INT) AS discharge_date,
 CASE dx_no WHEN 0 THEN 'I50.9' WHEN 1 THEN 'J44.9' WHEN 2 THEN 'J18.9' WHEN 3 THEN 'E11.9' WHEN 4 THEN 'N17.9' WHEN 5 THEN 'I63.9'
  WHEN 6 THEN 'I21.9' WHEN 7 THEN 'K92.2' WHEN 8 THEN 'A41.9' WHEN 9 THEN 'Z51.5' WHEN 10 THEN 'X99.9' WHEN 11 THEN '' END AS primary_diagnosis,
 o_orderkey * 7919 % 1000 < 40 + 2 * base_age + 6 * (o_orderkey % 21) + CASE WHEN dx_no IN (0, 2, 4, 8) THEN 70 ELSE 0 END AS readmitted_30d,
 o_orderdate AS ingested_at,
 'batch_' || lpad(CAST(o_orderkey AS STRING), 10, '0') || '.csv' AS source_file
FROM b
"""


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )
    return spark.sql(ENCOUNTERS_SQL, orders=orders)
