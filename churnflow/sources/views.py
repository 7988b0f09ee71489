"""The star-schema tables seen as the operators' inputs.

Each view is one SQL text with table names as placeholders, so that the same text serves a Spark
session (``view``) and any other SQL engine (``view_sql``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_SUBSCRIBERS = """
WITH o AS (
  SELECT o_custkey,
         count(*) AS n_orders,
         min(o_orderdate) AS first_dt,
         max(o_orderdate) AS last_dt,
         max(o_totalprice) AS max_price,
         sum(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
                  THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS urgent_total
  FROM {orders} GROUP BY o_custkey)
SELECT c_name AS customerID,
  CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END AS SeniorCitizen,
  CASE WHEN c_custkey % 5 < 2 THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
  CAST((year(last_dt) - year(first_dt)) * 12 + month(last_dt) - month(first_dt) AS INT) AS tenure,
  CASE WHEN c_custkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
  CASE WHEN c_custkey % 10 = 0 THEN 'No phone service'
       WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS MultipleLines,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'DSL'
       WHEN c_mktsegment = 'MACHINERY' THEN 'No' ELSE 'Fiber optic' END AS InternetService,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No internet service'
       WHEN c_custkey % 11 < 5 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No internet service'
       WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No internet service'
       WHEN c_custkey % 17 < 8 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No internet service'
       WHEN c_custkey % 19 < 9 THEN 'Yes' ELSE 'No' END AS TechSupport,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No internet service'
       WHEN c_custkey % 23 < 11 THEN 'Yes' ELSE 'No' END AS StreamingTV,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No internet service'
       WHEN c_custkey % 29 < 14 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
  CASE WHEN n_orders < 9 THEN 'Month-to-month'
       WHEN n_orders < 12 THEN 'One year' ELSE 'Two year' END AS Contract,
  CASE WHEN c_custkey % 31 < 18 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
  CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
       WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
  max_price / 1000 AS MonthlyCharges,
  CASE WHEN urgent_total IS NULL THEN ' '
       ELSE CAST(CAST(urgent_total AS DECIMAL(18,2)) AS STRING) END AS TotalCharges,
  CASE WHEN last_dt < TIMESTAMP '2001-02-01 00:00:00' THEN 'Yes' ELSE 'No' END AS Churn
FROM {customer} JOIN o ON o_custkey = c_custkey"""

_SUBSCRIBERS_DIRTY = """
WITH k AS (SELECT *, CAST(substr(customerID, 10) AS INT) % 50 AS m FROM {subscribers})
SELECT CASE WHEN m = 1 THEN 'Customer#000000000' ELSE customerID END AS customerID,
  CASE WHEN m = 2 THEN ' Male' WHEN m = 3 THEN 'Unknown' ELSE gender END AS gender,
  CASE WHEN m = 10 THEN 2 ELSE SeniorCitizen END AS SeniorCitizen,
  CASE WHEN m = 4 THEN NULL ELSE Partner END AS Partner,
  Dependents,
  CASE WHEN m = 8 THEN '-1' WHEN m = 13 THEN 'x' ELSE CAST(tenure AS STRING) END AS tenure,
  PhoneService, MultipleLines, InternetService, OnlineSecurity, OnlineBackup,
  DeviceProtection, TechSupport, StreamingTV, StreamingMovies,
  CASE WHEN m = 5 THEN '   ' ELSE Contract END AS Contract,
  PaperlessBilling, PaymentMethod,
  CASE WHEN m = 9 THEN -0.5 ELSE MonthlyCharges END AS MonthlyCharges,
  CASE WHEN m = 6 THEN 'abc' WHEN m = 7 THEN '-5' WHEN m = 11 THEN 'nan'
       WHEN m = 12 THEN chr(9) ELSE TotalCharges END AS TotalCharges,
  CASE WHEN m = 14 THEN ' Yes' ELSE Churn END AS Churn
FROM k"""

_MODEL_SCORES = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
       l_discount * 10 AS production_score,
       l_quantity / 50 AS candidate_score
FROM {lineitem}"""

_PREDICTION_LOG = """
SELECT event_id AS request_id, ts, CAST(user_id AS STRING) AS customerID,
  CASE event_type WHEN 'signup' THEN 422 WHEN 'error' THEN 500 ELSE 200 END AS status,
  CASE WHEN event_type <> 'signup' THEN value / 100 END AS latency_seconds,
  CASE WHEN event_type NOT IN ('signup', 'error')
       THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 100 END AS probability
FROM {events}"""

VIEWS = {
    "subscribers": _SUBSCRIBERS,
    "subscribers_dirty": _SUBSCRIBERS_DIRTY,
    "model_scores": _MODEL_SCORES,
    "prediction_log": _PREDICTION_LOG,
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view_over(spark: SparkSession, name: str, **inputs: DataFrame) -> DataFrame:
    """A view over given frames, batch or streaming."""
    return spark.sql(VIEWS[name], **inputs)


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over the Parquet tables of ``folder`` as a lazy DataFrame."""
    inputs = {
        source: view(spark, folder, source) if source in VIEWS else table(spark, folder, source)
        for source in (*VIEWS, *TABLES)
        if "{" + source + "}" in VIEWS[name]
    }
    return view_over(spark, name, **inputs)


def view_sql(name: str) -> str:
    """The same view as SQL text over tables registered under their own names."""
    return VIEWS[name].format(**{name: name for name in (*VIEWS, *TABLES)}).strip()
