"""Input views over the given tables, in SQL that Spark and DuckDB both run.

The views only make inputs (raw text rows, scores, request payloads, trials);
everything computed from them is written twice, as operators and as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.contracts import (
    COMPANY_SIZES,
    COMPANY_TYPES,
    EDUCATION_LEVELS,
    ENROLLED_UNIVERSITY,
    LAST_NEW_JOB,
    PEOPLE,
)
from tabloom.operators.quality import modeling_table
from tabloom.scratch import deal

SOURCE_URI = "table://events"
SOURCE_SHA256, LATER_SHA256 = "a" * 64, "b" * 64

MODEL_NAMES = ("logistic_regression", "random_forest", "gradient_boosting")
STRATEGIES = ("all_ohe", "ordinal_aware")
REPORTS = (
    "split_manifest",
    "model_selection_summary",
    "final_evaluation",
    "precision_recall_curve",
    "roc_curve",
    "confusion_matrix",
    "capacity_curve",
)


def pick(number: str, values: tuple[str, ...]) -> str:
    """CASE that takes the value at ``number`` modulo the list length."""
    *head, last = values
    arms = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(head))
    return f"CASE ({number}) % {len(values)} {arms} ELSE '{last}' END"


def blank_or(divisor: int, value: str) -> str:
    return f"CASE WHEN event_id % {divisor} = 0 THEN '' ELSE {value} END"


_DISCIPLINES = ("Arts", "Business Degree", "Humanities", "Other", "STEM")

RAW_PEOPLE = f"""
SELECT
  CAST(event_id AS string) AS enrollee_id,
  CASE WHEN event_id % 53 = 0 THEN '  '
       ELSE ' city_' || CAST(user_id AS string) || ' ' END AS city,
  CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'n/a'
       ELSE '0.' || lpad(CAST(event_id % 1000 AS string), 3, '0') END AS city_development_index,
  {pick('event_id', ('Male', 'Female', 'Other', ''))} AS gender,
  {pick('event_id', ('Has relevent experience', 'No relevent experience'))} AS relevent_experience,
  {blank_or(7, pick('event_id', ENROLLED_UNIVERSITY))} AS enrolled_university,
  {blank_or(11, pick('event_id', EDUCATION_LEVELS))} AS education_level,
  {blank_or(6, pick('event_id', _DISCIPLINES))} AS major_discipline,
  {blank_or(13, "CASE event_id % 22 WHEN 0 THEN '<1' WHEN 21 THEN '>20' "
                "ELSE CAST(event_id % 22 AS string) END")} AS experience,
  {blank_or(5, pick('event_id', COMPANY_SIZES))} AS company_size,
  CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 211 = 0 THEN 'Unknown Co'
       ELSE {pick('event_id', COMPANY_TYPES)} END AS company_type,
  {blank_or(10, pick('event_id', LAST_NEW_JOB))} AS last_new_job,
  CASE WHEN event_id % 307 = 0 THEN '-3' ELSE CAST(event_id % 300 AS string) END AS training_hours,
  CASE WHEN event_type IN ('purchase', 'signup') THEN '1.0'
       WHEN event_type = 'error' AND event_id % 101 = 0 THEN '2.0' ELSE '0.0' END AS target
FROM {{events}}
"""

# Every person with a score; some have no usable label.
ALL_SCORED = f"""
  SELECT
    event_id AS enrollee_id,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 1
         WHEN event_type = 'error' AND event_id % 101 = 0 THEN NULL ELSE 0 END AS y,
    nullif({pick('event_id', ('Male', 'Female', 'Other', ''))}, '') AS gender,
    CAST((event_id * 7919) % 1009 AS double) / 1009 AS p,
    CAST(floor(event_id / 100) AS bigint) AS request_id,
    event_id % 100 AS input_index
  FROM {{events}}
"""

# Rows without a usable label cannot be judged and are left out.
SCORED_PEOPLE = f"""
SELECT * FROM ({ALL_SCORED}) AS scored
WHERE y IS NOT NULL
"""

# Candidates of each scoring request: most requests have four, one is over the limit, and some rows name none.
REQUEST_ID = """
CASE WHEN event_id % 101 = 0 THEN NULL
     WHEN event_id < 1200 AND event_id % 4 > 0 AND event_id % 2 = 1 THEN -1
     ELSE CAST(floor(event_id / 4) AS bigint) END
"""

# Measured values of events as scores of a label: almost every row has its own score.
VALUE_SCORES = """
SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS y, CAST(value AS double) AS p
FROM {events} WHERE value IS NOT NULL
"""

DOC_LABELS = """
SELECT d.doc_id, l.quality, d.lang, CAST(d.n_chars AS double) AS n_chars
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

# One study per user; its trials are numbered by event.
TRIALS = f"""
SELECT
  'study-' || CAST(user_id AS string) AS study,
  event_id AS trial,
  {pick('event_id', MODEL_NAMES)} AS model_name,
  {pick('CAST(floor(event_id / 3) AS bigint)', STRATEGIES)} AS strategy,
  event_id % 4 < 2 AS include_city,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'balanced' END AS class_weight,
  CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'view' THEN 'RUNNING' ELSE 'COMPLETE' END AS state,
  CASE WHEN event_id % 23 = 0 THEN CAST('NaN' AS double)
       WHEN event_id % 29 = 0 THEN CAST('Infinity' AS double)
       ELSE CAST((event_id * 7919) % 1009 AS double) / 1009 END AS value,
  CASE WHEN event_id % 31 = 0 THEN 'b' ELSE 'a' END AS source_sha256,
  CASE WHEN event_id % 37 = 0 THEN 10 ELSE 5 END AS cv_folds,
  42 AS random_state,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE 1 END AS search_space_version
FROM {{events}}
"""

# One scoring candidate per event, as request text with every kind of mistake.
REQUESTS = f"""
SELECT
  event_id,
  '{{{{' ||
  CASE WHEN event_id % 43 = 0 THEN ''
       ELSE '"city_development_index":' ||
         CASE WHEN event_id % 41 = 0 THEN '"0.25"' WHEN event_id % 47 = 0 THEN 'true'
              WHEN event_id % 59 = 0 THEN '1.5' WHEN event_id % 61 = 0 THEN 'null'
              ELSE '0.' || lpad(CAST(event_id % 1000 AS string), 3, '0') END || ',' END ||
  '"city":' ||
  CASE WHEN event_id % 53 = 0 THEN '"  "' WHEN event_id % 67 = 0 THEN 'null'
       WHEN event_id % 71 = 0 THEN '"city_123456789012345678"' WHEN event_id % 73 = 0 THEN '"town_1"'
       ELSE '" city_' || CAST(user_id AS string) || '"' END || ',' ||
  CASE WHEN event_id % 79 = 0 THEN '"surprise":1,' ELSE '' END ||
  '"relevant_experience":"' ||
  {pick('event_id', ('Has relevant experience', 'No relevant experience', ' Has relevant experience '))} || '",' ||
  '"enrolled_university":' ||
  CASE WHEN event_id % 7 = 0 THEN 'null' ELSE '"' || {pick('event_id', ENROLLED_UNIVERSITY)} || '"' END || ',' ||
  CASE WHEN event_id % 83 = 0 THEN ''
       ELSE '"education_level":"' || {blank_or(11, pick('event_id', EDUCATION_LEVELS))} || '",' END ||
  '"major_discipline":"' || {blank_or(6, pick('event_id', _DISCIPLINES))} || '",' ||
  '"experience":' ||
  CASE WHEN event_id % 13 = 0 THEN 'null' WHEN event_id % 22 = 0 THEN '"<1"'
       WHEN event_id % 22 = 21 THEN '">20"'
       WHEN event_id % 89 = 0 THEN CAST(event_id % 22 AS string)
       ELSE '"' || CAST(event_id % 22 AS string) || '"' END || ',' ||
  '"company_size":"' || {blank_or(5, pick('event_id', COMPANY_SIZES))} || '",' ||
  '"company_type":"' || CASE WHEN event_id % 211 = 0 THEN 'Unknown Co'
       ELSE {pick('event_id', COMPANY_TYPES)} END || '",' ||
  '"last_new_job":"' || {blank_or(10, pick('event_id', LAST_NEW_JOB))} || '"}}}}' AS payload
FROM {{events}}
"""


# One model descriptor per event, some without version, model or readable maps.
DESCRIPTORS = """
SELECT
  event_id,
  '{{"schema_version":' || CASE WHEN event_id % 31 = 0 THEN '2' ELSE '1' END || ',"model":' ||
  CASE WHEN event_id % 37 = 0 THEN '"none"' ELSE
    '{{' || CASE WHEN event_id % 41 = 0 THEN '' ELSE '"model_uri":"models:/m' || CAST(user_id AS string) || '",' END ||
    '"model_version":"' || CAST(event_id % 9 AS string) || '","trial":' ||
    CASE WHEN event_id % 43 = 0 THEN '"first"' WHEN event_id % 47 = 0 THEN 'null'
         ELSE '"' || CAST(event_id AS string) || '"' END ||
    CASE WHEN event_id % 53 = 0 THEN ',"parameters":[1]'
         ELSE ',"parameters":{{"c":"' || event_type || '"}}' END ||
    ',"test_metrics":{{"auc":0.' || lpad(CAST(event_id % 1000 AS string), 3, '0') || '}}}}' END ||
  '}}' AS body
FROM {events}
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, sql: str, *tables: str) -> DataFrame:
    """Run a view's SQL over the named tables."""
    return spark.sql(sql, **{name: table(spark, folder, name) for name in tables})


def dealt_view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run a view's SQL over the events, dealt evenly over tasks while they are still short."""
    return spark.sql(sql, events=deal(table(spark, folder, "events")))


def raw_people(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, RAW_PEOPLE, "events")


def modeling_people(spark: SparkSession, folder: str, raw: DataFrame | None = None) -> DataFrame:
    raw = raw_people(spark, folder) if raw is None else raw
    return modeling_table(raw, PEOPLE, SOURCE_URI, SOURCE_SHA256)


def scored_people(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, SCORED_PEOPLE, "events")


def all_scored(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, ALL_SCORED, "events")


def doc_labels(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, DOC_LABELS, "documents", "labels")


def trials(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, TRIALS, "events")


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, REQUESTS, "events")
