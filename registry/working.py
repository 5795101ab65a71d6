"""Question-and-answer tables derived from the given ``documents``, whole texts, every row.

The given prose holds hardly any of the words the operators look for, so each document gets a
phrase in front, chosen by its id. The same SQL text defines the rows for both engines.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalathe.plans.preprocess import preprocess
from qalathe.session import fresh_path
from qalathe.sources import write_table

RUN_TIME = datetime.datetime(2024, 1, 1)

_NL, _TICK = "chr(10)", "chr(96)"
_FENCE = f"{_TICK} || {_TICK} || {_TICK}"

_PHRASES = (
    "'How do I recover from CrashLoopBackOff on kubernetes?'",
    "'Why does docker stop, see https://example.org/kubernetes/help?q=1 for more.'",
    "'What is terraform doing at the timeout?'",
    "'Please fix OOMKilled soon.'",
    "'Crash in CUDA with one gpu.'",
    "'Any best practice for postgres on aws?'",
    f"'Set ' || {_TICK} || 'replicas: 2' || {_TICK} || ' in the yaml config.'",
    f"'See ' || {_FENCE} || {_NL} || 'ls -la' || {_NL} || {_FENCE} || ' permission denied 403.'",
    f"'Connection Refused   by prometheus' || {_NL} || {_NL} || '  over the network.'",
    "'ErrImagePull in jenkins!!! quota exceeded.'",
    "'short'",
    "'A plain note.'",
)


def _phrase_case() -> str:
    arms = " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(_PHRASES))
    return f"CASE CAST(doc_id % 12 AS INT) {arms} END"


QA_BASE_SQL = f"""
SELECT doc_id + 1 AS question_id,
       'Item ' || CAST(doc_id AS VARCHAR(20)) AS title,
       {_phrase_case()} || ' ' || text AS question_body,
       CASE WHEN doc_id % 29 = 0 THEN 'too short'
            WHEN doc_id % 31 = 0 THEN NULL
            WHEN doc_id % 3 = 0 THEN text || ' Try ' || {_TICK} || 'kubectl get pods' || {_TICK}
                 || ' or ' || {_TICK} || 'terraform plan' || {_TICK} || '.'
            WHEN doc_id % 3 = 1 THEN text || ' see helm.'
            ELSE text END AS answer_body,
       lang, source,
       (doc_id * 37) % 101 AS score,
       (doc_id * 53) % 97 - 9 AS answer_score,
       (doc_id * 7919) % 100003 AS view_count,
       doc_id
FROM documents
"""


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def given_wide(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = given(spark, sf_dir, name)
    return table.select(*columns) if columns else table


def over_documents(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM documents", "FROM {documents}"),
                     documents=given(spark, sf_dir, "documents"))


def qa_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = over_documents(spark, sf_dir, QA_BASE_SQL)
    return base.withColumn("tags", F.array("lang", "source")).drop("lang", "source", "doc_id")


def qa_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess(qa_base(spark, sf_dir), processed_at=RUN_TIME)


def stage_table(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The table as the next stage meets it: written to the shared folder and read back.

    Queries that go over a table more than once start from its stage table, so the texts are
    cleaned once and a lost executor repeats a scan, not the stage before.
    """
    path = fresh_path(spark, label)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


def qa_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, qa_processed(spark, sf_dir), "processed")


# --- the same tables for the checking engine ------------------------------------------

def _clean(c: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(coalesce({c}, ''), 'https?://[^\\s]+', '[URL]', 'g'),"
            f" '\\s+', ' ', 'g'))")


CODE = r"```[\s\S]*?```|`[^`]+`"


def words(c: str) -> str:
    return rf"CAST(len(regexp_extract_all({c}, '[^\s]+')) AS BIGINT)"


def code_spans(c: str) -> str:
    return f"CAST(len(regexp_extract_all({c}, '{CODE}')) AS BIGINT)"


def sentences(c: str) -> str:
    return f"CAST(len(regexp_extract_all({c}, '[.!?]+')) AS BIGINT)"


# The word lists, written as patterns here as an independent statement of them.
ERROR_PATTERNS = {
    "CrashLoopBackOff": "crashloopbackoff",
    "OOMKilled": "oomkilled|outofmemory|oom",
    "ImagePullBackOff": "imagepullbackoff|errimagepull",
    "Timeout": "timeout|timed out",
    "ConnectionRefused": "connection refused|econnrefused",
    "PermissionDenied": "permission denied|403|401|unauthorized",
    "ResourceExhausted": "resource exhausted|quota exceeded|limit reached",
    "GPUError": "cuda|gpu|gpu error|device not found",
    "NetworkError": "network|dns|resolve|unreachable",
    "ConfigError": "config|configuration|yaml|invalid",
}
INFRA_PATTERNS = {
    "kubernetes": "kubernetes|k8s|kubectl|pod|deployment|service|ingress|helm",
    "terraform": "terraform|tfstate|provider|module|hcl",
    "docker": "docker|container|dockerfile|image|compose",
    "gpu": "gpu|cuda|nvidia|tensor|tpu",
    "database": "database|postgres|mysql|redis|mongodb|sql",
    "cloud_aws": "aws|ec2|s3|lambda|eks|iam",
    "cloud_gcp": "gcp|gke|bigquery|cloud run",
    "cloud_azure": "azure|aks|blob",
    "monitoring": "prometheus|grafana|alertmanager|datadog|metrics",
    "cicd": "jenkins|github actions|gitlab|circleci|pipeline",
}
TYPE_PATTERNS = {
    "how_to": "how (do|can|to|should)",
    "explanation": "why (is|does|did|am|are)",
    "definition": "what (is|are|does)",
    "troubleshooting": "(fix|solve|resolve|debug)",
    "error_resolution": "(error|exception|fail|crash)",
    "best_practice": "(best practice|recommend|should i)",
}


def labels_sql(text: str, patterns: dict[str, str]) -> str:
    marks = ", ".join(
        f"CASE WHEN regexp_matches({text}, '{p}', 'i') THEN '{label}' END"
        for label, p in patterns.items()
    )
    return f"list_filter([{marks}], lambda x: x IS NOT NULL)"


def type_sql(text: str) -> str:
    arms = " ".join(
        f"WHEN regexp_matches(lower({text}), '{p}') THEN '{t}'" for t, p in TYPE_PATTERNS.items())
    return f"CASE {arms} ELSE 'general' END"


def complexity_sql(text: str) -> str:
    return (f"CASE WHEN {words(text)} < 50 AND {code_spans(text)} = 0 THEN 'simple' "
            f"WHEN {words(text)} < 200 OR {code_spans(text)} <= 1 THEN 'moderate' ELSE 'complex' END")


def rounded(x: str, digits: int = 2) -> str:
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


QUALITY_SQL = rounded(
    f"score * CAST(2.0 AS DOUBLE) + answer_score * CAST(3.0 AS DOUBLE) + view_count * CAST(0.001 AS DOUBLE)"
    f" + least({words('question_body')} / CAST(50 AS DOUBLE), CAST(2 AS DOUBLE))"
    f" + least({words('answer_body')} / CAST(100 AS DOUBLE), CAST(3 AS DOUBLE))"
    f" + {code_spans('answer_body')} * CAST(0.5 AS DOUBLE)")

QA_CTE = f"""
qa_base AS ({QA_BASE_SQL}),
qa_clean AS (
  SELECT *, {_clean('question_body')} AS q, {_clean('answer_body')} AS a
  FROM qa_base
  WHERE question_id <> 0 AND length(coalesce(question_body, '')) > 0
    AND length(coalesce(answer_body, '')) > 0
),
qa_text AS (
  SELECT *, title || ' ' || q || ' ' || a AS everything
  FROM qa_clean WHERE length(q) >= 20 AND length(a) >= 50
),
qa AS MATERIALIZED (
  SELECT question_id, {_clean('title')} AS title, q AS question_body, a AS answer_body,
         [lang, source] AS tags, score, answer_score, view_count,
         {labels_sql('everything', ERROR_PATTERNS)} AS error_signatures,
         {labels_sql('everything', INFRA_PATTERNS)} AS infra_components,
         {type_sql('q')} AS question_type, {complexity_sql('everything')} AS complexity,
         {QUALITY_SQL} AS quality_score
  FROM qa_text
)"""


def with_qa(select: str, *more: str) -> str:
    """A statement over the processed table ``qa``; ``more`` are further named tables."""
    return "WITH " + ",\n".join([QA_CTE, *more]) + "\n" + select
