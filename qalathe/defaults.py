"""Default thresholds, word lists and texts.

Fixed values: results are only comparable when these are equal, so they are stated here
plainly and together. Every operator takes them as parameters.
"""

# --- thresholds -----------------------------------------------------------------------
MIN_SCORE = 5
MIN_QUESTION_CHARS = 20
MIN_ANSWER_CHARS = 50
MIN_ROWS = 100
MAX_ROWS = 1_000_000
MAX_MISSING_RATIO = 0.1
MAX_DUPLICATE_RATIO = 0.05
SHORT_QUESTION_CHARS = 50
SHORT_ANSWER_CHARS = 100
SHORT_TEXT_SHARE = 0.1
OUTLIER_SHARE = 0.05
IQR_FACTOR = 1.5
MIN_DISTINCT_TAGS = 3
BIAS_THRESHOLD = 0.25
LENGTH_BIAS_THRESHOLD = 0.5
SLICE_MIN_SAMPLES = 30
UNDERREP_PROPORTION = 0.005
UNDERREP_COUNT = 20
ALERT_HISTORY_ROWS = 1000
TEST_RATIO = 0.2
SPLIT_SEED = 42

# --- order in which tag pages are read ------------------------------------------------
TAGS = (
    "kubernetes", "terraform", "gpu", "autoscaling",
    "mlops", "tensorflow", "pytorch", "airflow",
    "docker", "prometheus", "grafana",
)

# --- word lists: label -> phrases, found as substrings whatever their case ------------
ERROR_LEXICON = {
    "CrashLoopBackOff": ("CrashLoopBackOff",),
    "OOMKilled": ("OOMKilled", "OutOfMemory", "oom"),
    "ImagePullBackOff": ("ImagePullBackOff", "ErrImagePull"),
    "Timeout": ("timeout", "timed out"),
    "ConnectionRefused": ("connection refused", "ECONNREFUSED"),
    "PermissionDenied": ("permission denied", "403", "401", "unauthorized"),
    "ResourceExhausted": ("resource exhausted", "quota exceeded", "limit reached"),
    "GPUError": ("CUDA", "GPU", "gpu error", "device not found"),
    "NetworkError": ("network", "dns", "resolve", "unreachable"),
    "ConfigError": ("config", "configuration", "yaml", "invalid"),
}

INFRA_LEXICON = {
    "kubernetes": ("kubernetes", "k8s", "kubectl", "pod", "deployment", "service", "ingress", "helm"),
    "terraform": ("terraform", "tfstate", "provider", "module", "hcl"),
    "docker": ("docker", "container", "dockerfile", "image", "compose"),
    "gpu": ("gpu", "cuda", "nvidia", "tensor", "TPU"),
    "database": ("database", "postgres", "mysql", "redis", "mongodb", "sql"),
    "cloud_aws": ("aws", "ec2", "s3", "lambda", "eks", "iam"),
    "cloud_gcp": ("gcp", "gke", "bigquery", "cloud run"),
    "cloud_azure": ("azure", "aks", "blob"),
    "monitoring": ("prometheus", "grafana", "alertmanager", "datadog", "metrics"),
    "cicd": ("jenkins", "github actions", "gitlab", "circleci", "pipeline"),
}

# --- question types: the first group with a phrase in the lower-cased question wins ---
QUESTION_TYPES = {
    "how_to": ("how do", "how can", "how to", "how should"),
    "explanation": ("why is", "why does", "why did", "why am", "why are"),
    "definition": ("what is", "what are", "what does"),
    "troubleshooting": ("fix", "solve", "resolve", "debug"),
    "error_resolution": ("error", "exception", "fail", "crash"),
    "best_practice": ("best practice", "recommend", "should i"),
}
OTHER_QUESTION_TYPE = "general"

# --- columns --------------------------------------------------------------------------
REQUIRED_COLUMNS = (
    "question_id", "title", "question_body", "answer_body",
    "tags", "score", "quality_score",
)
KNOWN_COLUMNS = (
    "question_id", "title", "question_body", "answer_body", "tags", "score",
    "answer_score", "view_count", "quality_score", "error_signatures",
    "infra_components", "question_type", "complexity",
    "processed_at", "question_metrics", "answer_metrics",
)
CRITICAL_COLUMNS = ("question_id", "question_body", "answer_body")
TEXT_COLUMNS = ("title", "question_body", "answer_body")
OUTLIER_COLUMNS = ("score", "answer_score", "view_count", "quality_score")

# --- declared table schema, per column ------------------------------------------------
DECLARED_SCHEMA = {
    "question_id": {"type": "int64", "nullable": False, "unique": True, "min_value": 1},
    "title": {"type": "object", "nullable": False, "min_length": 5, "max_length": 500},
    "question_body": {"type": "object", "nullable": False, "min_length": 20},
    "answer_body": {"type": "object", "nullable": False, "min_length": 50},
    "tags": {"type": "object", "nullable": False},
    "score": {"type": "int64", "nullable": False, "min_value": 0},
    "answer_score": {"type": "int64", "nullable": True, "min_value": 0},
    "quality_score": {"type": "float64", "nullable": False, "min_value": 0},
}

# --- texts ----------------------------------------------------------------------------
SYSTEM_PROMPT = (
    "You are an expert MLOps engineer helping to diagnose and fix infrastructure issues."
)
