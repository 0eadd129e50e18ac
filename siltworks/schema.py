"""Schemas of records, audit rows, repositories and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIST = T.ArrayType(T.StringType())


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "float": T.FloatType(), "boolean": T.BooleanType(), "array<string>": _LIST, "map<string,bigint>": T.MapType(T.StringType(), T.LongType())}


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (part.split() for part in text.split(", "))])


RECORD = _struct(
    "id string, record_type string, content string, content_sha256 string, size_bytes bigint, token_count bigint, line_count int, avg_line_length float, max_line_length int, alnum_ratio float, "
    "repo_name string, repo_url string, path string, language string, detected_licenses array<string>, license string, license_status string, commit_id string, stars bigint, created_at string, "
    "source_dataset string, source_datasets array<string>, source_shard string, source_record_id string, layer string, technologies array<string>, repo_category string, file_complexity float, repo_complexity float, "
    "quality_score float, quality_flags array<string>, secrets_redacted int, pii_redacted int, is_near_duplicate boolean, near_dup_cluster string, pipeline_version string, config_hash string"
)
EXCLUDED = _struct(
    "id string, content_sha256 string, record_type string, source_dataset string, source_shard string, repo_name string, path string, language string, size_bytes bigint, reason string, detail string"
)
REPO = _struct(
    "repo_name string, repo_url string, category string, capture string, n_files bigint, n_tokens bigint, n_commits bigint, n_issues bigint, n_deps bigint, languages array<string>, layers array<string>, "
    "technologies array<string>, licenses array<string>, has_tests boolean, has_ci boolean, has_infrastructure boolean, complexity float"
)
#: What a batch adds to a repository.
CHANGES = _struct(
    "repo_name string, source_shard string, repo_url string, n_files bigint, n_tokens bigint, n_commits bigint, n_issues bigint, n_deps bigint, has_tests boolean, has_ci boolean, has_infrastructure boolean, "
    "is_cli boolean, technologies array<string>, licenses array<string>, languages map<string,bigint>, layers map<string,bigint>, n bigint, linked bigint"
)
PROVENANCE = _struct("content_sha256 string, canonical_record_id string, source_datasets array<string>")

#: What an adapter must give; other columns of a record get their defaults.
RAW = _struct(
    "record_type string, content string, repo_name string, repo_url string, path string, language string, detected_licenses array<string>, commit_id string, stars bigint, created_at string, "
    "source_record_id string, quality_score float, quality_flags array<string>, source_dataset string, source_shard string"
)


def default(field: T.StructField) -> Column:
    """The value of a column that an adapter doesn't give: 0, an empty list, false, else null."""
    if field.name == "record_type":
        return F.lit("code")
    if field.name in ("size_bytes", "token_count", "line_count", "max_line_length", "avg_line_length", "alnum_ratio", "secrets_redacted", "pii_redacted"):
        return F.lit(0).cast(field.dataType)
    if isinstance(field.dataType, T.ArrayType):
        return F.array().cast(field.dataType)
    return F.lit(False) if isinstance(field.dataType, T.BooleanType) else F.lit(None).cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of a schema, cast, with defaults for missing columns and for nulls where the default isn't null."""
    return df.select(*[F.coalesce(F.col(f.name).cast(f.dataType), default(f)).alias(f.name) if f.name in df.columns else default(f).alias(f.name) for f in schema])


def audit(df: DataFrame, reason: Column, detail: Column) -> DataFrame:
    """Audit rows: who was excluded and why, never the content; details have at most 500 characters."""
    own = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EXCLUDED if f.name not in ("reason", "detail")]
    return df.select(*own, reason.alias("reason"), F.substring(detail, 1, 500).alias("detail"))
