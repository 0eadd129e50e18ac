"""Raw rows to records: identity, sizes, lineage; provenance checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.config import VERSION
from siltworks.functions import text
from siltworks.operators.base import StageResult, split
from siltworks.schema import RAW, RECORD, conform


def normalize(raw: DataFrame, config_hash: str = "", version: str = VERSION, collapse: bool = True) -> DataFrame:
    """Records of raw rows whose content isn't empty.

    Rows of one shard with the same id are one record: the one with the smallest source_record_id
    and created_at. Null contents aren't records; other nulls get the schema's defaults.
    """
    df = conform(raw, RAW).where(F.length("content") > 0)
    # what is known of the content is computed where it is read, so that queries without it don't shuffle it
    df = df.withColumns({"content_sha256": text.sha256(F.col("content")), "size_bytes": F.octet_length("content").cast("bigint"), "token_count": text.token_estimate(F.col("content"))})
    df = df.withColumns({
        "id": text.record_id(F.col("repo_name"), F.col("path"), F.col("content_sha256")), "source_datasets": F.array_compact(F.array("source_dataset")),
        "pipeline_version": F.lit(version), "config_hash": F.lit(config_hash)})
    if collapse:
        first = W.partitionBy("source_shard", "id").orderBy(F.col("source_record_id").asc_nulls_last(), F.col("created_at").asc_nulls_last())
        df = df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return conform(df, RECORD)


def provenance(records: DataFrame) -> StageResult:
    """Records that can be traced (those of no bytes have no content); empty licenses go, and a repository "owner/name" gets its address."""
    reason = (
        F.when((F.coalesce("size_bytes", F.lit(0)) == 0) | F.col("content_sha256").isNull(), "no_content")
        .when((F.coalesce("source_dataset", F.lit("")) == "") | (F.coalesce("source_shard", F.lit("")) == ""), "no_provenance")
        .when((F.col("record_type") == "code") & (F.coalesce("repo_name", F.lit("")) == ""), "code_without_repo")
    )
    r = split(records, reason)
    url = F.coalesce(F.nullif("repo_url", F.lit("")), F.when(F.contains("repo_name", F.lit("/")), F.concat(F.lit("https://github.com/"), "repo_name")))
    r.kept = r.kept.withColumn("detected_licenses", F.filter("detected_licenses", lambda x: x.isNotNull() & (x != ""))).withColumn("repo_url", url)
    return r
