"""Exact deduplication by content hash, within shards, across shards and against an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.operators.base import StageResult
from siltworks.schema import audit

#: Order of processing; a table of shards gives priority and seq_index, otherwise the shard's name decides.
ORDER = ("_priority", "_seq", "source_shard", "id")


def ordered(records: DataFrame, shards: DataFrame | None = None) -> DataFrame:
    """Records with _priority and _seq of their shard (last where unknown)."""
    if shards is None:
        return records.withColumn("_priority", F.lit(0)).withColumn("_seq", F.lit(0).cast("bigint"))
    s = shards.select(F.col("shard_id").alias("_s"), F.col("priority").alias("_p"), F.col("seq_index").alias("_q")).dropDuplicates(["_s"])
    df = records.join(s, records.source_shard == s["_s"], "left")
    return df.withColumn("_priority", F.coalesce("_p", F.lit(2**31 - 1))).withColumn("_seq", F.coalesce("_q", F.lit(2**63 - 1))).drop("_s", "_p", "_q")


def _first(key: list[Column | str], order: list[str]) -> W:
    return W.partitionBy(*key).orderBy(*order)


def exact_dedup(records: DataFrame, shards: DataFrame | None = None, index: DataFrame | None = None) -> StageResult:
    """The first record of each content, in processing order; copies become audit rows.

    A copy of an earlier record of its own shard is exact_duplicate_intra with that shard's first
    id; the first copy of a shard is exact_duplicate_global with the canonical id: the index's
    (content_sha256, canonical_record_id and, to know a record that is run again, canonical_shard_id), else the first in order. source_datasets of a kept
    record holds the sources of all copies.

    Group sizes may be anything: minimums are aggregated map-side and joined back on the hash, so
    only hash, place and id of a hot content's copies are shuffled before they are dropped, and
    no window sorts a group in one task.
    """
    df = ordered(records, shards)
    order = F.struct(*ORDER)
    slim = df.select("content_sha256", "source_shard", "id", "source_dataset", order.alias("_o"))
    local = slim.groupBy("content_sha256", "source_shard").agg(F.min("_o").alias("_first"), F.collect_set("source_dataset").alias("_src"))
    overall = local.groupBy("content_sha256").agg(F.min("_first").alias("_best"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_src")))).alias("_sources"))
    if index is not None:
        place = F.col("canonical_shard_id") if "canonical_shard_id" in index.columns else F.lit(None).cast("string")
        known = index.select(F.lower("content_sha256").alias("_k"), F.col("canonical_record_id").alias("_known"), place.alias("_place")).dropDuplicates(["_k"])
        overall = overall.join(known, overall.content_sha256 == known["_k"], "left").drop("_k")
    else:
        overall = overall.withColumns({"_known": F.lit(None).cast("string"), "_place": F.lit(None).cast("string")})
    firsts = local.join(overall, "content_sha256").select(
        "content_sha256", F.col("source_shard").alias("_shard"), "_first", "_best", "_sources", "_known", "_place")
    df = df.withColumn("_o", order).join(firsts.withColumnRenamed("content_sha256", "_h"), (F.col("content_sha256") == F.col("_h")) & F.col("source_shard").eqNullSafe(F.col("_shard")))
    # in the index under its own id and shard, a record is itself and not a copy
    itself = (F.col("_known") == F.col("id")) & F.coalesce(F.col("_place") == F.col("source_shard"), F.lit(False))
    reason = F.when(F.col("_o") != F.col("_first"), "exact_duplicate_intra").when(F.col("_known").isNotNull() & ~itself, "exact_duplicate_global").when(
        F.col("_known").isNull() & (F.col("_o") != F.col("_best")), "exact_duplicate_global")
    detail = F.when(F.col("_o") != F.col("_first"), F.col("_first.id")).otherwise(F.coalesce("_known", F.col("_best.id")))
    df = df.withColumn("_reason", reason).withColumn("_detail", detail)
    kept = df.where("_reason is null").withColumn("source_datasets", F.col("_sources")).select(*records.columns)
    return StageResult(kept, audit(df.where("_reason is not null"), F.col("_reason"), F.col("_detail")))


def multi_source(records: DataFrame, shards: DataFrame | None = None) -> DataFrame:
    """content_sha256, canonical_record_id and source_datasets of contents that more than one source has."""
    df = ordered(records, shards).groupBy("content_sha256").agg(
        F.min(F.struct(*ORDER)).alias("o"), F.array_sort(F.collect_set("source_dataset")).alias("source_datasets"))
    return df.where(F.size("source_datasets") > 1).select("content_sha256", F.col("o.id").alias("canonical_record_id"), "source_datasets")
