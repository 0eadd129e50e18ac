"""Queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.session import spread, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import pii

    return pii.found(spread(table(spark, sf_dir, "issues")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import history

    return history.found(table(spark, sf_dir, "incoming_records"), table(spark, sf_dir, "exact_hashes"), table(spark, sf_dir, "minhash_sigs"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import licenses

    return licenses.findings(spread(table(spark, sf_dir, "raw_content")), table(spark, sf_dir, "license_names"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import handwritten

    return handwritten.found(spread(table(spark, sf_dir, "raw_content")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import credentials

    return credentials.found(spread(table(spark, sf_dir, "raw_content")))


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long contents are after redaction, which must not change any length or line end."""
    from siltworks.llm import credentials

    d = credentials.redacted(spread(table(spark, sf_dir, "raw_content")))
    size, lines = F.length("content"), F.length("content") - F.length(F.replace("content", F.lit("\n"), F.lit("")))
    return d.where("content is not null").groupBy("blob_id").agg(F.count("*").alias("n"), F.max(size).alias("n_chars"), F.max(lines).alias("n_line_ends"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import mojibake

    return mojibake.found(spread(table(spark, sf_dir, "raw_content")))


def p7_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import tokens

    return tokens.slices(spread(table(spark, sf_dir, "documents")), spread(table(spark, sf_dir, "raw_content")), table(spark, sf_dir, "shards"))


def p7_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import tokens

    return tokens.budget(spread(table(spark, sf_dir, "documents")), spread(table(spark, sf_dir, "raw_content")), table(spark, sf_dir, "shards"))


def p7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import tokens

    return tokens.by_shard(spread(table(spark, sf_dir, "raw_content")), table(spark, sf_dir, "shards"))


def p7_shard_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that p7_shards counts in each shard, and what the shard reported."""
    return p7_shards(spark, sf_dir).select("shard_id", "source_dataset", "n_texts", "reported")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import tokens

    return tokens.ids(spread(table(spark, sf_dir, "documents")))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import mixing

    return mixing.mixture(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "source_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import mixing

    return mixing.shares(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "source_targets"))


def p9_limited_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares within a budget of all tokens there are: the exponent is bisected to the repetition limits."""
    from siltworks.llm import mixing

    return mixing.shares(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "source_targets"), passes=1.0)


def p9_tempered_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of tempered natural weights whose entropy is that of the targets."""
    from siltworks.llm import mixing

    return mixing.shares(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "source_targets"), evenness="targets")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltworks.llm import language

    return language.found(spread(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p4_found, p5_found, p5_redacted, p6_found, p7_slices, p7_budget, p7_shards, p7_shard_texts, p8_ids, p9_mixture, p9_shares, p9_limited_shares, p9_tempered_shares, p10_found)}


def oracle_sql() -> dict[str, str]:
    """Where SQL can say the same; the others are tested against plain versions."""
    return {
        "p7_shard_texts": """WITH files AS (SELECT min(source_shard) AS source_shard FROM raw_content WHERE blob_id IS NOT NULL GROUP BY blob_id UNION ALL SELECT source_shard FROM raw_content WHERE blob_id IS NULL),
n AS (SELECT source_shard, count(*) AS n FROM files WHERE source_shard IS NOT NULL GROUP BY 1)
SELECT shard_id, source_dataset, coalesce(n, 0) AS n_texts, CASE WHEN token_count > 0 THEN token_count END AS reported FROM shards LEFT JOIN n ON shard_id = source_shard""",
        "p5_redacted": "SELECT blob_id, count(*) AS n, max(length(content)) AS n_chars, max(length(content) - length(replace(content, chr(10), ''))) AS n_line_ends FROM raw_content WHERE content IS NOT NULL GROUP BY 1",
    }
