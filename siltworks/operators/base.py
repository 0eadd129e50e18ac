"""What a stage gives: kept records, audit rows of the excluded, what later batches must know, and the conditions they come from."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.schema import audit


@dataclass
class StageResult:
    kept: DataFrame
    excluded: DataFrame | None = None
    index: DataFrame | None = None


def mark(df: DataFrame, reason: Column, detail: Column | None = None) -> DataFrame:
    """df with _reason and _detail; a row that an earlier stage marked keeps its mark.

    Stages can so be chained in one pass, and rows are told apart once at the end.
    """
    detail = F.lit("") if detail is None else detail
    if "_reason" in df.columns:
        reason, detail = F.coalesce("_reason", reason), F.when(F.col("_reason").isNotNull(), F.col("_detail")).otherwise(detail)
    return df.withColumns({"_reason": reason, "_detail": detail})


def finish(df: DataFrame) -> StageResult:
    """Rows without a mark are kept; the others become audit rows.

    The filter also looks at a number that isn't deterministic: otherwise Catalyst would push it
    below the projections and evaluate all their patterns a second time in the filter.
    """
    df = df.withColumn("_n", F.monotonically_increasing_id())
    return StageResult(df.where("_reason is null and _n >= 0").drop("_reason", "_detail", "_n"), audit(df.where("_reason is not null and _n >= 0"), F.col("_reason"), F.col("_detail")))


def split(df: DataFrame, reason: Column, detail: Column | None = None) -> StageResult:
    return finish(mark(df, reason, detail))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def add_flag(flags: Column, *named: tuple[str, Column]) -> Column:
    """Sorted flags with those whose condition holds."""
    new = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), name) for name, cond in named]))
    return F.array_sort(F.array_union(F.coalesce(flags, F.array().cast("array<string>")), new))
