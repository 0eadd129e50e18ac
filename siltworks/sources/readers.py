"""Scans: parquet, JSON lines and gzipped JSON lines, with the schema given and damage tolerated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = {".parquet": "parquet", ".jsonl.gz": "json", ".json.gz": "json", ".jsonl": "json", ".json": "json"}


def format_of(path: str) -> str:
    """The reader for a file name; ValueError for an unknown ending."""
    for ending in sorted(FORMATS, key=len, reverse=True):
        if path.lower().endswith(ending):
            return FORMATS[ending]
    raise ValueError(f"no reader for {path}")


def read(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of files of one format.

    Blank and malformed JSON lines are skipped; a gzip file that ends abruptly gives the rows
    before its end. Gzip files can't be split, so their rows are spread before any work on them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kinds = {format_of(p) for p in paths}
    if len(kinds) != 1:
        raise ValueError(f"files of one format are read together, not of {sorted(kinds)}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kinds == {"parquet"}:
        return reader.parquet(*paths)
    df = reader.option("mode", "DROPMALFORMED").option("encoding", "UTF-8").option("ignoreCorruptFiles", "true").json(paths)
    return df.repartition(max(2, spark.sparkContext.defaultParallelism)) if any(p.endswith(".gz") for p in paths) else df


def skip_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """Rows after the first n in a defined order, for resuming within a file; whole files are skipped by their commits instead."""
    return df.orderBy(order).offset(n) if n else df
