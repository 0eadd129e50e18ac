"""Near-duplicate detection: shingles of words, signatures, lossless bands, verified pairs, greedy resolution.

Bands are chosen so that no pair the estimate accepts can be missed: two signatures that agree
in at least a of n positions differ in n - a, so of n - a + 1 bands one agrees as a whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators.base import StageResult
from siltworks.schema import audit
from siltworks.session import ensure_checkpoint_dir

_TOKEN = re.compile(r"[a-z0-9_]+")
_PRIME = (1 << 61) - 1


def permutations(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(seed)
    return rng.randint(1, 1 << 32, n, dtype=np.uint64) | np.uint64(1), rng.randint(0, 1 << 32, n, dtype=np.uint64)


def signature(content: str | None, k: int, perms: tuple[np.ndarray, np.ndarray]) -> bytes | None:
    """n unsigned 32-bit numbers; null where there are fewer than k words."""
    words = _TOKEN.findall((content or "").lower())
    if len(words) < k:
        return None
    base = np.array([xxhash.xxh32_intdigest(s) for s in {" ".join(words[i: i + k]) for i in range(len(words) - k + 1)}], dtype=np.uint64)
    a, b = perms
    out = np.full(len(a), 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(base), 2048):  # long texts in bounded blocks
        h = (base[i: i + 2048, None] * a + b) & np.uint64(0xFFFFFFFFFFFFFFFF)
        h ^= h >> np.uint64(29)
        out = np.minimum(out, (((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)) & np.uint64(0xFFFFFFFF)).min(axis=0))
    return out.astype("<u4").tobytes()


def signatures(records: DataFrame, num_perm: int = 128, shingle: int = 5, also: tuple[str, ...] = ()) -> DataFrame:
    """id, sig and the columns of also of records with enough words, a row for each record; contents stay in the workers."""

    def run(parts: Iterable[pa.RecordBatch]):
        perms = permutations(num_perm)
        for p in parts:
            yield pa.RecordBatch.from_arrays([p.column(0), pa.array([signature(t, shingle, perms) for t in p.column(1).to_pylist()], pa.binary()), *p.columns[2:]], names=["id", "sig", *also])

    df = records.select("id", "content", *also)
    out = ", ".join(["id string, sig binary", *(f"{c} {df.schema[c].dataType.simpleString()}" for c in also)])
    return df.mapInArrow(run, out).where("sig is not null")


def band_keys(sig: Column, num_perm: int, threshold: float) -> Column:
    """Hashes of the bands, each with its number; the number of bands makes the search lossless."""
    agree = math.ceil(threshold * num_perm)
    bands = num_perm - agree + 1
    width = num_perm // bands
    return F.array(*[F.xxhash64(F.lit(k), F.substring(sig, 1 + 4 * width * k, 4 * width)) for k in range(bands)])


def _agree(num_perm: int, agree: int):
    def run(parts: Iterable[pa.RecordBatch]):
        for p in parts:
            if p.num_rows:
                a, b = (np.frombuffer(b"".join(p.column(k).to_pylist()), "<u4").reshape(-1, num_perm) for k in (2, 3))
                same = (a == b).sum(axis=1)
                keep = pa.array(same >= agree)
                yield pa.RecordBatch.from_arrays([*(c.filter(keep) for c in p.columns[:2]), pa.array(same / num_perm).filter(keep)], names=["a", "b", "similarity"])

    return run


def similar_pairs(sigs: DataFrame, num_perm: int = 128, threshold: float = 0.8) -> DataFrame:
    """(a, b, similarity) of different signature classes (sid, sig), a < b; pairs of known classes, if there is such a column, are left out."""
    known = F.col("known") if "known" in sigs.columns else F.lit(False)
    keys = sigs.select("sid", known.alias("known"), F.explode(band_keys(F.col("sig"), num_perm, threshold)).alias("key"))
    pairs = keys.alias("x").join(keys.alias("y"), "key").where("x.sid < y.sid and not (x.known and y.known)").select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct()
    pairs = pairs.join(sigs.select(F.col("sid").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("sid").alias("b"), F.col("sig").alias("sb")), "b")
    return pairs.select("a", "b", "sa", "sb").mapInArrow(_agree(num_perm, math.ceil(threshold * num_perm)), "a bigint, b bigint, similarity double")


def _resolve(records: DataFrame, num_perm: int = 128, threshold: float = 0.8, shingle: int = 5, min_tokens: int = 30, exempt: tuple[str, ...] = ("commit", "issue"), order: list[str] | None = None, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """near_labels(), and id and sig of the records that stand for a class and are kept.

    Records are taken in order; one is a duplicate if an earlier kept record is similar, and its
    cluster is the smallest id of those. Equal signatures are one class: its first record stands
    for it, and the others are duplicates of that one or of what it repeats. Rounds go on until
    every class is decided; a round only looks at classes that are still open. n_links counts
    the other records similar to this one. known has id and sig of records that were kept in
    earlier batches: they come before all others, are kept in advance and have no links.
    """
    ensure_checkpoint_dir(records.sparkSession)
    eligible = records.where(~F.coalesce(F.col("record_type").isin(*exempt), F.lit(False)) & (F.col("token_count") >= min_tokens))
    at = F.struct(*[F.col(c) for c in (order or ["id"])], F.col("id").alias("_id"))
    # ids may recur in other shards, so places go along and aren't joined on the id
    members = signatures(eligible.withColumn("ord", at), num_perm, shingle, ("ord",)).withColumn("sid", F.xxhash64("sig")).checkpoint()
    classes = members.groupBy("sid").agg(F.first("sig").alias("sig"), F.min("ord").alias("ord"), F.count("*").alias("n"))
    classes = classes.select("sid", "sig", F.struct(F.lit(1).alias("_new"), "ord").alias("ord"), F.col("ord._id").alias("head"), "n", F.lit(False).alias("known"))
    if known is not None:
        k = known.withColumn("sid", F.xxhash64("sig")).groupBy("sid").agg(F.first("sig").alias("_sig"), F.min("id").alias("_head"))
        old = F.col("_head").isNotNull()
        classes = classes.join(k, "sid", "full").select(
            "sid", F.coalesce("sig", "_sig").alias("sig"), F.when(old, F.struct(F.lit(0).alias("_new"), F.lit(None).cast(classes.schema["ord"].dataType["ord"].dataType).alias("ord"))).otherwise(F.col("ord")).alias("ord"),
            F.coalesce("_head", "head").alias("head"), F.coalesce("n", F.lit(0)).alias("n"), old.alias("known"))
    classes = classes.checkpoint()
    pairs = similar_pairs(classes.select("sid", "sig", "known"), num_perm, threshold)
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    o = classes.select("sid", "ord", "head", "n")
    edges = both.join(o.select(F.col("sid").alias("a"), F.col("ord").alias("oa")), "a").join(
        o.select(F.col("sid").alias("b"), F.col("ord").alias("ob"), F.col("head").alias("hb"), F.col("n").alias("nb")), "b").checkpoint()
    earlier = edges.where("ob < oa").select("a", "b", "hb")
    state = classes.select("sid", F.col("known").cast("int").alias("state"))
    while True:
        seen = earlier.join(state.select(F.col("sid").alias("b"), F.col("state").alias("sb")), "b").groupBy("a").agg(F.max((F.col("sb") == 1)).alias("hit"), F.max(F.col("sb") == 0).alias("open"))
        state = state.join(seen, state.sid == seen.a, "left").select(
            "sid", F.when(F.col("state") > 0, F.col("state")).when(F.col("hit"), 2).when(F.col("open"), 0).otherwise(1).alias("state")).checkpoint()
        if not state.where("state = 0").head(1):
            break
    heads = state.where("state = 1").select(F.col("sid").alias("b"))
    label = earlier.join(heads, "b", "left_semi").groupBy("a").agg(F.min("hb").alias("cluster"))
    links = edges.groupBy("a").agg(F.sum("nb").alias("near"))
    c = o.join(state, "sid").join(label.withColumnRenamed("a", "la"), F.col("sid") == F.col("la"), "left").join(links.withColumnRenamed("a", "ka"), F.col("sid") == F.col("ka"), "left")
    c = c.select("sid", "head", F.when(F.col("state") == 1, F.col("head")).otherwise(F.col("cluster")).alias("target"), (F.coalesce("near", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    labels = members.select("id", "sid").join(c, "sid").select(
        "id", F.when(F.col("id") != F.col("target"), F.col("target")).alias("near_dup_cluster"), "n_links")
    return labels, classes.where("not known").join(heads, F.col("sid") == F.col("b"), "left_semi").select(F.col("head").alias("id"), "sig")


def near_labels(records: DataFrame, **options) -> DataFrame:
    """id, near_dup_cluster and n_links of every eligible record; see _resolve()."""
    return _resolve(records, **options)[0]


def near_dedup(records: DataFrame, mode: str = "annotate", **options) -> StageResult:
    """Records with is_near_duplicate and near_dup_cluster, or without near duplicates (mode drop); index: id and sig that later batches must know."""
    labels, index = _resolve(records, **options)
    labels = labels.select(F.col("id").alias("_id"), F.col("near_dup_cluster").alias("_c")).dropDuplicates(["_id"])
    df = records.join(labels, F.col("id") == F.col("_id"), "left")
    if mode == "drop":
        return StageResult(df.where("_c is null").select(*records.columns), audit(df.where("_c is not null"), F.lit("near_duplicate"), F.col("_c")), index)
    df = df.withColumn("is_near_duplicate", F.col("_c").isNotNull()).withColumn("near_dup_cluster", F.col("_c"))
    return StageResult(df.select(*records.columns), index=index)
