"""Problem 2: new batches against everything accepted so far, by a table of pivot distances.

Two signatures of 128 numbers differ in d positions; d is a metric, and d <= RADIUS makes a
near duplicate. Whole signatures of unrelated records are all about equally far from any
pivot (nearly 128), so that pivots of the whole space prune nothing: of 19 million pairs of
incoming and accepted signatures, 64 pivots left 99.87 %. The space is therefore
cut into RADIUS + 1 blocks of three positions: a pair within RADIUS agrees on at least one
whole block, that is, its distance there is 0. In each block the table stores the distance
(a weighted city-block metric) to a fixed pivot; by the triangle inequality, records whose
distances to the pivot differ by more than 0 are further than 0 apart in that block and are
pruned. A range join of radius 0 on (block, distance) is an equi-join, which Spark
partitions by hash; AQE splits hot keys. Survivors are verified with the true metric. The
table grows by appended rows only; history is never read again as text.

Equal signatures are one class, so a third of all records with one signature is one row of
the join. Acceptance in arrival order is resolved in rounds over keys (hash or signature
class) that hold only the earliest accepted and the earliest undecided record, never over
pairs within a group.

Defined results: rows with null id are skipped; a null, empty or cut-off signature only
takes part by hash; a null hash is computed from content, and a null content with a null hash
only takes part by signature; rows delivered again aren't duplicates of themselves; ties in
order go to the smaller id.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.session import ensure_checkpoint_dir

POSITIONS = 128
AGREE = 96
RADIUS = POSITIONS - AGREE
BLOCKS, WIDTH = RADIUS + 1, 3

#: The pivot and the weights of the block metric, by rule.
PIVOT = (np.arange(1, BLOCKS * WIDTH + 1, dtype=np.int64) * 2_654_435_761) % (1 << 32)
WEIGHTS = np.array([1, 8_191, 33_554_393], dtype=np.int64)


def block_distances(sigs: np.ndarray) -> np.ndarray:
    """Distance of each block of each signature to the pivot's block, one column for each block."""
    d = np.abs(sigs[:, : BLOCKS * WIDTH].astype(np.int64) - PIVOT).reshape(len(sigs), BLOCKS, WIDTH)
    return (d * WEIGHTS).sum(axis=2)


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, POSITIONS)


def _table(parts: Iterable[pa.RecordBatch]):
    block = np.arange(BLOCKS, dtype=np.int64)
    for part in parts:
        if part.num_rows:
            # block number and distance in one number; a clash only adds a candidate
            d = block_distances(_numbers(part.column(1))) * BLOCKS + block
            flat = pa.array(d.reshape(-1))
            offsets = pa.array(np.arange(0, d.size + 1, BLOCKS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["sid", "keys"])


def pivot_table(sigs: DataFrame) -> DataFrame:
    """sid and key (block and distance to the pivot) of signature classes, BLOCKS rows for each."""
    return sigs.select("sid", "sig").mapInArrow(_table, "sid bigint, keys array<bigint>").select("sid", F.explode("keys").alias("key"))


def _verify(parts: Iterable[pa.RecordBatch]):
    for part in parts:
        if part.num_rows:
            same = (_numbers(part.column(2)) == _numbers(part.column(3))).sum(axis=1) >= AGREE
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(same)) for c in part.columns[:2]], names=["a", "b"])


#: Buckets that candidates' signatures are looked up by; a broadcast of at most so many numbers.
LOOKUP = 1 << 20


def near(new_table: DataFrame, table: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs (a, b) of different signature classes, a of new_table, b of table, within RADIUS.

    sigs (sid, sig) holds the signatures of both. Only signatures whose bucket some candidate has
    are shuffled for the verification; the buckets are a bounded set, however many candidates
    there are.
    """
    pairs = new_table.select(F.col("sid").alias("a"), "key").join(table.select(F.col("sid").alias("b"), "key"), "key").where("a <> b").select("a", "b").distinct().checkpoint()
    bucket = lambda c: F.pmod(F.col(c), F.lit(LOOKUP)).cast("int").alias("bucket")
    wanted = pairs.select(bucket("a")).union(pairs.select(bucket("b"))).distinct()
    sigs = sigs.join(F.broadcast(wanted), F.pmod(F.col("sid"), F.lit(LOOKUP)).cast("int") == F.col("bucket"), "left_semi")
    pairs = pairs.join(sigs.select(F.col("sid").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("sid").alias("b"), F.col("sig").alias("sb")), "b")
    return pairs.select("a", "b", "sa", "sb").mapInArrow(_verify, "a bigint, b bigint")


def _sid(sig: Column) -> Column:
    return F.when(F.length(sig) == 4 * POSITIONS, F.xxhash64(sig))


def _history(hashes: DataFrame, sigs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, sha) of canonical records, (id, sid) of those with a whole signature, and (sid, sig) of whole signatures."""
    canon = hashes.select(F.col("canonical_record_id").alias("id"), F.lower("content_sha256").alias("sha")).where("id is not null")
    whole = sigs.where(F.length("sig") == 4 * POSITIONS)
    members = whole.select(F.col("record_id").alias("id"), _sid(F.col("sig")).alias("sid")).distinct().join(canon.select("id"), "id", "left_semi")
    return canon, members, whole.select(_sid(F.col("sig")).alias("sid"), "sig")


def _incoming(records: DataFrame) -> DataFrame:
    """id, ord, sha, sid and sig of incoming rows."""
    sha = F.coalesce(F.lower("content_sha256"), F.sha2(F.encode("content", "UTF-8"), 256))
    order = F.struct(F.coalesce("batch_no", F.lit(2**31 - 1)).alias("batch"), F.coalesce("arrival_seq", F.lit(2**63 - 1)).alias("seq"), F.col("id"))
    return records.where("id is not null").select("id", order.alias("ord"), sha.alias("sha"), _sid(F.col("sig")).alias("sid"), F.when(F.length("sig") == 4 * POSITIONS, F.col("sig")).alias("sig"))


def _decide(rows: DataFrame, listens: DataFrame) -> DataFrame:
    """Accepted rows (id, ord, sha, sid): those without an accepted earlier row of another id on any key they listen to.

    rows hold the records that don't repeat history. A round accepts every undecided row that
    is the earliest undecided on all its keys and drops those that meet an accepted one.
    """
    own = lambda d: d.select("id", "ord", F.explode(F.array_compact(F.array(F.concat(F.lit("h"), "sha"), F.concat(F.lit("s"), F.col("sid").cast("string"))))).alias("key"))
    state = rows.select("id", "ord", "sha", "sid", F.lit(0).alias("state"))  # 0 undecided, 1 accepted, 2 duplicate
    while True:
        keys = own(state.where("state < 2").select("id", "ord", "sha", "sid")).join(state.select("ord", "state").distinct(), "ord")
        keys = keys.groupBy("key").agg(
            F.min(F.when(F.col("state") == 1, F.col("ord"))).alias("accepted"), F.min(F.when(F.col("state") == 0, F.col("ord"))).alias("undecided"))
        heard = listens.join(state.where("state = 0").select("ord"), "ord", "left_semi").join(keys, "key", "left").groupBy("ord").agg(
            F.max((F.col("accepted") < F.col("ord")) & (F.col("accepted.id") != F.col("id"))).alias("dup"), F.min("undecided").alias("first"))
        state = state.join(heard, "ord", "left").select(
            "id", "ord", "sha", "sid",
            F.when(F.col("state") > 0, F.col("state")).when(F.col("dup"), 2).when(F.col("first").isNull() | (F.col("first") >= F.col("ord")), 1).otherwise(0).alias("state"),
        ).checkpoint()
        if not state.where("state = 0").head(1):
            return state.where("state = 1").drop("state")


def duplicates(records: DataFrame, hashes: DataFrame, sigs: DataFrame) -> DataFrame:
    """id and accepted (id of the record it repeats) of every duplicate among incoming records."""
    ensure_checkpoint_dir(records.sparkSession)
    canon, members, whole = _history(hashes, sigs)
    rows = _incoming(records)
    classes = rows.where("sid is not null").select("sid", "sig", F.lit(True).alias("new")).unionByName(whole.withColumn("new", F.lit(False)))
    classes = classes.groupBy("sid").agg(F.first("sig").alias("sig"), F.max("new").alias("new")).checkpoint()  # the only copy of signatures
    pairs = near(pivot_table(classes.where("new")), pivot_table(classes), classes).checkpoint()
    rows = rows.drop("sig").dropDuplicates(["ord", "sha", "sid"]).checkpoint()
    # what a row listens to: its hash, its own class and the classes near it
    listens = rows.select("id", "ord", F.concat(F.lit("h"), "sha").alias("key")).where("key is not null")
    mine = rows.where("sid is not null").select("id", "ord", "sid")
    listens = listens.unionByName(mine.select("id", "ord", F.concat(F.lit("s"), F.col("sid").cast("string")).alias("key")))
    listens = listens.unionByName(mine.join(pairs, mine.sid == pairs.a).select("id", "ord", F.concat(F.lit("s"), F.col("b").cast("string")).alias("key"))).checkpoint()
    past = canon.select(F.col("id").alias("accepted"), F.concat(F.lit("h"), "sha").alias("key")).where("key is not null")
    past = past.unionByName(members.select(F.col("id").alias("accepted"), F.concat(F.lit("s"), F.col("sid").cast("string")).alias("key")))
    known = listens.join(past, "key").where("accepted <> id").select("id", "ord", "accepted").checkpoint()
    fresh = rows.join(known.select("ord"), "ord", "left_anti")
    accepted = _decide(fresh, listens)
    own = accepted.select(F.col("id").alias("accepted"), F.col("ord").alias("at"), F.explode(F.array_compact(F.array(F.concat(F.lit("h"), "sha"), F.concat(F.lit("s"), F.col("sid").cast("string"))))).alias("key"))
    among = listens.join(own, "key").where("at < ord and accepted <> id").select("id", "accepted")
    return known.select("id", "accepted").unionByName(among).distinct()


def found(records: DataFrame, hashes: DataFrame, sigs: DataFrame) -> DataFrame:
    """p2_found: one row for each pair (incoming id, accepted id), the smaller string first."""
    d = duplicates(records, hashes, sigs)
    return d.select(F.least("id", "accepted").alias("id_a"), F.greatest("id", "accepted").alias("id_b")).distinct()


class PivotIndex:
    """The accepted records and their pivot distances in a folder, to which each batch appends.

    Tables: accepted (id, sha), classes (sid, sig), pivots (sid, key), members (id, sid), each
    partitioned by batch. A batch reads its own records and these tables; nothing is rewritten,
    and a batch that is run again overwrites only its own partitions.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")

    def _read(self, name: str, before: int) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, name)).where(F.col("batch") < before)

    def _append(self, name: str, df: DataFrame, batch: int) -> None:
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").partitionBy("batch").parquet(os.path.join(self.folder, name))

    def _add(self, accepted: DataFrame, batch: int) -> None:
        self._append("accepted", accepted.select("id", "sha"), batch)
        members = accepted.where("sid is not null")
        self._append("members", members.select("id", "sid").distinct(), batch)
        classes = members.groupBy("sid").agg(F.first("sig").alias("sig"))
        self._append("classes", classes, batch)
        self._append("pivots", pivot_table(classes), batch)

    def build(self, hashes: DataFrame, sigs: DataFrame) -> None:
        """History as batch -1."""
        canon, members, whole = _history(hashes, sigs)
        whole = whole.groupBy("sid").agg(F.first("sig").alias("sig"))
        self._add(canon.join(members, "id", "left").join(whole, "sid", "left"), -1)

    def check(self, records: DataFrame, batch: int) -> DataFrame:
        """Duplicates (id, accepted) of one batch; the records that aren't are appended."""
        ensure_checkpoint_dir(self.spark)
        rows = _incoming(records)
        classes = rows.where("sid is not null").groupBy("sid").agg(F.first("sig").alias("sig"))
        table = pivot_table(classes)
        # history is scanned, but neither grouped nor sorted as a whole: of its distances only those that meet one of the
        # batch go on, of its signatures only those of candidates
        keys = table.select("key").distinct()
        pivots = self._read("pivots", batch).select("sid", "key").join(keys, "key", "left_semi").unionByName(table)
        every = self._read("classes", batch).select("sid", "sig").unionByName(classes)
        pairs = near(table, pivots, every).distinct().checkpoint()
        key = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
        rows = rows.dropDuplicates(["ord", "sha", "sid"]).checkpoint()
        mine = rows.where("sid is not null").select("id", "ord", "sid")
        listens = rows.select("id", "ord", key("h", "sha").alias("key")).where("key is not null").unionByName(mine.select("id", "ord", key("s", "sid").alias("key")))
        listens = listens.unionByName(mine.join(pairs, mine.sid == pairs.a).select("id", "ord", key("s", "b").alias("key"))).checkpoint()
        past = self._read("accepted", batch).select(F.col("id").alias("accepted"), key("h", "sha").alias("key")).where("key is not null")
        past = past.unionByName(self._read("members", batch).select(F.col("id").alias("accepted"), key("s", "sid").alias("key")))
        known = listens.join(past, "key").where("accepted <> id").select("id", "ord", "accepted").checkpoint()
        accepted = _decide(rows.drop("sig").join(known.select("ord"), "ord", "left_anti"), listens)
        own = accepted.select(F.col("id").alias("accepted"), F.col("ord").alias("at"), F.explode(F.array_compact(F.array(key("h", "sha"), key("s", "sid")))).alias("key"))
        among = listens.join(own, "key").where("at < ord and accepted <> id").select("id", "accepted")
        out = known.select("id", "accepted").unionByName(among).distinct().checkpoint()
        self._add(accepted.join(rows.select("ord", "sig"), "ord").dropDuplicates(["id", "sha", "sid"]), batch)
        return out
