"""The stage chain, its sinks, and commits of batches."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks import config
from siltworks.operators import filters, repos
from siltworks.operators.base import finish, union
from siltworks.operators.exact import exact_dedup
from siltworks.operators.near import near_dedup
from siltworks.operators.normalize import normalize, provenance
from siltworks.schema import CHANGES, EXCLUDED, RECORD, conform
from siltworks.session import ensure_checkpoint_dir

#: Subsets by record type; other types are in "full".
SUBSETS = {"commit": "commits", "issue": "issues"}


@dataclass
class Result:
    records: DataFrame
    excluded: DataFrame
    repos: DataFrame
    near_index: DataFrame | None = None
    changes: DataFrame | None = None


def run(raw: DataFrame, cfg: Mapping[str, Any], shards: DataFrame | None = None, index: DataFrame | None = None, near_index: DataFrame | None = None, changes: DataFrame | None = None) -> Result:
    """Raw rows through all stages; nothing runs before a result is written, but for near-duplicate rounds.

    index, near_index and changes hold contents, signatures and repository deltas of earlier batches.
    Repositories are aggregated after deduplication and before the filters that drop records.
    """
    gone: list[DataFrame] = []

    def take(r):
        if r.excluded is not None:
            gone.append(r.excluded)
        return r.kept

    ensure_checkpoint_dir(raw.sparkSession)
    df = take(provenance(normalize(raw, config.config_hash(cfg))))
    if cfg["dedup"]["exact"]["enabled"]:
        df = take(exact_dedup(df, shards, index))
    df = repos.described(df.withColumn("_declared", F.col("language"))).checkpoint()  # what the rounds, the repositories and the filters start from; patterns of technologies run once
    near, signed = cfg["dedup"]["near"], None
    if near["enabled"]:
        # signatures made with other settings can't be compared
        known = None if near_index is None else near_index.where((F.col("shingle_size") == near["shingle_size"]) & (F.octet_length("sig") == 4 * near["num_perm"]))
        r = near_dedup(df, near["mode"], num_perm=near["num_perm"], threshold=near["jaccard_threshold"], shingle=near["shingle_size"], min_tokens=near["min_tokens"], exempt=tuple(near["exempt_record_types"]), known=known)
        df, signed = take(r), r.index.withColumn("shingle_size", F.lit(near["shingle_size"]))
    own = repos.changes(df.drop("content").checkpoint())
    own = own.select(*[F.col(f.name).cast(f.dataType) for f in CHANGES]).checkpoint()
    every = own if changes is None else own.unionByName(changes.join(own.select("repo_name").distinct(), "repo_name", "left_semi"))
    table = repos.scored(every, every)
    # filters look at the declared language
    df = df.withColumns({"_language": F.col("language"), "language": F.col("_declared")}).drop("_declared", "imports", "stem", "cli", "n_deps")
    # one pass over contents marks what each filter drops; rows are told apart once, afterwards
    for step, part in ((filters.mark_license, "licenses"), (filters.mark_secrets, "secrets"), (filters.mark_quality, "quality"), (filters.mark_trivial, "complexity")):
        df = step(df, cfg[part])
    df = repos.redescribed(df.withColumn("language", F.col("_language")).drop("_language"), F.col("secrets_redacted") + F.col("pii_redacted") > 0).checkpoint()
    df = take(finish(df))
    df = repos.stamped(df, repos.stamps(table))
    return Result(conform(df, RECORD), conform(union(gone), EXCLUDED), repos.export(table), signed, own)


def subset_of() -> F.Column:
    kind = F.create_map(*[F.lit(x) for kv in SUBSETS.items() for x in kv])
    return F.coalesce(F.try_element_at(kind, F.col("record_type")), F.lit("full"))


def stats(records: DataFrame, excluded: DataFrame) -> DataFrame:
    """metric and value: records and tokens by subset, layers, licenses, flags, reasons of exclusion."""
    parts = [
        records.groupBy(F.concat(F.lit("output."), subset_of(), F.lit(".records")).alias("metric")).agg(F.count("*").alias("value")),
        records.groupBy(F.concat(F.lit("output."), subset_of(), F.lit(".tokens")).alias("metric")).agg(F.sum("token_count").alias("value")),
        records.groupBy(F.concat(F.lit("classify.layer."), "layer").alias("metric")).agg(F.count("*").alias("value")),
        records.groupBy(F.concat(F.lit("license."), "license_status").alias("metric")).agg(F.count("*").alias("value")),
        records.select(F.explode("quality_flags").alias("f")).groupBy(F.concat(F.lit("quality.flag."), "f").alias("metric")).agg(F.count("*").alias("value")),
        excluded.groupBy(F.concat(F.lit("excluded."), "reason").alias("metric")).agg(F.count("*").alias("value")),
        excluded.groupBy(F.lit("excluded.total").alias("metric")).agg(F.count("*").alias("value")),
        records.agg(F.sum("secrets_redacted").cast("bigint").alias("value")).select(F.lit("secrets.redacted_total").alias("metric"), F.coalesce("value", F.lit(0)).alias("value")),
        records.agg(F.sum("pii_redacted").cast("bigint").alias("value")).select(F.lit("secrets.pii_redacted_total").alias("metric"), F.coalesce("value", F.lit(0)).alias("value")),
    ]
    return union(parts).orderBy("metric")


_ROUTED = T.StructType([*RECORD.fields, T.StructField("subset", T.StringType()), T.StructField("source", T.StringType())])
_INDEX = T.StructType([T.StructField("content_sha256", T.StringType()), T.StructField("canonical_record_id", T.StringType())])
_NEAR = T.StructType([T.StructField("id", T.StringType()), T.StructField("sig", T.BinaryType()), T.StructField("shingle_size", T.IntegerType())])
#: Tables of a store; a batch may add nothing to any of them.
TABLES = {"data": _ROUTED, "high_quality": _ROUTED, "excluded": EXCLUDED, "repo_deltas": CHANGES, "exact_index": _INDEX, "near_index": _NEAR}


class Store:
    """A folder of outputs, written batch by batch; a batch counts once its commit file is there.

    A batch that is run again overwrites its own partitions, so side effects are the same however
    often it runs; what an interrupted batch left behind has no commit and is never read.
    Repositories may be spread over batches: a batch adds deltas and stamps its records by those
    of all batches so far; finalize() stamps the records of earlier batches again, in new folders
    that their commits then name.
    """

    def __init__(self, spark: SparkSession, folder: str, cfg: Mapping[str, Any]) -> None:
        self.spark, self.folder, self.cfg = spark, folder, cfg
        self.commits = os.path.join(folder, "_commits")
        os.makedirs(self.commits, exist_ok=True)

    def committed(self) -> list[str]:
        return sorted(n[:-5] for n in os.listdir(self.commits) if n.endswith(".json"))

    def commit_of(self, batch: str) -> dict[str, Any] | None:
        path = os.path.join(self.commits, f"{batch}.json")
        if not os.path.exists(path):
            return None
        with open(path, encoding="utf-8") as f:
            return json.load(f)

    def reconcile(self) -> list[str]:
        """Removes outputs of batches without a commit; gives their names."""
        gone = set()
        done = {self._folder(name, b) for name in TABLES for b in self.committed()}
        for name in os.listdir(self.folder):
            top = os.path.join(self.folder, name)
            if name.startswith("_") or not os.path.isdir(top):
                continue
            for part in os.listdir(top):
                if part.startswith("batch=") and os.path.join(top, part) not in done:
                    shutil.rmtree(os.path.join(top, part))
                    gone.add(part[6:])
        return sorted(gone)

    def table(self, name: str) -> DataFrame | None:
        """Committed rows of a table."""
        parts = [self._part(name, b) for b in self.committed() if os.path.isdir(self._folder(name, b))]
        return union(parts) if parts else None

    def _folder(self, name: str, batch: str) -> str:
        """Where a batch has its rows of a table; after they were stamped again, its commit says which revision counts."""
        return os.path.join(self.folder, name, f"batch={batch}" + (self.commit_of(batch) or {}).get("revisions", {}).get(name, ""))

    def _part(self, name: str, batch: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(self._folder(name, batch))

    def _write(self, name: str, df: DataFrame, batch: str, by: tuple[str, ...] = ()) -> None:
        w = df.write.mode("overwrite").option("compression", self.cfg["processing"]["parquet_compression"]).option("parquet.block.size", self.cfg["processing"]["parquet_row_group_max_mb"] << 20)
        (w.partitionBy(*by) if by else w).parquet(os.path.join(self.folder, name, f"batch={batch}"))

    def run_batch(self, raw: DataFrame, batch: str, shards: DataFrame | None = None, allow_config_change: bool = False) -> dict[str, Any]:
        """One batch: written, then committed by an atomic rename. A committed batch isn't run again."""
        own = config.config_hash(self.cfg)
        for b in self.committed():
            if (c := self.commit_of(b)) and c["config_hash"] != own and not allow_config_change:
                raise config.ConfigError(f"batch {b} was made with configuration {c['config_hash']}, this is {own}")
        if (c := self.commit_of(batch)) is not None:
            return c
        crash("before_batch")
        r = run(raw, self.cfg, shards, self.table("exact_index"), self.table("near_index"), self.table("repo_deltas"))
        routed = r.records.withColumn("subset", subset_of()).withColumn("source", F.coalesce("source_dataset", F.lit("unknown")))
        self._write("data", routed, batch, ("subset", "source"))
        crash("after_data")
        written = self._part("data", batch)
        if self.cfg["subsets"]["materialize_high_quality"]:
            self._write("high_quality", written.where(filters.high_quality(self.cfg["subsets"]["high_quality_min_score"])), batch, ("source",))
        self._write("excluded", r.excluded, batch)
        self._write("repo_deltas", r.changes, batch)
        # duplicates don't enter the index; records that later filters drop do, as their content was seen
        seen = r.excluded.where(~F.col("reason").isin("exact_duplicate_intra", "exact_duplicate_global", "no_content", "no_provenance", "code_without_repo"))
        self._write("exact_index", written.select("content_sha256", F.col("id").alias("canonical_record_id")).unionByName(seen.select("content_sha256", F.col("id").alias("canonical_record_id"))).dropDuplicates(["content_sha256"]), batch)
        if r.near_index is not None:
            self._write("near_index", r.near_index, batch)
        crash("before_commit")
        counts = {row.metric: row.value for row in stats(written, self._part("excluded", batch)).collect()}
        commit = {"batch": batch, "config_hash": own, "version": self.cfg["pipeline_version"], "stats": counts, "files": self._files(batch)}
        self._commit(commit)
        crash("after_commit")
        return commit

    def _commit(self, commit: dict[str, Any]) -> None:
        part = os.path.join(self.commits, f".{commit['batch']}.part")
        with open(part, "w", encoding="utf-8") as f:
            json.dump(commit, f, sort_keys=True, indent=1)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, os.path.join(self.commits, f"{commit['batch']}.json"))

    def _files(self, batch: str, revisions: Mapping[str, str] = {}) -> list[dict[str, Any]]:
        return [x for name in sorted(os.listdir(self.folder)) for x in self._listed(os.path.join(self.folder, name, f"batch={batch}" + revisions.get(name, "")))]

    def _listed(self, top: str) -> list[dict[str, Any]]:
        out = []
        for root, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".parquet"):
                    full = os.path.join(root, f)
                    out.append({"path": os.path.relpath(full, self.folder), "size": os.path.getsize(full), "sha256": file_sha256(full)})
        return out

    def repositories(self) -> DataFrame | None:
        """Totals, scores and categories of repositories over all committed batches."""
        for b in self.committed():
            if not os.path.isdir(self._folder("repo_deltas", b)):
                raise config.ConfigError(f"batch {b} has no repository deltas; it must be run again")
        deltas = self.table("repo_deltas")
        return None if deltas is None else repos.scored(deltas, deltas)

    def _total(self) -> list[dict[str, Any]]:
        """Files of the table of repositories, which is written unless it is that of the committed batches."""
        path, top = os.path.join(self.folder, "_repos.json"), os.path.join(self.folder, "repos", "total")
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                if (got := json.load(f))["batches"] == self.committed():
                    return got["files"]
        table = self.repositories()
        if table is None:
            return []
        repos.export(table).write.mode("overwrite").option("compression", self.cfg["processing"]["parquet_compression"]).parquet(top)
        files = self._listed(top)
        with open(f"{path}.part", "w", encoding="utf-8") as f:
            json.dump({"batches": self.committed(), "files": files}, f)
        os.replace(f"{path}.part", path)
        return files

    def _restamp(self) -> None:
        """Stamps records of repositories that later batches added to; a crash leaves either the old or the new folder in the commit."""
        table = self.repositories()
        if table is None:
            return
        stamps = repos.stamps(table).checkpoint()
        for b in self.committed():
            c = self.commit_of(b)
            old, new = c.get("revisions", {}), {}
            for name, by in (("data", ("subset", "source")), ("high_quality", ("source",))):
                if not os.path.isdir(self._folder(name, b)):
                    continue
                part = self._part(name, b)
                wrong = part.join(stamps, part.repo_name == stamps["_r"], "left").where("not (repo_complexity <=> _c and repo_category <=> _g)")
                if wrong.head(1):
                    new[name] = f".r{int(old.get(name, '.r0')[2:]) + 1}"
                    self._write(name, repos.stamped(part, stamps), b + new[name], by)
            if new:
                gone = [self._folder(name, b) for name in new]
                c["revisions"] = {**old, **new}
                c["files"] = self._files(b, c["revisions"])
                crash("before_restamp_commit")
                self._commit(c)
                for top in gone:
                    shutil.rmtree(top)

    def publish(self, target: str) -> tuple[int, int]:
        """Copies committed files and the table of repositories where they aren't there yet, verified by size and hash: (copied, skipped).

        Records have the stamps of the last finalize(), or else of their batch; what a published folder has of older revisions is removed.
        """
        copied = skipped = 0
        for f in self._public():
            to = os.path.normpath(os.path.join(target, f["path"]))
            if not to.startswith(os.path.normpath(target) + os.sep):
                raise ValueError(f"{f['path']} leaves the target folder")
            if os.path.exists(to) and os.path.getsize(to) == f["size"] and file_sha256(to) == f["sha256"]:
                skipped += 1
                continue
            os.makedirs(os.path.dirname(to), exist_ok=True)
            shutil.copyfile(os.path.join(self.folder, f["path"]), f"{to}.part")
            os.replace(f"{to}.part", to)
            copied += 1
        own = {f["path"] for f in self._public()}
        done = self.committed()
        for name in ("data", "high_quality", "repos"):
            top = os.path.join(target, name)
            for part in os.listdir(top) if os.path.isdir(top) else []:
                if part != "total" and re.sub(r"\.r\d+\Z", "", part)[6:] not in done and part[6:] not in done:
                    continue
                for root, _, files in os.walk(os.path.join(top, part)):
                    for f in files:
                        if os.path.relpath(os.path.join(root, f), target) not in own:
                            os.remove(os.path.join(root, f))
        return copied, skipped

    def _public(self) -> list[dict[str, Any]]:
        return [f for b in self.committed() for f in self.commit_of(b)["files"]] + self._total()

    def verify(self, target: str) -> list[str]:
        """Files of committed batches and of the table of repositories that are missing or changed in a published folder."""
        out = []
        for f in self._public():
            to = os.path.join(target, f["path"])
            if not os.path.exists(to) or os.path.getsize(to) != f["size"] or file_sha256(to) != f["sha256"]:
                out.append(f["path"])
        return out

    def finalize(self) -> dict[str, Any]:
        """Totals over all commits, final stamps and repositories, and a card that describes the dataset."""
        self._restamp()
        self._total()
        total: dict[str, int] = {}
        for b in self.committed():
            for k, v in self.commit_of(b)["stats"].items():
                total[k] = total.get(k, 0) + int(v or 0)
        out = {"batches": len(self.committed()), "config_hash": config.config_hash(self.cfg), "stats": total}
        with open(os.path.join(self.folder, "stats.json"), "w", encoding="utf-8") as f:
            json.dump(out, f, sort_keys=True, indent=1)
        rows = "\n".join(f"| {k} | {v:,} |" for k, v in sorted(total.items()))
        with open(os.path.join(self.folder, "CARD.md"), "w", encoding="utf-8") as f:
            f.write(f"# Curated source corpus\n\nBatches: {out['batches']}, configuration {out['config_hash']}.\n\n| measure | value |\n|-|-|\n{rows}\n")
        return out


def file_sha256(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


class Crash(RuntimeError):
    """Raised at a point that SILTWORKS_CRASH_AT names, to test recovery."""


def crash(point: str) -> None:
    if os.environ.get("SILTWORKS_CRASH_AT") == point:
        raise Crash(point)
