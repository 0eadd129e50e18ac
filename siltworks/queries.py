"""Queries of the curation operators over whole tables, and the SQL that DuckDB checks them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import config
from siltworks.functions import code, text
from siltworks.operators import filters, near, repos
from siltworks.operators.exact import exact_dedup, multi_source
from siltworks.operators.normalize import normalize, provenance
from siltworks.plans import pipeline
from siltworks.schema import RAW, conform
from siltworks.session import spread, table
from siltworks.sources import adapters

CFG = config.load(env={})


# --- what the queries start from ----------------------------------------------------------


def raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Files, issues and documents as adapters give them."""
    shards = table(spark, sf, "shards").select(F.col("shard_id").alias("source_shard"), "source_dataset")
    files = adapters.stack(spread(table(spark, sf, "raw_content")).join(shards, "source_shard", "left"), None, None)
    issues = spread(table(spark, sf, "issues"))
    threads = adapters.extras(issues.withColumnRenamed("source_shard", "_shard"), "x", "x", "issue")
    threads = threads.drop("source_dataset", "source_shard").join(
        issues.groupBy(F.col("issue_id").cast("string").alias("source_record_id")).agg(F.min("source_shard").alias("source_shard")), "source_record_id").join(shards, "source_shard", "left")
    docs = spread(table(spark, sf, "documents"))
    texts = docs.select(
        F.lit("doc").alias("record_type"), F.col("text").alias("content"), text.or_none(F.col("repo_name")).alias("repo_name"), F.col("doc_id").cast("string").alias("source_record_id"),
        F.col("source").alias("source_dataset"), F.col("source").alias("source_shard"))
    return conform(files, RAW).unionByName(conform(threads, RAW)).unionByName(conform(texts, RAW))


def records(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(raw_rows(spark, sf))


def traced(spark: SparkSession, sf: str) -> DataFrame:
    return provenance(records(spark, sf)).kept


def joined(c: str) -> F.Column:
    return F.array_join(c, "|")


# --- queries ------------------------------------------------------------------------------


def normalize_ids(spark, sf):
    return records(spark, sf).select("id", "record_type", "content_sha256", "size_bytes", "token_count", "source_dataset", "source_shard")


def normalize_id_collisions(spark, sf):
    raw = raw_rows(spark, sf).where(F.length("content") > 0)
    ids = raw.select("source_shard", text.record_id(F.col("repo_name"), F.col("path"), text.sha256(F.col("content"))).alias("id"))
    return ids.groupBy("source_shard", "id").agg(F.count("*").alias("n")).groupBy("source_shard").agg(F.sum(F.col("n") - 1).alias("collisions"), F.sum("n").alias("n_rows"))


def provenance_filter(spark, sf):
    r = provenance(records(spark, sf))
    return r.excluded.groupBy("reason", "source_dataset").agg(F.count("*").alias("n")).unionByName(r.kept.groupBy(F.lit("kept").alias("reason"), "source_dataset").agg(F.count("*").alias("n")))


def exact_dedup_kept(spark, sf):
    r = exact_dedup(traced(spark, sf), table(spark, sf, "shards"))
    return r.kept.select("id", "content_sha256", "source_dataset", "source_shard", joined("source_datasets").alias("source_datasets"))


def exact_dedup_excluded(spark, sf):
    return exact_dedup(traced(spark, sf), table(spark, sf, "shards")).excluded.select("id", "source_shard", "reason", "detail")


def exact_dedup_index(spark, sf):
    """Against the hashes of exact_hashes: how many records of each type are new."""
    index = table(spark, sf, "exact_hashes")
    rows = table(spark, sf, "incoming_records").where(F.length("content") > 0).select(
        F.col("id"), "record_type", text.sha256(F.col("content")).alias("content_sha256"), "source_dataset", "source_shard").dropDuplicates(["id"])
    r = exact_dedup(rows, table(spark, sf, "shards"), index)
    return r.kept.select("record_type", F.lit("kept").alias("reason")).unionByName(r.excluded.select("record_type", "reason")).groupBy("record_type", "reason").agg(F.count("*").alias("n"))


def multi_source_provenance(spark, sf):
    return multi_source(traced(spark, sf), table(spark, sf, "shards")).select("content_sha256", "canonical_record_id", joined("source_datasets").alias("source_datasets"))


def license_buckets(spark, sf):
    r = filters.mark_license(traced(spark, sf), CFG["licenses"])
    return r.groupBy("source_dataset", "license_status", F.coalesce("license", F.lit("")).alias("license")).agg(F.count("*").alias("n"))


def license_filter_excluded(spark, sf):
    return filters.license_filter(traced(spark, sf), CFG["licenses"]).excluded.select("id", "source_shard", "reason", "detail")


def quality_metrics(spark, sf):
    d = filters.metrics(traced(spark, sf))
    return d.select("id", "source_shard", "line_count", "max_line_length", F.col("_total").alias("total_length"), text.odd_characters(F.col("content")).alias("odd_characters"), text.sample_length(F.col("content")).alias("sample_length"))


def quality_flags(spark, sf):
    return filters.quality_flags(traced(spark, sf), CFG["quality"]).select("id", "source_shard", joined("quality_flags").alias("flags"))


def quality_excluded(spark, sf):
    return filters.quality_filter(traced(spark, sf), CFG["quality"]).excluded.select("id", "source_shard", "reason", "detail")


def repeated_lines(spark, sf):
    lines = text.lines(F.col("content"))
    return traced(spark, sf).where("record_type = 'code'").select("id", "source_shard", F.size(lines).alias("n_lines"), F.size(F.array_distinct(lines)).alias("n_distinct"))


def file_complexity(spark, sf):
    return traced(spark, sf).where("record_type = 'code'").select("id", "source_shard", code.file_complexity(F.col("content")).alias("complexity"))


def trivial_filter(spark, sf):
    return filters.trivial_filter(traced(spark, sf), CFG["complexity"]).excluded.select("id", "source_shard", "reason", "detail")


def infer_language(spark, sf):
    guessed = code.language(F.col("path"), F.lit(None).cast("string"))
    return traced(spark, sf).where("record_type = 'code'").select("id", "source_shard", guessed.alias("by_path"), code.language(F.col("path"), F.col("language")).alias("language"))


def file_layer(spark, sf):
    d = traced(spark, sf)
    return d.select("id", "source_shard", code.layer(F.col("path"), code.language(F.col("path"), F.col("language")), F.substring("content", 1, 4000)).alias("layer"))


def technologies(spark, sf):
    return traced(spark, sf).select("id", "source_shard", F.array_join(code.technologies(F.col("path"), F.substring("content", 1, 4000)), "|").alias("technologies"))


def dependency_counts(spark, sf):
    """Every content is counted as each kind of manifest, as few files of the tables are manifests."""
    d = traced(spark, sf).where("record_type = 'code'")
    return d.select("id", "source_shard", *[code.dependencies(F.lit(n), F.col("content")).alias(n.replace(".", "_")) for n in sorted(code.DEPENDENCIES)])


def repo_deltas(spark, sf):
    d = repos.deltas(repos.described(traced(spark, sf)))
    return d.select("repo_name", "source_shard", "n_files", "n_tokens", "n_commits", "n_issues", "n_deps", "has_tests", "has_ci", "has_infrastructure", joined("technologies").alias("technologies"))


def repo_language_hist(spark, sf):
    d = repos.totals(repos.deltas(repos.described(traced(spark, sf))))
    return d.select("repo_name", F.explode("languages").alias("language", "n"))


def repo_layer_hist(spark, sf):
    d = repos.totals(repos.deltas(repos.described(traced(spark, sf))))
    return d.select("repo_name", F.explode("layers").alias("layer", "n"))


def repo_interconnect(spark, sf):
    return repos.interconnect(repos.described(traced(spark, sf))).select("repo_name", F.col("batch").alias("source_shard"), "n", "linked")


def repo_complexity(spark, sf):
    d = repos.repositories(repos.described(traced(spark, sf)))
    return d.select("repo_name", F.floor(F.col("complexity") * 10 + 0.05).cast("bigint").alias("complexity_x10"), F.size(F.map_keys("languages")).alias("n_languages"))


def repo_category(spark, sf):
    return repos.repositories(repos.described(traced(spark, sf))).select("repo_name", "category")


def repo_export(spark, sf):
    d = repos.export(repos.repositories(repos.described(traced(spark, sf))))
    return d.select("repo_name", "repo_url", "capture", "n_files", "n_issues", joined("languages").alias("languages"), joined("licenses").alias("licenses"))


def secret_counts(spark, sf):
    d = filters.mark_secrets(traced(spark, sf), CFG["secrets"])
    return d.groupBy("record_type", F.coalesce("_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), F.sum("secrets_redacted").alias("secrets"), F.sum("pii_redacted").alias("pii"))


def near_dup_labels(spark, sf):
    return near.near_labels(traced(spark, sf))


def minhash_signature(spark, sf):
    d = near.signatures(traced(spark, sf).where("token_count >= 30"))
    return d.select("id", F.sha2("sig", 256).alias("sig_sha256"))


def subset_counts(spark, sf):
    return traced(spark, sf).groupBy(pipeline.subset_of().alias("subset"), "source_dataset").agg(F.count("*").alias("n_records"), F.sum("token_count").alias("n_tokens"))


def high_quality(spark, sf):
    d = filters.mark_license(filters.quality_flags(traced(spark, sf), CFG["quality"]), CFG["licenses"])
    return d.where(filters.high_quality()).select("id", "source_shard")


def excluded_by_reason(spark, sf):
    r = pipeline.run(raw_rows(spark, sf), CFG, table(spark, sf, "shards"))
    return r.excluded.groupBy("reason", "record_type").agg(F.count("*").alias("n"))


def global_stats(spark, sf):
    r = pipeline.run(raw_rows(spark, sf), CFG, table(spark, sf, "shards"))
    return pipeline.stats(r.records, r.excluded)


def blob_join(spark, sf):
    meta = table(spark, sf, "raw_content").dropDuplicates(["blob_id"])
    blobs = table(spark, sf, "raw_content").where("content is not null").select("blob_id", "content")
    return adapters.blobs(meta, blobs, "blob_code", "s", 0.5).select("source_record_id", "path", F.octet_length("content").alias("n_bytes"))


def commit_serialization(spark, sf):
    c = table(spark, sf, "raw_content").dropDuplicates(["blob_id"]).select(
        F.col("revision_id").alias("commit"), F.col("path").alias("old_file"), F.col("path").alias("new_file"), F.lit(None).cast("string").alias("old_contents"), F.col("content").alias("new_contents"),
        F.col("language").alias("subject"), F.col("src_encoding").alias("message"), F.col("language").alias("lang"), F.lit("mit").alias("license"), F.concat_ws(",", "repo_name", F.lit("other/repo")).alias("repos"))
    return adapters.commits(c, "s", "s").where("content is not null").select("commit_id", "repo_name", "path", text.sha256(F.col("content")).alias("sha"), F.length("content").alias("n_chars"))


def issue_threads(spark, sf):
    d = adapters.issues(table(spark, sf, "issues"), "s", "s").where("content is not null")
    return d.groupBy("source_record_id", "repo_url").agg(F.count("*").alias("n"), F.max(F.length("content")).alias("n_chars"))


def git_blob_hash(spark, sf):
    return table(spark, sf, "raw_content").where("content is not null").select("blob_id", text.git_blob_sha1(F.col("content")).alias("sha1")).distinct()


def shard_states(spark, sf):
    s = table(spark, sf, "shards")
    return s.groupBy("source_dataset", "state").agg(F.count("*").alias("n"), F.sum(F.coalesce("records_out", F.lit(0))).alias("records_out"), F.sum(F.coalesce("token_count", F.lit(0))).alias("tokens"))


def next_shards(spark, sf):
    """The order in which pending work is claimed: by priority, number and source."""
    from pyspark.sql import Window as W

    s = table(spark, sf, "shards")
    return s.select("shard_id", "state", F.row_number().over(W.partitionBy("state").orderBy("priority", "seq_index", "source_dataset")).alias("place"))


_ALL = (
    normalize_ids, normalize_id_collisions, provenance_filter, exact_dedup_kept, exact_dedup_excluded, exact_dedup_index, multi_source_provenance, license_buckets, license_filter_excluded, quality_metrics, quality_flags,
    quality_excluded, repeated_lines, file_complexity, trivial_filter, infer_language, file_layer, technologies, dependency_counts, repo_deltas, repo_language_hist, repo_layer_hist, repo_interconnect, repo_complexity,
    repo_category, repo_export, secret_counts, near_dup_labels, minhash_signature, subset_counts, high_quality, excluded_by_reason, global_stats, blob_join, commit_serialization, issue_threads, git_blob_hash, shard_states, next_shards,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


# --- the same in SQL ----------------------------------------------------------------------


def _s(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(map(_s, values)) + ")"


def _re(pattern: str) -> str:
    """A pattern for RE2."""
    return _s(pattern.replace("(?d)", ""))


def _hit(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {_re(pattern)})"


def _map_sql(column: str, pairs: dict[str, str]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN {_s(k)} THEN {_s(v)}" for k, v in sorted(pairs.items())) + " END"


_RAW = """
raw AS (
  SELECT 'code' AS record_type, r.content, nullif(r.repo_name, '') AS repo_name, nullif(r.path, '') AS path, nullif(r.language, '') AS language, coalesce(r.detected_licenses, []) AS detected_licenses,
    s.source_dataset, r.source_shard, r.blob_id AS source_record_id, r.visit_date AS created_at,
    list_filter([CASE WHEN r.is_vendor THEN 'vendored' END, CASE WHEN r.is_generated THEN 'generated_metadata' END], lambda x: x IS NOT NULL) AS flags
  FROM raw_content r LEFT JOIN shards s ON r.source_shard = s.shard_id
  UNION ALL
  SELECT 'issue', nullif(i.content, ''), nullif(i.repo_name, ''), NULL, NULL, [], s.source_dataset, m.source_shard, cast(i.issue_id AS varchar), cast(i.created_at AS varchar), []
  FROM issues i JOIN (SELECT issue_id, min(source_shard) AS source_shard FROM issues GROUP BY issue_id) m ON i.issue_id = m.issue_id LEFT JOIN shards s ON m.source_shard = s.shard_id
  UNION ALL
  SELECT 'doc', text, nullif(repo_name, ''), NULL, NULL, [], source, source, cast(doc_id AS varchar), NULL, [] FROM documents
),
hashed AS (SELECT *, sha256(content) AS content_sha256 FROM raw WHERE length(content) > 0),
named AS (SELECT *, substring(sha256(coalesce(repo_name, '') || chr(0) || coalesce(path, '') || chr(0) || content_sha256), 1, 32) AS id FROM hashed),
records AS (
  SELECT *, strlen(content) AS size_bytes, greatest(1, strlen(content) // 4) AS token_count FROM named
  QUALIFY row_number() OVER (PARTITION BY source_shard, id ORDER BY source_record_id NULLS LAST, created_at NULLS LAST) = 1
),
judged AS (
  SELECT *, CASE WHEN coalesce(source_dataset, '') = '' OR coalesce(source_shard, '') = '' THEN 'no_provenance' WHEN record_type = 'code' AND repo_name IS NULL THEN 'code_without_repo' END AS reason FROM records
),
traced AS (SELECT * EXCLUDE (reason, detected_licenses), list_filter(detected_licenses, lambda x: x IS NOT NULL AND x <> '') AS detected_licenses FROM judged WHERE reason IS NULL)
"""

_DEDUP = """
placed AS (SELECT t.*, coalesce(s.priority, 2147483647) AS priority, coalesce(s.seq_index, 9223372036854775807) AS seq_index FROM traced t LEFT JOIN shards s ON t.source_shard = s.shard_id),
ranked AS (
  SELECT *, row_number() OVER g AS n, row_number() OVER l AS m, first_value(id) OVER g AS best, first_value(id) OVER l AS first_here FROM placed
  WINDOW g AS (PARTITION BY content_sha256 ORDER BY priority, seq_index, source_shard, id), l AS (PARTITION BY content_sha256, source_shard ORDER BY priority, seq_index, source_shard, id)
),
sources AS (SELECT content_sha256, string_agg(source_dataset, '|' ORDER BY source_dataset) AS source_datasets, count(*) AS n_sources FROM (SELECT DISTINCT content_sha256, source_dataset FROM traced) GROUP BY 1)
"""


def _license_sql() -> str:
    one = f"coalesce({_map_sql('lower(trim(x))', code.LICENSE_IDS)}, trim(x))"
    rank = f"CASE WHEN x IN {_in(code.PERMISSIVE)} THEN 0 WHEN x IN {_in(code.WEAK)} THEN 1 WHEN x IN {_in(code.STRONG)} THEN 3 ELSE 2 END"
    perm = _in(CFG["licenses"]["source_level_permissive"])
    return f"""
ids AS (SELECT *, list_sort(list_distinct(list_transform(detected_licenses, lambda x: {one}))) AS ids FROM traced),
licensed AS (
  SELECT *, CASE WHEN len(ids) > 0 THEN array_to_string(ids, ', ') END AS license,
    CASE WHEN len(ids) > 0 THEN ['permissive', 'copyleft_weak', 'unknown', 'copyleft_strong'][list_max(list_transform(ids, lambda x: {rank})) + 1] WHEN source_dataset IN {perm} THEN 'permissive' ELSE 'unknown' END AS license_status
  FROM ids
)"""


_LINES = f"regexp_split_to_array(content, {_re(text.LINE_END)})"


def _metrics_sql() -> str:
    return f"""
split AS (SELECT *, {_LINES} AS parts FROM traced),
lined AS (SELECT * EXCLUDE (parts), CASE WHEN len(parts) > 1 AND parts[-1] = '' THEN parts[:-2] ELSE parts END AS lines FROM split),
measured AS (
  SELECT *, len(lines) AS line_count, list_max(list_transform(lines, lambda x: length(x))) AS max_line_length, list_sum(list_transform(lines, lambda x: length(x))) AS total_length,
    len(regexp_extract_all(substring(content, 1, 200000), {_re(text.ODD)})) AS odd_characters, least(length(content), 200000) AS sample_length
  FROM lined
)"""


def _flags_sql() -> str:
    q = CFG["quality"]
    base = "lower(regexp_extract(coalesce(path, ''), '[^/]*$'))"
    head = "substring(content, 1, 100000)"
    avg = "round(cast(total_length AS double) / line_count, 2)"
    alnum = "round((sample_length - odd_characters) / cast(greatest(sample_length, 1) AS double), 4)"
    p = "coalesce(path, '')"
    blob = f"CASE WHEN record_type = 'code' THEN coalesce(list_sum(list_transform(list_filter(regexp_extract_all(content, '[A-Za-z0-9+/=]+'), lambda x: length(x) >= {q['max_base64_run']}), lambda x: length(x))), 0) ELSE 0 END"
    c = "record_type = 'code' AND "
    rules = {
        "binary_like": f"contains({head}, chr(0)) OR (length({head}) - length(replace({head}, chr(65533), ''))) / cast(length({head}) AS double) > 0.02",
        "empty": f"length(regexp_replace(content, {_re(f'^{text.BLANK}+|{text.BLANK}+$')}, '', 'g')) < {q['min_content_chars']}",
        "too_large": f"size_bytes > {q['max_content_bytes']}",
        "minified": f"{c}({_hit(p, filters.MINIFIED_PATH)} OR (({avg} > {q['minified_avg_line_len']} OR max_line_length > {q['minified_max_line_len']}) AND language NOT IN ('JSON', 'Markdown')))",
        "vendored": f"{c}{_hit(p, filters.VENDOR_PATH)}",
        "generated_metadata": f"{c}{_hit(p, filters.GENERATED_PATH)}",
        "generated_marker": f"{c}{_hit('substring(content, 1, 2000)', filters.GENERATED_MARKER)}",
        "low_alnum": f"{c}{alnum} < {q['min_alnum_ratio']}",
        "suspicious_obfuscation": f"{c}{_hit(head, filters.OBFUSCATION)}",
        "lockfile": f"{c}{base} IN {_in(filters.LOCKFILES)}",
        "lockfile_large": f"{c}{base} IN {_in(filters.LOCKFILES)} AND size_bytes > {q['lockfile_max_bytes']}",
        "data_blob": f"{blob} > 0",
        "data_blob_heavy": f"{blob} / cast(length(content) AS double) > 0.5",
        "repeated_content": f"{c}line_count > 200 AND len(list_distinct(lines)) / cast(line_count AS double) < {q['repeated_line_ratio']}",
    }
    listed = ", ".join(f"CASE WHEN {cond} THEN {_s(name)} END" for name, cond in rules.items())
    return f"flagged AS (SELECT *, list_sort(list_distinct(list_concat(flags, list_filter([{listed}], lambda x: x IS NOT NULL)))) AS all_flags FROM measured)"


def _language_sql(declared: str) -> str:
    by = {e: k for k, v in code.EXTENSIONS.items() for e in v.split()}
    base = "lower(regexp_extract(path, '[^/]*$'))"
    ext = f"regexp_extract({base}, '[^.].*(\\.[^.]*)$', 1)"
    return f"coalesce({declared}, CASE WHEN starts_with({base}, 'dockerfile') THEN 'Dockerfile' WHEN {base} = 'makefile' THEN 'Makefile' ELSE {_map_sql(ext, by)} END)"


def _layer_sql(lang: str) -> str:
    p = "coalesce(path, '')"
    return (
        f"CASE WHEN {_hit(p, code.TEST_PATH)} THEN 'testing' WHEN {_hit(p, code.CI_PATH)} OR {_hit(p, code.INFRA_PATH)} THEN 'infrastructure' WHEN {_hit(p, code.DB_PATH)} OR {lang} = 'SQL' THEN 'database' "
        f"WHEN {lang} IN ('Dockerfile', 'HCL', 'Makefile') THEN 'infrastructure' WHEN lower(regexp_extract({p}, '[^/]*$')) IN {_in(code.MANIFESTS)} THEN 'configuration' "
        f"WHEN {lang} = 'YAML' AND {_hit('substring(content, 1, 4000)', code.K8S)} THEN 'infrastructure' WHEN {lang} IN {_in(code.CONFIG)} THEN 'configuration' WHEN {lang} IN ('Markdown', 'reStructuredText') THEN 'docs' "
        f"WHEN {lang} IN {_in(code.FRONTEND)} THEN 'frontend' WHEN {lang} IN {_in(code.BACKEND)} THEN 'backend' ELSE 'other' END"
    )


def _tech_sql() -> str:
    out = []
    for name, (by_path, by_head) in code.TECHNOLOGIES.items():
        conds = ([_hit("coalesce(path, '')", by_path)] if by_path else []) + ([_hit("substring(content, 1, 4000)", by_head)] if by_head else [])
        out.append(f"CASE WHEN {' OR '.join(conds)} THEN {_s(name)} END")
    return f"list_filter([{', '.join(out)}], lambda x: x IS NOT NULL)"


def _deps_sql(base: str) -> str:
    return "CASE " + base + " " + " ".join(f"WHEN {_s(n)} THEN len(regexp_extract_all(substring(content, 1, 100000), {_re(p)}))" for n, p in code.DEPENDENCIES.items()) + " ELSE 0 END"


def _described_sql() -> str:
    return f"""
spoken AS (SELECT * EXCLUDE (language), {_language_sql('language')} AS language FROM traced WHERE repo_name IS NOT NULL),
described AS (SELECT *, {_layer_sql('language')} AS layer, {_tech_sql()} AS techs, {_deps_sql("lower(regexp_extract(coalesce(path, ''), '[^/]*$'))")} AS deps,
  lower(array_to_string(regexp_extract_all(substring(content, 1, 20000), {_re(code.IMPORTS)}), ' ')) AS imports,
  lower(coalesce(CASE WHEN regexp_matches(regexp_extract(path, '[^/]*$'), '[^.].*\\.[^.]*$') THEN regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '') ELSE regexp_extract(path, '[^/]*$') END, '')) AS stem,
  {_hit('substring(content, 1, 4000)', code.CLI)} AS cli FROM spoken)"""


_LINKS = """
stems AS (SELECT DISTINCT repo_name, source_shard, stem FROM described WHERE length(stem) >= 3),
links AS (
  SELECT d.repo_name, d.source_shard, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM stems s WHERE s.repo_name = d.repo_name AND s.source_shard = d.source_shard AND s.stem <> d.stem AND contains(d.imports, s.stem))) AS linked
  FROM described d GROUP BY 1, 2
)"""


def _repo_sql() -> str:
    fam = {f: f"len(list_intersect(techs, [{', '.join(map(_s, t))}]))" for f, t in code.FAMILIES.items()}
    return f"""{_LINKS},
sums AS (
  SELECT repo_name, count(*) FILTER (record_type NOT IN ('commit', 'issue')) AS n_files, sum(token_count) AS n_tokens, count(*) FILTER (record_type = 'commit') AS n_commits, count(*) FILTER (record_type = 'issue') AS n_issues,
    sum(deps) AS n_deps, count(DISTINCT language) AS n_languages, count(DISTINCT layer) AS n_layers, bool_or(layer = 'testing') AS has_tests, bool_or(list_contains(techs, 'ci_cd')) AS has_ci, bool_or(layer = 'infrastructure') AS has_infrastructure,
    bool_or(cli) AS is_cli, list_distinct(flatten(list(techs))) AS techs, count(*) AS n_all, count(*) FILTER (layer = 'frontend') AS fe, count(*) FILTER (layer = 'backend') AS be, count(*) FILTER (layer = 'database') AS db,
    count(*) FILTER (layer = 'infrastructure') AS infra, count(*) FILTER (layer = 'configuration') AS conf
  FROM described GROUP BY 1
),
linked AS (SELECT repo_name, cast(sum(CASE WHEN n > 1 THEN linked ELSE 0 END) AS double) / sum(n) AS interconnect FROM links GROUP BY 1),
shares AS (
  SELECT *, cast(fe AS double) / n_all + CASE WHEN {fam['frontend']} > 0 THEN 0.15 ELSE 0 END AS sfe, cast(be AS double) / n_all + CASE WHEN {fam['backend']} > 0 THEN 0.15 ELSE 0 END AS sbe,
    cast(db AS double) / n_all + CASE WHEN {fam['db']} > 0 THEN 0.15 ELSE 0 END AS sdb, cast(infra AS double) / n_all + CASE WHEN {fam['infra']} > 0 THEN 0.15 ELSE 0 END AS sinfra, {fam['ml']} AS ml FROM sums
)"""


def oracle_sql() -> dict[str, str]:
    base = f"WITH {_RAW}"
    dedup = f"{base}, {_DEDUP}"
    lic, met = _license_sql(), _metrics_sql()
    full = f"{base}, {met}, {_flags_sql()}"
    desc = f"{base}, {_described_sql()}"
    kept = f"len(list_filter(list_intersect(all_flags, [{', '.join(map(_s, CFG['quality']['drop_flags']))}]), lambda x: NOT ((regexp_matches(regexp_extract(coalesce(path, ''), '[^/]*$'), {_re(filters.KEEP_NAME)}) OR {_hit("coalesce(path, '')", filters.KEEP_PATH)}) AND x IN {_in(filters.LENGTH_FLAGS)})))"
    fatal = kept[len("len("):-1]
    action = {"copyleft_weak": CFG["licenses"]["weak_copyleft_action"], "unknown": CFG["licenses"]["unknown_action"], "copyleft_strong": CFG["licenses"]["strong_copyleft_action"]}
    dropped = _in([b for b, a in action.items() if a == "drop"])
    rows = "SELECT DISTINCT ON (blob_id) * FROM raw_content"
    return {
        "normalize_ids": f"{base} SELECT id, record_type, content_sha256, size_bytes, token_count, source_dataset, source_shard FROM records",
        "normalize_id_collisions": f"{base} SELECT source_shard, cast(sum(n - 1) AS bigint) AS collisions, cast(sum(n) AS bigint) AS n_rows FROM (SELECT source_shard, id, count(*) AS n FROM named GROUP BY 1, 2) GROUP BY 1",
        "provenance_filter": f"{base} SELECT coalesce(reason, 'kept') AS reason, source_dataset, count(*) AS n FROM judged GROUP BY 1, 2",
        "exact_dedup_kept": f"{dedup} SELECT id, r.content_sha256, source_dataset, source_shard, s.source_datasets FROM ranked r JOIN sources s ON r.content_sha256 = s.content_sha256 WHERE n = 1",
        "exact_dedup_excluded": f"{dedup} SELECT id, source_shard, CASE WHEN m > 1 THEN 'exact_duplicate_intra' ELSE 'exact_duplicate_global' END AS reason, CASE WHEN m > 1 THEN first_here ELSE best END AS detail FROM ranked WHERE n > 1",
        "exact_dedup_index": """WITH rows AS (SELECT DISTINCT ON (id) id, record_type, sha256(content) AS h, source_shard, coalesce(s.priority, 2147483647) AS p, coalesce(s.seq_index, 9223372036854775807) AS q FROM incoming_records i LEFT JOIN shards s ON i.source_shard = s.shard_id WHERE length(content) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY p, q, source_shard NULLS FIRST, id) AS n, row_number() OVER (PARTITION BY h, source_shard ORDER BY p, q, id) AS m FROM rows)
SELECT record_type, CASE WHEN m > 1 THEN 'exact_duplicate_intra' WHEN e.canonical_record_id <> r.id OR e.canonical_shard_id <> r.source_shard THEN 'exact_duplicate_global' WHEN e.canonical_record_id IS NULL AND n > 1 THEN 'exact_duplicate_global' ELSE 'kept' END AS reason, count(*) AS n
FROM ranked r LEFT JOIN exact_hashes e ON lower(e.content_sha256) = r.h GROUP BY 1, 2""",
        "multi_source_provenance": f"{dedup} SELECT r.content_sha256, id AS canonical_record_id, s.source_datasets FROM ranked r JOIN sources s ON r.content_sha256 = s.content_sha256 WHERE n = 1 AND n_sources > 1",
        "license_buckets": f"{base}, {lic} SELECT source_dataset, license_status, coalesce(license, '') AS license, count(*) AS n FROM licensed GROUP BY 1, 2, 3",
        "license_filter_excluded": f"{base}, {lic} SELECT id, source_shard, 'license_' || license_status AS reason, coalesce(license, '') AS detail FROM licensed WHERE license_status IN {dropped}",
        "quality_metrics": f"{base}, {met} SELECT id, source_shard, line_count, max_line_length, cast(total_length AS bigint) AS total_length, odd_characters, sample_length FROM measured",
        "quality_flags": f"{full} SELECT id, source_shard, array_to_string(all_flags, '|') AS flags FROM flagged",
        "quality_excluded": f"{full} SELECT id, source_shard, 'quality' AS reason, array_to_string(list_sort({fatal}), ',') AS detail FROM flagged WHERE {kept} > 0",
        "repeated_lines": f"{base}, {met} SELECT id, source_shard, line_count AS n_lines, len(list_distinct(lines)) AS n_distinct FROM measured WHERE record_type = 'code'",
        "file_complexity": f"{base} SELECT id, source_shard, 1 + len(regexp_extract_all(substring(content, 1, 200000), {_re(code.BRANCH)})) AS complexity FROM traced WHERE record_type = 'code'",
        "trivial_filter": f"{base} SELECT id, source_shard, 'trivial' AS reason, cast(token_count AS varchar) || ' tokens' AS detail FROM traced WHERE record_type = 'code' AND token_count < {CFG['complexity']['min_file_tokens']}",
        "infer_language": f"{base} SELECT id, source_shard, {_language_sql('NULL')} AS by_path, {_language_sql('language')} AS language FROM traced WHERE record_type = 'code'",
        "file_layer": f"{base}, spoken AS (SELECT * EXCLUDE (language), {_language_sql('language')} AS language FROM traced) SELECT id, source_shard, {_layer_sql('language')} AS layer FROM spoken",
        "technologies": f"{base} SELECT id, source_shard, array_to_string({_tech_sql()}, '|') AS technologies FROM traced",
        "dependency_counts": f"{base} SELECT id, source_shard, {', '.join(f'{_deps_sql(_s(n))} AS ' + n.replace('.', '_') for n in sorted(code.DEPENDENCIES))} FROM traced WHERE record_type = 'code'",
        "repo_deltas": f"{desc} SELECT repo_name, source_shard, count(*) FILTER (record_type NOT IN ('commit', 'issue')) AS n_files, cast(sum(token_count) AS bigint) AS n_tokens, count(*) FILTER (record_type = 'commit') AS n_commits, count(*) FILTER (record_type = 'issue') AS n_issues, cast(sum(deps) AS bigint) AS n_deps, bool_or(layer = 'testing') AS has_tests, bool_or(list_contains(techs, 'ci_cd')) AS has_ci, bool_or(layer = 'infrastructure') AS has_infrastructure, array_to_string(list_sort(list_distinct(flatten(list(techs)))), '|') AS technologies FROM described GROUP BY 1, 2",
        "repo_language_hist": f"{desc} SELECT repo_name, language, count(*) AS n FROM described WHERE language IS NOT NULL GROUP BY 1, 2",
        "repo_layer_hist": f"{desc} SELECT repo_name, layer, count(*) AS n FROM described GROUP BY 1, 2",
        "repo_interconnect": f"{desc}, {_LINKS} SELECT repo_name, source_shard, n, linked FROM links",
        "repo_complexity": f"""{desc}, {_repo_sql()} SELECT s.repo_name, cast(floor(round(least(100.0, 14 * log10(n_files + 1) + 4 * log10(n_tokens + 1) + 6 * least(n_languages, 6) + 5 * least(n_layers, 6) + CASE WHEN has_tests THEN 6 ELSE 0 END
+ CASE WHEN has_infrastructure THEN 5 ELSE 0 END + CASE WHEN has_ci THEN 4 ELSE 0 END + 6 * log10(n_deps + 1) + 6 * log10(n_commits + n_issues + 1) + 10 * interconnect), 2) * 10 + 0.05) AS bigint) AS complexity_x10, n_languages FROM sums s JOIN linked l ON s.repo_name = l.repo_name""",
        "repo_category": f"""{desc}, {_repo_sql()} SELECT repo_name, CASE WHEN sinfra >= 0.6 THEN 'infrastructure' WHEN sdb >= 0.5 THEN 'database' WHEN ml >= 2 OR (ml = 1 AND cast(be AS double) / n_all >= 0.3) THEN 'ml_data' WHEN sfe >= 0.2 AND sbe >= 0.2 THEN 'full_stack'
WHEN sfe >= 0.5 THEN 'frontend' WHEN is_cli THEN 'cli' WHEN conf > 0 AND NOT has_infrastructure AND n_files BETWEEN 1 AND 50 THEN 'library' WHEN sbe >= 0.5 THEN 'backend' ELSE 'mixed' END AS category FROM shares""",
        "repo_export": f"{desc} SELECT repo_name, max(CASE WHEN contains(repo_name, '/') THEN 'https://github.com/' || repo_name END) AS repo_url, 'partial_stream_sample' AS capture, count(*) FILTER (record_type NOT IN ('commit', 'issue')) AS n_files, count(*) FILTER (record_type = 'issue') AS n_issues, array_to_string(list_sort(list_distinct(list(language) FILTER (language IS NOT NULL))), '|') AS languages, array_to_string(list_sort(list_distinct(flatten(list(detected_licenses)))), '|') AS licenses FROM described GROUP BY 1",
        "subset_counts": f"{base} SELECT CASE record_type WHEN 'commit' THEN 'commits' WHEN 'issue' THEN 'issues' ELSE 'full' END AS subset, source_dataset, count(*) AS n_records, cast(sum(token_count) AS bigint) AS n_tokens FROM traced GROUP BY 1, 2",
        "high_quality": f"{full}, {lic} SELECT f.id, f.source_shard FROM flagged f JOIN licensed l ON f.id = l.id AND f.source_shard = l.source_shard WHERE l.license_status = 'permissive' AND len(list_filter(f.all_flags, lambda x: x NOT IN {_in(filters.BENIGN)})) = 0",
        "blob_join": f"SELECT m.blob_id AS source_record_id, nullif(path, '') AS path, strlen(b.content) AS n_bytes FROM ({rows}) m JOIN (SELECT DISTINCT blob_id, content FROM raw_content WHERE content IS NOT NULL) b ON m.blob_id = b.blob_id",
        "commit_serialization": f"""WITH c AS ({rows}), d AS (SELECT revision_id AS commit_id, coalesce(nullif(trim(split_part(concat_ws(',', repo_name, 'other/repo'), ',', 1)), '')) AS repo_name, nullif(path, '') AS path, concat_ws(chr(10) || chr(10),
'commit ' || nullif(revision_id, ''), 'repo: ' || nullif(trim(split_part(concat_ws(',', repo_name, 'other/repo'), ',', 1)), ''), 'subject: ' || nullif(language, ''), CASE WHEN src_encoding IS DISTINCT FROM language THEN nullif(src_encoding, '') END, '+++ b/' || coalesce(nullif(path, ''), '') || chr(10) || content) AS t
FROM c WHERE content IS NOT NULL OR coalesce(nullif(src_encoding, ''), nullif(language, '')) IS NOT NULL) SELECT commit_id, repo_name, path, sha256(t) AS sha, length(t) AS n_chars FROM d WHERE t <> ''""",
        "issue_threads": "SELECT cast(issue_id AS varchar) AS source_record_id, CASE WHEN contains(repo_name, '/') THEN 'https://github.com/' || repo_name END AS repo_url, count(*) AS n, max(length(content)) AS n_chars FROM issues WHERE nullif(content, '') IS NOT NULL GROUP BY 1, 2",
        "git_blob_hash": "SELECT DISTINCT blob_id, sha1('blob ' || cast(strlen(content) AS varchar) || chr(0) || content) AS sha1 FROM raw_content WHERE content IS NOT NULL",
        "shard_states": "SELECT source_dataset, state, count(*) AS n, cast(sum(coalesce(records_out, 0)) AS bigint) AS records_out, cast(sum(coalesce(token_count, 0)) AS bigint) AS tokens FROM shards GROUP BY 1, 2",
        "next_shards": "SELECT shard_id, state, row_number() OVER (PARTITION BY state ORDER BY priority, seq_index, source_dataset) AS place FROM shards",
    }
