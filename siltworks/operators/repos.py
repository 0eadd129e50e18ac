"""Repository aggregates: batch deltas, totals, links between files, scores and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import code, text


def described(records: DataFrame) -> DataFrame:
    """Records with language, layer, technologies, dependencies, imports, stem and cli, without contents."""
    head = F.substring("content", 1, 4000)
    df = records.withColumn("language", code.language(F.col("path"), F.col("language")))
    return df.withColumns({
        "layer": code.layer(F.col("path"), F.col("language"), head), "technologies": code.technologies(F.col("path"), head), "n_deps": code.dependencies(F.col("path"), F.col("content")),
        "imports": code.import_text(F.col("content")), "stem": F.lower(text.stem(F.col("path"))), "cli": F.coalesce(head.rlike(code.CLI), F.lit(False))})


def redescribed(records: DataFrame, changed: Column) -> DataFrame:
    """Described records whose content was changed since get language, layer and technologies anew; the others keep theirs."""
    head = F.substring("content", 1, 4000)
    again = {"layer": code.layer(F.col("path"), F.col("language"), head), "technologies": code.technologies(F.col("path"), head)}
    return records.withColumns({c: F.when(changed, new).otherwise(F.col(c)) for c, new in again.items()})


def _histogram(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """A map from values to counts for each key, counted before it is gathered."""
    one = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    return one.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(column, "n")))).alias(f"{column}s"))


def deltas(described_records: DataFrame, batch: str = "source_shard") -> DataFrame:
    """What each batch adds to each repository; adding up deltas gives totals, however batches are cut."""
    d = described_records.where("repo_name is not null and repo_name <> ''")
    k = ["repo_name", batch]
    kind = F.col("record_type")
    sums = d.groupBy(*k).agg(
        F.max("repo_url").alias("repo_url"), F.count_if(~kind.isin("commit", "issue")).alias("n_files"), F.sum("token_count").alias("n_tokens"), F.count_if(kind == "commit").alias("n_commits"),
        F.count_if(kind == "issue").alias("n_issues"), F.sum("n_deps").alias("n_deps"), F.bool_or(F.col("layer") == "testing").alias("has_tests"),
        F.bool_or(F.array_contains("technologies", "ci_cd")).alias("has_ci"), F.bool_or(F.col("layer") == "infrastructure").alias("has_infrastructure"), F.bool_or("cli").alias("is_cli"),
        F.collect_set("technologies").alias("_t"), F.collect_set("detected_licenses").alias("_l"),
    )
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.col(c))))
    sums = sums.withColumn("technologies", flat("_t")).withColumn("licenses", flat("_l")).drop("_t", "_l")
    return sums.join(_histogram(d, k, "language"), k, "left").join(_histogram(d, k, "layer"), k, "left")


def totals(deltas_: DataFrame) -> DataFrame:
    """One row for each repository over all batches."""
    k = "repo_name"
    sums = deltas_.groupBy(k).agg(
        F.max("repo_url").alias("repo_url"), *[F.sum(c).alias(c) for c in ("n_files", "n_tokens", "n_commits", "n_issues", "n_deps")],
        *[F.bool_or(c).alias(c) for c in ("has_tests", "has_ci", "has_infrastructure", "is_cli")],
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in ("technologies", "licenses")],
    )
    for c in ("languages", "layers"):
        one = deltas_.select(k, F.explode(c).alias("v", "m")).groupBy(k, "v").agg(F.sum("m").alias("m"))
        sums = sums.join(one.groupBy(k).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("v", "m")))).alias(c)), k, "left")
    return sums


def interconnect(described_records: DataFrame, batch: str = "source_shard") -> DataFrame:
    """Share of a repository's files (within a batch) whose import lines contain another file's stem.

    The pairs of a repository are never built: imports are cut into words, and a stem is looked up
    among the pieces a word contains. Stems have at least 3 characters; lengths that a repository's
    stems don't have aren't cut.
    """
    d = described_records.where("repo_name is not null and repo_name <> ''").select("repo_name", F.col(batch).alias("batch"), "id", "imports", F.coalesce("stem", F.lit("")).alias("stem"))
    stems = d.where(F.length("stem") >= 3).select("repo_name", "batch", "stem").distinct()
    sizes = d.groupBy("repo_name", "batch").agg(F.count("*").alias("n"))
    lengths = stems.groupBy("repo_name", "batch").agg(F.collect_set(F.length("stem")).alias("lengths"))
    # every substring of the import text that has the length of some stem of the repository
    words = d.where(F.length("imports") > 0).join(lengths, ["repo_name", "batch"]).select("repo_name", "batch", "id", "stem", "imports", F.explode("lengths").alias("len"))
    words = words.where(F.length("imports") >= F.col("len"))
    piece = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("imports") - F.col("len") + 1), lambda i: F.substring(F.col("imports"), i, F.col("len"))))
    pieces = words.select("repo_name", "batch", "id", "stem", F.explode(piece).alias("piece")).where("piece <> stem")
    hit = pieces.join(stems.withColumnRenamed("stem", "piece"), ["repo_name", "batch", "piece"], "left_semi").select("repo_name", "batch", "id").distinct()
    linked = hit.groupBy("repo_name", "batch").agg(F.count("*").alias("linked"))
    return sizes.join(linked, ["repo_name", "batch"], "left").select(
        "repo_name", "batch", "n", F.coalesce("linked", F.lit(0)).alias("linked"), F.when(F.col("n") < 2, 0.0).otherwise(F.round(F.coalesce("linked", F.lit(0)) / F.col("n"), 4)).alias("interconnect"))


def score(link: Column) -> Column:
    """Complexity of a repository, 0 to 100."""
    log = lambda c: F.log10(F.col(c) + 1)
    size = lambda c: F.least(F.coalesce(F.size(F.map_keys(c)), F.lit(0)), F.lit(6))
    has = lambda c, w: F.when(F.col(c), F.lit(w)).otherwise(0.0)
    s = (
        14.0 * log("n_files") + 4.0 * log("n_tokens") + 6.0 * size("languages") + 5.0 * size("layers") + has("has_tests", 6.0) + has("has_infrastructure", 5.0) + has("has_ci", 4.0)
        + 6.0 * log("n_deps") + 6.0 * F.log10(F.col("n_commits") + F.col("n_issues") + 1) + 10.0 * F.least(F.greatest(F.coalesce(link, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    )
    return F.round(F.least(s, F.lit(100.0)), 2)


def category() -> Column:
    """Category from the shares of layers and the families of technologies."""
    count = lambda name: F.coalesce(F.try_element_at("layers", F.lit(name)), F.lit(0))
    every = F.greatest(F.lit(1), F.coalesce(F.aggregate(F.map_values("layers"), F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)))
    techs = lambda f: F.size(F.array_intersect("technologies", F.array(*map(F.lit, code.FAMILIES[f]))))
    share = lambda name: count(name) / every
    plus = lambda name, f: share(name) + F.when(techs(f) > 0, 0.15).otherwise(0.0)
    fe, be, db, infra = plus("frontend", "frontend"), plus("backend", "backend"), plus("database", "db"), plus("infrastructure", "infra")
    library = (count("configuration") > 0) & ~F.col("has_infrastructure") & F.col("n_files").between(1, 50)
    return (
        F.when(infra >= 0.6, "infrastructure").when(db >= 0.5, "database")
        .when((techs("ml") > 0) & ((techs("ml") >= 2) | (share("backend") >= 0.3)), "ml_data")
        .when((fe >= 0.2) & (be >= 0.2), "full_stack").when(fe >= 0.5, "frontend")
        .when(F.col("is_cli"), "cli").when(library, "library").when(be >= 0.5, "backend").otherwise("mixed")
    )


def changes(described_records: DataFrame, batch: str = "source_shard") -> DataFrame:
    """deltas() with n and linked, the records and linked records of interconnect()."""
    d = deltas(described_records, batch)
    link = interconnect(described_records, batch).select(F.col("repo_name").alias("_r"), F.col("batch").alias("_b"), "n", "linked")
    return d.join(link, (d.repo_name == link["_r"]) & d[batch].eqNullSafe(link["_b"]), "left").drop("_r", "_b")


def scored(deltas_: DataFrame, links: DataFrame) -> DataFrame:
    """Totals with interconnect (over all batches), complexity and category; links has n and linked of each batch."""
    t = totals(deltas_)
    link = links.groupBy(F.col("repo_name").alias("_r")).agg((F.sum(F.when(F.col("n") > 1, F.col("linked")).otherwise(0)) / F.sum("n")).alias("interconnect"))
    t = t.join(link, t.repo_name == link["_r"], "left").drop("_r")
    return t.withColumn("complexity", score(F.col("interconnect"))).withColumn("category", category())


def stamps(scored_: DataFrame) -> DataFrame:
    """What records get from their repository: _r (its name), _c (complexity), _g (category)."""
    return scored_.select(F.col("repo_name").alias("_r"), F.col("complexity").cast("float").alias("_c"), F.col("category").alias("_g"))


def stamped(records: DataFrame, stamps_: DataFrame) -> DataFrame:
    return records.join(stamps_, records.repo_name == stamps_["_r"], "left").withColumn("repo_complexity", F.col("_c")).withColumn("repo_category", F.col("_g")).drop("_r", "_c", "_g")


def repositories(described_records: DataFrame, batch: str = "source_shard") -> DataFrame:
    return scored(deltas(described_records, batch), interconnect(described_records, batch))


def export(repos: DataFrame) -> DataFrame:
    """The table that is published: keys of histograms, sorted by name."""
    keys = lambda c: F.array_sort(F.coalesce(F.map_keys(c), F.array().cast("array<string>")))
    return repos.select(
        "repo_name", "repo_url", "category", F.lit("partial_stream_sample").alias("capture"), "n_files", "n_tokens", "n_commits", "n_issues", "n_deps", keys("languages").alias("languages"), keys("layers").alias("layers"),
        "technologies", "licenses", "has_tests", "has_ci", "has_infrastructure", F.col("complexity").cast("float").alias("complexity"))
