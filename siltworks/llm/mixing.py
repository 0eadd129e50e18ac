"""Problem 9: a mixture in which each source has its target share of the tokens.

Token shares of the sources are raised to exponents. Where targets are given, weights go as
target^a * natural^(1-a), and a, found by bisection, is the largest in [0, 1] at which no
source has to repeat its documents more often than it may within the budget (tokens, or a
multiple of all tokens there are). Without a budget the largest one is taken at which a = 1 is
feasible, so that weights are the targets. Where a target entropy is given instead, weights
are natural^x, with x bisected to that entropy; entropy "targets" is that of the target shares.

Weights are realised by budgeted block permutations: whole passes over a source's documents,
then a prefix of a permutation by hash, and one more document that fits the gap best. The prefix is found by sums over blocks of about
BLOCK documents and running sums inside blocks only, so a source with a third of all
documents is many tasks.

Defined results: sources without documents, or whose documents have no tokens, get share 0
and their target is spread over the others in proportion; documents with null text, null
source or a source without target aren't in the mixture; a null or non-positive target is 0,
a null max_repeats is 1; tables without rows give no rows; repeated rows of a doc_id are
separate documents.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.tokens import counted
from siltworks.session import ensure_checkpoint_dir

#: Documents in a block of a permutation, about; and the seed of the permutations.
BLOCK, SEED = 2_000, 17


def entropy(weights: Mapping[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def temper(natural: Mapping[str, float], target_entropy: float, steps: int = 60) -> tuple[dict[str, float], float]:
    """natural^x normalised, with x bisected so that the entropy is target_entropy (as near as x in [0, 8] allows)."""

    def at(x: float) -> dict[str, float]:
        top = max(natural.values())
        raw = {k: (v / top) ** x if v > 0 else 0.0 for k, v in natural.items()}
        total = sum(raw.values())
        return {k: v / total for k, v in raw.items()}

    low, high = 0.0, 8.0  # entropy falls as x grows
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(at(mid)) > target_entropy else (low, mid)
    return at(low), low


def weights(tokens: Mapping[str, int], targets: Mapping[str, float], repeats: Mapping[str, int], budget: float | None = None, steps: int = 60) -> tuple[dict[str, float], float, float]:
    """(weight of each source, exponent, budget in tokens)."""
    have = {k: n for k, n in tokens.items() if n > 0 and targets.get(k, 0) > 0 and repeats.get(k, 1) > 0}
    if not have:
        return {}, 1.0, 0.0
    total, aim = sum(have.values()), sum(targets[k] for k in have)

    def at(a: float) -> dict[str, float]:
        raw = {k: math.exp(a * math.log(targets[k] / aim) + (1 - a) * math.log(n / total)) for k, n in have.items()}
        norm = sum(raw.values())
        return {k: v / norm for k, v in raw.items()}

    most = lambda w: min(repeats.get(k, 1) * n / w[k] for k, n in have.items())
    if budget is None:
        return at(1.0), 1.0, most(at(1.0))
    budget = min(budget, max(most(at(0.0)), most(at(1.0))))
    if most(at(1.0)) >= budget:
        return at(1.0), 1.0, budget
    low, high = 0.0, 1.0
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if most(at(mid)) >= budget else (low, mid)
    return at(low), low, min(budget, most(at(low)))


def _plan(sizes: DataFrame, targets: DataFrame, budget: float | None, passes: float | None, evenness: float | str | None) -> tuple[list[tuple], float, float]:
    """Rows (source, target, max_repeats, tokens, docs, weight, quota, exponent) for the sources of the fixed table of targets."""
    aims = {r.source: (max(0.0, r.target_share or 0.0), 1 if r.max_repeats is None else max(0, r.max_repeats)) for r in targets.dropna(subset=["source"]).collect()}
    have = {r.source: (r.n_tokens, r.n_docs) for r in sizes.collect()}  # one row for each source of the targets
    tokens, shares_, repeats = {k: have.get(k, (0, 0))[0] for k in aims}, {k: v[0] for k, v in aims.items()}, {k: v[1] for k, v in aims.items()}
    if passes is not None:
        budget = passes * sum(tokens.values())
    if evenness is None:
        w, exponent, total = weights(tokens, shares_, repeats, budget)
    else:
        some = {k: n for k, n in tokens.items() if n > 0 and repeats[k] > 0}
        aim = entropy({k: v / (sum(shares_[k] for k in some) or 1.0) for k, v in shares_.items() if k in some}) if evenness == "targets" else float(evenness)
        w, exponent = temper(some, aim) if some else ({}, 1.0)
        most = min((repeats[k] * some[k] / v for k, v in w.items() if v > 0), default=0.0)
        total = most if budget is None else min(budget, most)
    rows = [(k, float(a), int(m), int(tokens[k]), int(have.get(k, (0, 0))[1]), float(w.get(k, 0.0)), float(w.get(k, 0.0) * total), float(exponent)) for k, (a, m) in sorted(aims.items())]
    return rows, exponent, total


_PLAN = "source string, target_share double, max_repeats int, source_tokens bigint, source_docs bigint, weight double, quota double, exponent double"


def mixture(documents: DataFrame, targets: DataFrame, budget: float | None = None, path: str | None = None, passes: float | None = None, evenness: float | str | None = None) -> DataFrame:
    """doc_id, source, n_tokens and copies of every document in the mixture."""
    return _realised(documents, targets, budget, path, passes, evenness)[0]


def _realised(documents: DataFrame, targets: DataFrame, budget: float | None, path: str | None, passes: float | None, evenness: float | str | None) -> tuple[DataFrame, DataFrame]:
    """The mixture, and its plan: a row for each source of the targets."""
    wanted = targets.select("source").dropna().distinct()  # a fixed table of tens of rows
    docs = documents.where("text is not null and source is not null").select("doc_id", "source", "text").join(F.broadcast(wanted), "source", "left_semi")
    docs = counted(docs, ["doc_id", "source"], "text", path).where("n_tokens > 0")
    ensure_checkpoint_dir(documents.sparkSession)
    docs = docs.checkpoint()  # ids and sizes only; counted once
    sizes = docs.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    rows, _, _ = _plan(sizes, targets, budget, passes, evenness)
    plan = documents.sparkSession.createDataFrame(rows, _PLAN)
    docs = docs.join(F.broadcast(plan.select("source", "source_tokens", "source_docs", "quota")), "source")
    docs = docs.withColumn("passes", F.floor(F.col("quota") / F.col("source_tokens") + 1e-9))
    docs = docs.withColumn("rest", F.greatest(F.lit(0.0), F.col("quota") - F.col("passes") * F.col("source_tokens")))
    docs = docs.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id", "source"))
    docs = docs.withColumn("block", F.pmod(F.shiftright("h", 20), F.greatest(F.lit(1), F.ceil(F.col("source_docs") / BLOCK))))
    ahead = docs.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"))
    ahead = ahead.select("source", "block", (F.sum("in_block").over(W.partitionBy("source").orderBy("block")) - F.col("in_block")).alias("before"))
    inside = W.partitionBy("source", "block").orderBy("h", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, 0)
    docs = docs.withColumn("upto", F.sum("n_tokens").over(inside)).join(ahead, ["source", "block"])
    docs = docs.withColumn("end", F.col("before") + F.col("upto")).withColumn("taken", F.col("end") <= F.col("rest"))
    docs = docs.select("doc_id", "source", "n_tokens", "h", "end", "passes", "rest", "taken").checkpoint()
    # one more document of each source, the one whose size is nearest to what the prefix leaves open
    left = docs.groupBy(F.col("source").alias("s")).agg((F.max("rest") - F.coalesce(F.sum(F.when(F.col("taken"), F.col("n_tokens"))), F.lit(0))).alias("open"))
    miss = F.abs(F.col("n_tokens") - F.col("open"))
    last = docs.where("not taken").join(F.broadcast(left), F.col("source") == F.col("s")).where(miss < F.col("open"))
    last = last.groupBy("s").agg(F.min(F.struct(miss.alias("miss"), "h", "end")).alias("m")).select("s", F.col("m.h").alias("mh"), F.col("m.end").alias("mend"))
    docs = docs.join(F.broadcast(last), (F.col("source") == F.col("s")) & (F.col("h") == F.col("mh")) & (F.col("end") == F.col("mend")), "left")
    copies = F.col("passes") + F.when(F.col("taken") | F.col("s").isNotNull(), 1).otherwise(0)
    return docs.select("doc_id", "source", "n_tokens", copies.cast("int").alias("copies")).where("copies > 0"), plan


def shares(documents: DataFrame, targets: DataFrame, budget: float | None = None, path: str | None = None, passes: float | None = None, evenness: float | str | None = None) -> DataFrame:
    """Each source's target share and planned weight beside the share of tokens that the mixture has, how often its documents occur, and the exponent."""
    mix, plan = _realised(documents, targets, budget, path, passes, evenness)
    got = mix.groupBy(F.col("source").alias("s")).agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("n_docs"), F.max("copies").alias("most_copies"))
    t = plan.select("source", "target_share", "max_repeats", "weight", "exponent").join(got, F.col("source") == F.col("s"), "left")
    t = t.withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    share = F.col("tokens") / F.greatest(F.lit(1), F.sum("tokens").over(W.partitionBy()))
    return t.select(
        "source", "target_share", "max_repeats", "weight", "exponent", "tokens", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        share.alias("actual_share"), (share - F.col("target_share")).alias("gap"))
