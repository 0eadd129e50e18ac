"""Problem 3: the license of each file and repository, by a Bayesian network over its evidence.

The network has one hidden variable for each file, the license that applies (the known
licenses and "none"), one for each piece of evidence, whether it is reliable, and observed
children: every notice in the file's leading comment, the licenses its repository's license
files offer, what a scanner detected, and what manifests and the readme in the repository's
top directory say. Reliabilities have a prior for each kind of evidence. A reliable statement
names the license that applies; an unreliable one names any. The posterior is exact, since
the hidden license has as many states as there are known licenses and the rest factors.

Two firm statements (notices, or a notice and the offer) contradict each other when the
posterior that both are reliable is below a half; a file's contradiction is the largest of
its pairs, and a conflict one above a half. A file is unknown when, of notices, offer and
scanner alone, the posterior of "none" is not below that of all licenses together: manifests
and readme help to tell which license applies, but don't make a file known by themselves.

Defined results: null or empty content has no notice; a null repo_name gets no offers and
no row of its own; redelivered rows count once; a table without rows gives no rows.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches, leading_comment

NONE = "none"

#: How likely a statement of each kind names the license that applies.
RELIABILITY = {"notice": 0.98, "file": 0.95, "scanner": 0.70, "manifest": 0.85, "readme": 0.75}
#: A posterior below this is of low confidence.
CONFIDENT = 0.6

#: Prior of "none"; the known licenses share the rest.
PRIOR_NONE = 0.6

_CUE = re.compile(
    r"licen[sc]|lizenz|лиценз|ライセンス|许可|许可证|\bterms\b|spdx|governed by|offered under|released under|you may choose|public domain|you can redistribute",
    re.I,
)
_DENIED = re.compile(r"\b(?:not|never|no longer|formerly|unlike|instead of|compatible with|relicens\w+ from)\b[^.;]{0,40}$", re.I)
_LICENSE_FILE = re.compile(r"(?:licen[sc]e|copying)[^/]*\Z", re.I | re.S)

#: Manifests in a repository's top directory, by name: where they state the license.
_MANIFEST = re.compile(r"(?:package|composer|bower)\.json\Z|(?:cargo|pyproject)\.toml\Z|setup\.(?:cfg|py)\Z|pom\.xml\Z|[^/]+\.(?:gemspec|nuspec|cabal)\Z", re.I)
_MANIFEST_LINE = re.compile(r"\blicen[sc]es?\b|<name>", re.I)
_README = re.compile(r"readme(?:\.[^/]*)?\Z", re.I)

_V = r"[\s,\-_]*(?:v(?:ersion)?\.?\s*)?"
_LATER = r"(?:\s*\+|[\s,\-]*(?:or|and|oder|ou)[\s\-]+(?:\(?at your option\)?[\s,]*)?(?:any\s+)?(?:later|newer)(?:\s+(?:version|one))?)"
_ONLY = r"(?:[\s,\-]*(?:only|and no other))?"
#: Wordings of known licenses, longest families first; a wording that also matches an earlier one is not read twice.
WORDINGS = [
    ("AGPL-3.0-only", rf"(?:(?:GNU )?Affero (?:GPL|General Public License)|AGPL){_V}3(?:\.0)?(?!\.\d){_ONLY}(?!{_LATER})"),
    ("LGPL-2.1-or-later", rf"(?:(?:GNU )?Lesser (?:GPL|General Public License)|LGPL){_V}2\.1{_LATER}"),
    ("GPL-3.0-or-later", rf"(?<![AL])(?:GNU General Public License|GNU GPL|GPL){_V}3(?:\.0)?{_LATER}"),
    ("GPL-2.0-only", rf"(?<![AL])(?:GNU General Public License|GNU GPL|GPL){_V}2(?:\.0)?(?!\.\d){_ONLY}(?!{_LATER})"),
    ("MPL-2.0", rf"(?:Mozilla Public License|MPL){_V}2(?:\.0)?"),
    ("EPL-2.0", rf"(?:Eclipse Public License|EPL){_V}2(?:\.0)?"),
    ("Apache-2.0", rf"(?:Apache(?: Software)?(?: License| licence)?|ASL){_V}2(?:\.0)?|version 2(?:\.0)? of the Apache(?: Software)? licen[sc]e"),
    ("BSD-3-Clause", r"(?:BSD[\s\-]+(?:3|three)[\s\-]+clauses?|(?:3|three)[\s\-]+clause[\s\-]+BSD|(?:New|Modified|Revised) BSD|BSD licen[sc]e with (?:three|3) clauses)"),
    ("BSD-2-Clause", r"(?:BSD[\s\-]+(?:2|two)[\s\-]+clauses?|(?:2|two)[\s\-]+clause[\s\-]+BSD|Simplified BSD|FreeBSD licen[sc]e|BSD licen[sc]e with (?:two|2) clauses)"),
    ("Unlicense", r"(?:The )?Unlicense\b"),
    ("ISC", r"\bISC\b"),
    ("MIT", r"\bMIT\b|\bExpat\b"),
]
_WORDS = re.compile("|".join(f"(?P<l{i}>{p})" for i, (_, p) in enumerate(WORDINGS)), re.I)


class Names:
    """Finds licenses by the spellings of a table and by other wordings of the same licenses."""

    def __init__(self, spellings: list[tuple[str, str]]) -> None:
        self.by = {s.strip().lower(): i for s, i in spellings if s and i}
        self.ids = sorted(set(self.by.values()))
        known = sorted(self.by, key=len, reverse=True)
        self.spelled = re.compile(r"(?<![\w.+\-])(?:" + "|".join(map(re.escape, known)) + r")(?![\w+]|[.\-]\w)", re.I) if known else None

    def exact(self, text: str | None) -> str | None:
        return self.by.get(text.strip().lower()) if text else None

    def found(self, text: str) -> list[tuple[int, str]]:
        """(place, id) of each license named in text, in order; overlapping readings give the longest."""
        spans = [(m.start(), m.end(), WORDINGS[int(m.lastgroup[1:])][0]) for m in _WORDS.finditer(text)]
        if self.spelled:
            spans += [(m.start(), m.end(), self.by[m[0].lower()]) for m in self.spelled.finditer(text)]
        out: list[tuple[int, int, str]] = []
        for s in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if s[2] in self.ids and all(s[1] <= o[0] or s[0] >= o[1] for o in out):
                out.append(s)
        return [(a, i) for a, _, i in sorted(out)]

    def statement(self, line: str) -> list[str]:
        """Licenses a line states as a choice; empty if it is no statement of a license."""
        if not _CUE.search(line):
            return []
        return sorted({i for a, i in self.found(line) if not _DENIED.search(line[:a])})

    def file_names(self, text: str) -> list[str]:
        """Licenses that a license file names, in any of its lines."""
        return sorted({i for line in re.split(r"[\r\n]+", text) for a, i in self.found(line) if not _DENIED.search(line[:a])})


Evidence = tuple[str, frozenset[str]]


def beliefs(ids: list[str], evidence: list[Evidence]) -> dict[str, float]:
    """Posterior of each known license and of "none", given pieces of evidence (kind, licenses named)."""
    size = max(1, len(ids))
    raw = {}
    for i in (NONE, *ids):
        p = PRIOR_NONE if i == NONE else (1 - PRIOR_NONE) / size
        for kind, named in evidence:
            r = RELIABILITY[kind]
            p *= (1 - r) / size + (r / len(named) if i in named else 0.0)
        raw[i] = p
    total = sum(raw.values())
    return {i: p / total for i, p in raw.items()}


def contradiction(ids: list[str], a: Evidence, b: Evidence) -> float:
    """Posterior that at least one of two statements is unreliable."""
    size = max(1, len(ids))
    both = every = 0.0
    for i in (NONE, *ids):
        p = PRIOR_NONE if i == NONE else (1 - PRIOR_NONE) / size
        true = [RELIABILITY[k] / len(named) if i in named else 0.0 for k, named in (a, b)]
        false = [(1 - RELIABILITY[k]) / size for k, _ in (a, b)]
        both += p * true[0] * true[1]
        every += p * (true[0] + false[0]) * (true[1] + false[1])
    return 1 - both / every


class Verdict(NamedTuple):
    """The license that applies, its posterior, the largest contradiction, and whether no license is known."""

    license: str
    posterior: float
    contradiction: float
    unknown: bool


def posterior(ids: list[str], notices: list[list[str]], offers: list[str], scanned: list[str], manifest: list[str] = (), readme: list[str] = ()) -> Verdict:
    """What the network says of one file, exactly."""
    firm: list[Evidence] = [("notice", frozenset(n)) for n in notices] + ([("file", frozenset(offers))] if offers else [])
    stated = firm + ([("scanner", frozenset(scanned))] if scanned else [])
    more: list[Evidence] = [(k, frozenset(v)) for k, v in (("manifest", manifest), ("readme", readme)) if v]
    # unknown or not is decided first: a statement of several licenses divides among them, but speaks against "none" as a whole
    unknown = 2 * beliefs(ids, stated)[NONE] >= 1
    every = beliefs(ids, stated + more)
    best = NONE if 2 * every[NONE] >= 1 else max(sorted(ids), key=lambda i: every[i])
    clash = max((contradiction(ids, x, y) for k, x in enumerate(firm) for y in firm[k + 1:]), default=0.0)
    return Verdict(best, every[best], clash, unknown)


def _evidence(spellings: list[tuple[str, str]]):
    def make():
        names = Names(spellings)

        def fn(c: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("blob_id", "repo_name", "notices", "scanned", "says", "named")}
            for blob, repo, path, found, text in zip(c["blob_id"], c["repo_name"], c["path"], c["detected_licenses"], c["content"]):
                text, path = text or "", path or ""
                says, named = None, []
                if _LICENSE_FILE.match(path):
                    says, named = "file", names.file_names(text)
                    notices = [named] if named else []
                else:
                    notices = [n for n in map(names.statement, leading_comment(text)) if n]
                    if "/" not in path and _MANIFEST.match(path):
                        says, named = "manifest", sorted({i for line in text.split("\n") if _MANIFEST_LINE.search(line) for _, i in names.found(line)})
                    elif "/" not in path and _README.match(path):
                        says, named = "readme", sorted({i for line in text.split("\n") for i in names.statement(line)})
                out["blob_id"].append(blob)
                out["repo_name"].append(repo)
                out["notices"].append(notices)
                out["scanned"].append(sorted({i for d in found or [] if (i := names.exact(d))}))
                out["says"].append(says if named else None)
                out["named"].append(named)
            return out

        return fn

    return make


def _fuse(ids: list[str]):
    def make():
        seen: dict = {}

        def fn(c: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("blob_id", "repo_name", "license", "posterior", "contradiction", "confident", "conflict", "unknown")}
            for blob, repo, notices, scanned, *repos in zip(*[c[k] for k in ("blob_id", "repo_name", "notices", "scanned", "file", "manifest", "readme")]):
                key = (tuple(sorted(map(tuple, notices or []))), tuple(scanned or []), *(tuple(r or []) for r in repos))
                v = seen.get(key)
                if v is None:
                    if len(seen) > 50_000:
                        seen.clear()
                    # the same statement more than once says no more than once
                    seen[key] = v = posterior(ids, [list(n) for n in dict.fromkeys(key[0])], list(key[2]), list(key[1]), list(key[3]), list(key[4]))
                for k, x in (("blob_id", blob), ("repo_name", repo), ("license", v.license), ("posterior", v.posterior), ("contradiction", v.contradiction), ("confident", v.posterior >= CONFIDENT), ("conflict", v.contradiction > 0.5), ("unknown", v.unknown)):
                    out[k].append(x)
            return out

        return fn

    return make


def known_names(names: DataFrame) -> list[tuple[str, str]]:
    """Spellings of the fixed table of licenses (tens of rows)."""
    return sorted((r.spelling, r.spdx_id) for r in names.select("spelling", "spdx_id").dropna().collect())


#: A repository's evidence meets its files in so many parts, as one repository may have a third of them.
PARTS = 16


def file_licenses(raw: DataFrame, names: DataFrame) -> DataFrame:
    """blob_id, repo_name, license, posterior, contradiction, confident, conflict and unknown of each file.

    One Python pass reads whole contents and leaves only short sets; what a repository's license
    files, manifests and readme name (at most as many ids as licenses are known) is aggregated
    before it meets its files. Redelivered files are one: what scanners said of them is united.
    """
    spelled = known_names(names)
    ids = sorted({i for _, i in spelled})
    ev = batches(
        raw.select("blob_id", "repo_name", "path", "detected_licenses", "content"),
        _evidence(spelled),
        "blob_id string, repo_name string, notices array<array<string>>, scanned array<string>, says string, named array<string>",
    )
    united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    ev = ev.where("blob_id is not null").groupBy("blob_id", "repo_name").agg(F.max("notices").alias("notices"), united("scanned").alias("scanned"), F.max(F.struct("says", "named")).alias("own"))
    offers = (
        ev.where("own.says is not null and repo_name is not null")
        .select(F.col("repo_name").alias("offer_repo"), F.col("own.says").alias("says"), F.explode("own.named").alias("id"))
        .groupBy("offer_repo").agg(*[F.array_sort(F.collect_set(F.when(F.col("says") == k, F.col("id")))).alias(k) for k in ("file", "manifest", "readme")])
        .withColumn("offer_part", F.explode(F.array(*map(F.lit, range(PARTS)))))
    )
    ev = ev.withColumn("part", F.pmod(F.xxhash64("blob_id"), F.lit(PARTS)).cast("int"))
    joined = ev.join(offers, (ev.repo_name == offers.offer_repo) & (ev.part == offers.offer_part), "left")
    return batches(
        joined.select("blob_id", "repo_name", "notices", "scanned", "file", "manifest", "readme"),
        _fuse(ids),
        "blob_id string, repo_name string, license string, posterior double, contradiction double, confident boolean, conflict boolean, unknown boolean",
    )


def repo_licenses(files: DataFrame) -> DataFrame:
    """One row for each repository: flags over its files and the license of most of them."""
    counts = files.where("repo_name is not null").groupBy("repo_name", "license").agg(
        F.count("*").alias("n"), F.sum("posterior").alias("weight"), F.max("conflict").alias("conflict"), F.min("unknown").alias("unknown"))
    return counts.groupBy("repo_name").agg(
        F.sum("n").alias("n_files"),
        F.max_by("license", F.struct("weight", "license")).alias("license"),
        F.max("conflict").alias("conflict"),
        F.min("unknown").alias("unknown"),
    )


def findings(raw: DataFrame, names: DataFrame) -> DataFrame:
    """p3_found: subject and finding (conflict or unknown) of files and repositories."""
    files = file_licenses(raw, names)
    finding = lambda: F.when(F.col("conflict"), "conflict").when(F.col("unknown"), "unknown")
    by_file = files.groupBy("repo_name", "blob_id").agg(F.max("conflict").alias("conflict"), F.min("unknown").alias("unknown"))
    per = by_file.select("repo_name", F.explode(F.array(
        F.struct(F.lit("f").alias("kind"), F.col("blob_id").alias("subject"), "conflict", "unknown"),
        F.struct(F.lit("r").alias("kind"), F.col("repo_name").alias("subject"), "conflict", "unknown"),
    )).alias("s")).select("s.*").where("subject is not null")
    return (
        per.groupBy("kind", "subject").agg(F.max("conflict").alias("conflict"), F.min("unknown").alias("unknown"))
        .select("subject", finding().alias("finding")).where("finding is not null").distinct()
    )
