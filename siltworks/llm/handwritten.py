"""Problem 4: generated, minified, vendored and blob files, by belief propagation over directory trees.

Each file is a leaf with one of five labels; its factor says how likely its content and name
are under each label. A third-party file looks like a hand-written one, so that mostly the
place decides: each directory is a variable with the same labels and one more, a store of
third-party copies, which only directories with such a name in their path can be and then
are. Compatibilities tie files to their directory and directories to their parent; a
hand-written parent speaks for hand-written children, a store for third-party ones, and
siblings with marks of a tool for a file whose name alone hints at one. The graph of a
repository is a tree, so one upward and one downward sweep are exact. A sweep is one
aggregation and one join for each depth, over directories only: messages are sums of
logarithms, summed map-side before they are shuffled, so a repository with a third of all
files is not a hot task. Directories below LEVELS count as their ancestor of that level, which
bounds the number of sweeps whatever paths there are.

Defined results: null or empty content gives a flat factor (the path still counts); a null
path is the root directory; a null repo_name is a repository of its own for each file;
redelivered rows count once; the flags is_vendor and is_generated are weak evidence.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches, leading_comment
from siltworks.session import ensure_checkpoint_dir

LABELS = ("handwritten", "generated", "minified", "vendored", "blob")

#: Labels of directories, and the depth below which they aren't told apart.
PLACES = (*LABELS, "store")
LEVELS = 16
#: Compatibility of a file's label (columns) with its directory's (rows).
FILE_IN = (
    (0.80, 0.05, 0.05, 0.05, 0.05),
    (0.15, 0.75, 0.03, 0.04, 0.03),
    (0.15, 0.03, 0.75, 0.04, 0.03),
    (0.40, 0.03, 0.04, 0.50, 0.03),
    (0.20, 0.04, 0.03, 0.03, 0.70),
    (0.01, 0.01, 0.01, 0.96, 0.01),
)
#: Compatibility of a directory's label (columns) with its parent's (rows), and the prior of a repository's top directory.
DIR_IN = (
    (0.80, 0.04, 0.04, 0.06, 0.04, 0.02),
    (0.36, 0.54, 0.02, 0.04, 0.02, 0.02),
    (0.36, 0.02, 0.54, 0.04, 0.02, 0.02),
    (0.36, 0.02, 0.04, 0.54, 0.02, 0.02),
    (0.36, 0.02, 0.02, 0.04, 0.54, 0.02),
    (0.02, 0.02, 0.02, 0.02, 0.02, 0.90),
)
TOP = (0.90, 0.02, 0.02, 0.03, 0.02, 0.01)
#: Log-likelihood of a file without any mark under each label: tools leave marks, third-party copies hardly.
UNMARKED = (0.0, -2.5, -2.5, -0.7, -2.5)
#: Log-factor of what can't be.
NEVER = -1e9

_VENDOR_DIRS = frozenset(
    "node_modules bower_components jspm_packages vendor vendors third_party third-party thirdparty 3rdparty 3rd_party 3rd-party external externals extern deps contrib site-packages".split()
)
_LOCKS = frozenset(
    "package-lock.json npm-shrinkwrap.json yarn.lock pnpm-lock.yaml poetry.lock pipfile.lock cargo.lock gemfile.lock composer.lock go.sum flake.lock packages.lock.json podfile.lock mix.lock pubspec.lock uv.lock".split()
)
_LICENSE = re.compile(r"(?:licen[sc]e|copying|notice)[^/]*\Z", re.I)
_GEN_PATH = re.compile(r"(?:\.pb\.(?:go|cc|h)|_pb2(?:_grpc)?\.pyi?|\.g\.(?:cs|dart)|[._\-]gen(?:erated)?\.\w+|\.designer\.cs)\Z", re.I)
_MIN_PATH = re.compile(r"(?:[.\-]min\.(?:js|css|mjs)|\.bundle\.(?:js|css)|\.pack\.js|-[0-9a-f]{8,}\.(?:js|css))\Z", re.I)
_GEN_SAYS = re.compile(
    r"code generated (?:by|from)|@generated\b|<auto-?generated\b|auto-?generated\b|automatically generated|machine[- ](?:output|generated)|"
    r"\bdo not (?:edit|modify|change)\b|generated by \S+ (?:from|using|v?\d)|\b(?:produced|emitted|written) by \S+ v?\d[\w.]* from|changes will be (?:over|lost)|manual changes (?:are|will be) lost|"
    r"\b(?:produit|généré)e?s? (?:automatiquement )?par\b|ne pas (?:modifier|éditer)|\berzeugt (?:von|durch|mit)\b|\bgeneriert (?:von|durch|mit)\b|nicht von hand|nicht (?:bearbeiten|ändern|editieren)\b|"
    r"\b(?:generado|producido) (?:automáticamente )?por\b|no (?:editar|modificar)\b|\b(?:gerado|produzido) (?:automaticamente )?por\b|não (?:editar|edite|modificar|modifique|altere)\b|"
    r"\b(?:generato|prodotto) (?:automaticamente )?da\b|non modificare|\bgegenereerd (?:door|met)\b|niet (?:bewerken|wijzigen|aanpassen)\b|\bwygenerowan[eoy]\b|nie (?:edytować|edytuj|modyfikować|zmieniać)\b|"
    r"сгенерирован|создано автоматически|не (?:редактировать|изменять|править)|自動生成|自动生成|編集しないで|请勿(?:编辑|修改)|不要(?:编辑|修改)",
    re.I,
)
_GEN_TALK = re.compile(r"\bwrites?\b|\bemits?\b|\bprints?\b|\binto each\b|\bchecks?\b|\blooks? for\b|\bunless\b|\bwhen(?:ever)?\b|\bif\b", re.I)
_VEN_SAYS = re.compile(
    r"copied (?:unchanged |verbatim |as is )?from \S+.{0,20}?v?\d+\.\d+|vendored (?:snapshot|copy)|report bugs upstream|\bupstream: *https?://|"
    r"^!? *[\w.\-]+ v?\d+\.\d+(?:\.\d+)? *[|–-] *(?:upstream|https?://|\(c\)|copyright)",
    re.I,
)
_BANNER = re.compile(r"\A/\*!.{3,200}?\*/", re.S)
_NUMBERS = re.compile(r"[\s,\[\](){}]*(?:(?:0x[0-9a-f]+|-?\d+(?:\.\d+)?(?:e[+\-]?\d+)?)[\s,\[\](){};]*){4,}\Z", re.I)
_BASE64 = re.compile(r"[A-Za-z0-9+/]{60,}={0,2}")
_DATA_URI = re.compile(r"data:[\w.+\-]+/[\w.+\-]+;base64,[A-Za-z0-9+/=]{80,}")
_INSERT = re.compile(r"\s*insert into \S+ (?:\([^)]*\) )?values", re.I)
_TABLE = re.compile(r"\b(?:yy\w*|\w*_?(?:trans|accept|check|defact|table))\s*\[\w*\]\s*=\s*\{")
_CODE_EXT = frozenset("js mjs cjs ts jsx tsx css py rb php go rs c h cc cpp hpp cs java kt scala swift sh sql pl lua".split())


def evidence(path: str | None, text: str | None, is_vendor: bool | None, is_generated: bool | None) -> list[float]:
    """Log-likelihoods of a file's content and name under the five labels; its directories are the tree's matter."""
    w = dict(zip(LABELS, UNMARKED))
    if is_generated:
        w["generated"] += 0.3
    if is_vendor:
        w["vendored"] += 0.3
    path = path or ""
    parts = path.lower().split("/")
    base = parts[-1]
    ext = base.rsplit(".", 1)[-1] if "." in base else ""
    if _LICENSE.match(base):
        w["handwritten"] += 12
        return [w[k] for k in LABELS]
    if base in _LOCKS or base.endswith((".js.map", ".css.map", ".mjs.map")):
        w["generated"] += 9
    if _GEN_PATH.search(base):
        w["generated"] += 1.5
    if _MIN_PATH.search(base):
        w["minified"] += 1.5
    if not text or not text.strip():
        return [w[k] for k in LABELS]
    head = leading_comment(text)
    for line in head:
        if _GEN_SAYS.search(line) and not _GEN_TALK.search(line):
            w["generated"] += 7
        if _VEN_SAYS.search(line):
            w["vendored"] += 7
    size = len(text)
    lines = text.splitlines()
    body = [x for x in lines if x.strip()]
    if ext in ("js", "mjs", "cjs", "css", "ts"):
        # minified: nearly all of the text in long lines, with few blanks around its punctuation
        long = sum(len(x) for x in body if len(x) > 250)
        if long > 0.8 * size or (long > 0.4 * size and len(body) <= 4):
            tight = sum(len(x) - len(x.replace(" ", "")) for x in body if len(x) > 250) / max(1, long)
            joints = sum(text.count(s) for s in (";", "{", "}", "(", ",", ":")) / size
            if tight < 0.14 and joints > 0.08 and not _DATA_URI.search(text):
                w["minified"] += 7
        if _BANNER.match(text) and long > 0.4 * size:
            w["minified"] += 2
    if text.lstrip().startswith('{"version":3') and '"mappings"' in text:
        w["generated"] += 9
    if ext in _CODE_EXT:
        packed = sum(len(m[0]) for m in _BASE64.finditer(text))
        if packed > 0.7 * size and size > 400:
            w["blob"] += 8
        rows = sum(1 for x in body if _NUMBERS.match(x))
        if rows >= 12 and rows > 0.8 * len(body):
            w["generated" if _TABLE.search(text) else "blob"] += 8
        if ext == "sql":
            rows = sum(1 for x in body if _INSERT.match(x))
            if rows >= 20 and rows > 0.8 * len(body):
                w["blob"] += 8
    return [w[k] for k in LABELS]


def place(path: str | None) -> tuple[str, bool]:
    """(directory of the tree, whether it is a store of third-party copies) of a file."""
    parts = (path or "").split("/")[:-1]
    store = [k for k, p in enumerate(parts) if p.lower() in _VENDOR_DIRS]
    if len(parts) > LEVELS:  # a store below the last level keeps a directory of its own
        parts = parts[:LEVELS] + ([parts[store[0]]] if store and store[0] >= LEVELS else [])
    return "/".join(parts), bool(store)


def _leaves():
    def fn(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("blob_id", "repo", "dir", "log_factor", "sent")}
        for blob, repo, path, v, g, text in zip(c["blob_id"], c["repo_name"], c["path"], c["is_vendor"], c["is_generated"], c["content"]):
            out["blob_id"].append(blob)
            out["repo"].append(f"r:{repo}" if repo is not None else f"b:{blob}")
            out["dir"].append(place(path)[0])
            own = evidence(path, text, v, g)
            out["log_factor"].append(own)
            mass = [math.exp(x) for x in own]
            out["sent"].append([math.log(sum(m * x for m, x in zip(row, mass))) for row in FILE_IN])
        return out

    return fn


def _message(df: DataFrame, logs: str, matrix: tuple[tuple[float, ...], ...], out: str) -> DataFrame:
    """df with a column of the logs of the sums that a vector of logs has with the rows of a matrix.

    Plain arithmetic in steps, so that it is compiled, and plans stay small.
    """
    x = [F.col(logs)[j] for j in range(len(matrix[0]))]
    df = df.withColumn("_top", F.greatest(*x)).withColumns({f"_m{j}": F.exp(v - F.col("_top")) for j, v in enumerate(x)})
    sums = [reduce(lambda a, b: a + b, [F.lit(w) * F.col(f"_m{j}") for j, w in enumerate(row)]) for row in matrix]
    return df.withColumn(out, F.array(*map(F.log, sums))).drop("_top", *[f"_m{j}" for j in range(len(x))])


def _turned(matrix: tuple[tuple[float, ...], ...]) -> tuple[tuple[float, ...], ...]:
    return tuple(zip(*matrix))


def _plus(a: Column, b: Column, sign: int = 1, n: int = len(PLACES)) -> Column:
    return F.array(*[a[k] + sign * b[k] for k in range(n)])


def _summed(c: str) -> Column:
    """Element-wise sum of an array of logs, so that it is summed map-side."""
    return F.array(*[F.sum(F.col(c)[k]) for k in range(len(PLACES))])


def classify(raw: DataFrame) -> DataFrame:
    """blob_id, repo, label and belief of each file (one row for each blob_id and repository), and alone, the label of its own factor."""
    ensure_checkpoint_dir(raw.sparkSession)
    lits = lambda v: F.array(*[F.lit(float(x)) for x in v])
    flat = lits([0] * len(PLACES))
    leaf = batches(
        raw.select("blob_id", "repo_name", "path", "is_vendor", "is_generated", "content"),
        _leaves,
        "blob_id string, repo string, dir string, log_factor array<double>, sent array<double>",
    ).where("blob_id is not null")
    # Redeliveries share content and path; only the flags may differ, and the larger factor is kept.
    leaf = leaf.groupBy("blob_id", "repo").agg(F.max(F.struct("log_factor", "dir", "sent")).alias("m")).select("blob_id", "repo", "m.dir", "m.log_factor", "m.sent").checkpoint()
    own = leaf.groupBy("repo", "dir").agg(_summed("sent").alias("own"))
    # Every directory with its ancestors; depth 0 is the root.
    steps = F.split("dir", "/")
    chain = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))))
    named = F.exists(F.split(F.lower("node"), "/"), lambda p: p.isin(*sorted(_VENDOR_DIRS)))
    prior = F.when(F.col("node") == "", lits(map(math.log, TOP))).otherwise(flat)
    dirs = (
        own.select("repo", F.explode(chain).alias("node"), "dir", "own")
        .groupBy("repo", "node").agg(F.max(F.when(F.col("node") == F.col("dir"), F.col("own"))).alias("own"))
        .select(
            "repo", "node", _plus(_plus(F.coalesce("own", flat), prior), F.when(named, lits([NEVER] * len(LABELS) + [0])).otherwise(lits([0] * len(LABELS) + [NEVER]))).alias("own"),
            F.when(F.col("node") == "", 0).otherwise(F.size(F.split("node", "/"))).alias("depth"),
            F.when(F.col("node").contains("/"), F.regexp_replace("node", r"/[^/]*\z", "")).otherwise("").alias("parent"),
        ).checkpoint()
    )
    depth = dirs.agg(F.max("depth")).first()[0] or 0  # at most LEVELS + 1
    # Upward: a directory hears from its files and its subdirectories.
    level = _message(dirs.where(F.col("depth") == depth).withColumn("up", F.col("own")), "up", DIR_IN, "sent")
    levels = [level]
    for d in range(depth - 1, -1, -1):
        got = level.groupBy("repo", F.col("parent").alias("node")).agg(_summed("sent").alias("below"))
        level = dirs.where(F.col("depth") == d).join(got, ["repo", "node"], "left")
        level = level.withColumn("up", _plus(F.col("own"), F.coalesce("below", flat))).drop("below")
        level = _message(level, "up", DIR_IN, "sent").checkpoint()
        levels.append(level)
    # Downward: a directory hears from its parent, without what it said itself.
    belief = levels[-1].select("repo", "node", F.col("up").alias("belief"))
    parts = [belief]
    for level in reversed(levels[:-1]):
        above = belief.select("repo", F.col("node").alias("parent"), F.col("belief").alias("above"))
        belief = level.join(above, ["repo", "parent"]).withColumn("rest", _plus(F.col("above"), F.col("sent"), -1))
        belief = _message(belief, "rest", _turned(DIR_IN), "heard")
        belief = belief.select("repo", "node", _plus(F.col("up"), F.col("heard")).alias("belief")).checkpoint()
        parts.append(belief)
    beliefs = parts[0]
    for p in parts[1:]:
        beliefs = beliefs.unionByName(p)
    files = leaf.join(beliefs.withColumnRenamed("node", "dir"), ["repo", "dir"])
    files = files.withColumn("rest", _plus(F.col("belief"), F.col("sent"), -1))
    files = _message(files, "rest", _turned(FILE_IN), "heard")
    files = files.select("blob_id", "repo", "log_factor", _plus(F.col("log_factor"), F.col("heard"), n=len(LABELS)).alias("final"))
    best = lambda c: F.element_at(F.array(*map(F.lit, LABELS)), F.array_position(c, F.array_max(c)).cast("int"))
    norm = reduce(lambda a, b: a + b, [F.exp(F.col("final")[k] - F.array_max("final")) for k in range(len(LABELS))])
    return files.select("blob_id", "repo", best("final").alias("label"), (F.lit(1.0) / norm).alias("belief"), best("log_factor").alias("alone"))


def found(raw: DataFrame) -> DataFrame:
    """p4_found: files that are not hand-written source."""
    return classify(raw).where(F.col("label") != "handwritten").select("blob_id").distinct()
