import hashlib
import posixpath

import pytest
from pyspark.sql import functions as F

from siltworks.functions import code, text

STRINGS = ["", "a", "a\n", "a\r\nb", "a\rb\n\n", "x y\x85z\x0bq", "\x00nul", "emoji 😀 é", " \t\u3000pad\xa0", "tab\tend", "ß" * 300, "a\x1cb\x1d"]


@pytest.fixture(scope="module")
def measured(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(STRINGS)], "i int, c string")
    parts = text.lines(F.col("c"))
    cols = dict(
        n=F.size(parts), longest=text.longest(parts), total=text.total_length(parts), stripped=text.stripped_length(F.col("c")), sha=text.sha256(F.col("c")), tokens=text.token_estimate(F.col("c")),
        odd=text.odd_characters(F.col("c")), git=text.git_blob_sha1(F.col("c")), ident=text.record_id(F.lit(None).cast("string"), F.lit("p"), text.sha256(F.col("c"))),
    )
    return {r.i: r for r in df.select("i", *[v.alias(k) for k, v in cols.items()]).collect()}


def test_measures_agree_with_python(measured):
    for i, s in enumerate(STRINGS):
        r, lines = measured[i], s.splitlines() or [""]
        raw = s.encode()
        sha = hashlib.sha256(raw).hexdigest()
        assert (r.n, r.longest, r.total) == (len(lines), max(map(len, lines)), sum(map(len, lines))), repr(s)
        assert r.stripped == len(s.strip()), repr(s)
        assert r.sha == sha and r.tokens == (max(1, len(raw) // 4) if raw else 0)
        assert r.git == hashlib.sha1(b"blob %d\0" % len(raw) + raw).hexdigest()
        assert r.ident == hashlib.sha256(b"\0p\0" + sha.encode()).hexdigest()[:32]
        assert r.odd == sum(not (c.isalnum() or c == "_" or c in "(){}[];:=<>+-*/.,'\"# \n\t") for c in s), repr(s)


def test_paths_agree_with_posixpath(rows):
    paths = ["a/b.py", ".env", "x/.env", "noext", "a/b.tar.gz", "dir/", "a..b", ".a.b", "a/b.PY"]
    df = rows("p string", [(p,) for p in paths]).select("p", text.basename(F.col("p")).alias("b"), text.stem(F.col("p")).alias("s"), text.extension(F.col("p")).alias("e"))
    for r in df.collect():
        stem, ext = posixpath.splitext(posixpath.basename(r.p))
        assert r.b == posixpath.basename(r.p)
        assert (r.s, r.e) == (stem, ext), r.p


def test_languages_layers_and_technologies(rows):
    data = [
        ("src/app.py", None, "import flask\n", "Python", "backend", ["flask"]),
        ("Dockerfile.dev", None, "FROM x", "Dockerfile", "infrastructure", ["docker"]),
        ("tests/test_a.py", "Python", "", "Python", "testing", []),
        ("k.yaml", None, "apiVersion: v1\nkind: Pod\n", "YAML", "infrastructure", ["kubernetes"]),
        ("db/migrate/1.sql", None, "select 1", "SQL", "database", []),
        ("package.json", None, "{}", "JSON", "configuration", ["nodejs"]),
        ("README.md", None, "x", "Markdown", "docs", []),
        ("x.vue", None, "import y from 'vue'", "Vue", "frontend", ["vue"]),
        (None, None, None, None, "other", []),
        (".github/workflows/ci.yml", None, "", "YAML", "infrastructure", ["ci_cd"]),
    ]
    df = rows("p string, d string, c string, l string, y string, t array<string>", data)
    lang = code.language(F.col("p"), F.col("d"))
    for r in df.select("*", lang.alias("l2"), code.layer(F.col("p"), lang, F.col("c")).alias("y2"), code.technologies(F.col("p"), F.col("c")).alias("t2")).collect():
        assert (r.l2, r.y2, r.t2) == (r.l, r.y, r.t), r.p


def test_detector_survives_thousands_of_line_ends(rows):
    df = rows("c string", [("apiVersion: v1\n" + "\n" * 3900,), ("server {\n" + "\n" * 3900 + " listen 80;",)])
    assert [r.t for r in df.select(code.technologies(F.lit(None).cast("string"), F.col("c")).alias("t")).collect()] == [[], ["nginx"]]


def test_licenses_and_complexity(rows):
    df = rows("x string", [("mit",), (" Apache 2.0 ",), ("GPL-3.0",), ("Other-1",), ("mpl-2.0",)])
    n = code.normalized_license(F.col("x"))
    got = [(r.n, r.b) for r in df.select(n.alias("n"), code.license_bucket(code.license_rank(n)).alias("b")).collect()]
    assert got == [("MIT", "permissive"), ("Apache-2.0", "permissive"), ("GPL-3.0-only", "copyleft_strong"), ("Other-1", "unknown"), ("MPL-2.0", "copyleft_weak")]
    c = rows("c string", [("if a && b:\n for x in y: pass",), ("",)])
    assert [r[0] for r in c.select(code.file_complexity(F.col("c"))).collect()] == [4, 1]
