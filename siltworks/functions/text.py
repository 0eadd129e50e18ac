"""Text measures as built-in column expressions (whole-stage code, no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends of Python's str.splitlines, and its white space (fixed values).
LINE_END = "\\r\\n|[\\n\\x0B\\x0C\\r\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}]"
BLANK = "[\\t-\\r\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
#: Characters that don't count as letters, digits or the punctuation of code.
ODD = "[^\\p{L}\\p{N}_(){}\\[\\];:=<>+\\-*/.,'\"# \\n\\t]"


def lines(content: Column) -> Column:
    """Lines as str.splitlines has them, but one empty line for empty text."""
    parts = F.split(content, LINE_END, -1)
    return F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def longest(parts: Column) -> Column:
    return F.array_max(F.transform(parts, F.length))


def total_length(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.length(x))


def stripped_length(content: Column) -> Column:
    return F.length(F.regexp_replace(content, f"\\A{BLANK}+|{BLANK}+\\z", ""))


def odd_characters(content: Column) -> Column:
    """Of the first 200,000 characters, those that aren't alphanumeric or punctuation of code."""
    return F.regexp_count(F.substring(content, 1, 200_000), F.lit(ODD))


def sample_length(content: Column) -> Column:
    return F.least(F.length(content), F.lit(200_000))


def alnum_ratio(content: Column) -> Column:
    n = F.greatest(sample_length(content), F.lit(1))
    return F.round((sample_length(content) - odd_characters(content)) / n, 4)


def sha256(content: Column) -> Column:
    return F.sha2(F.encode(content, "UTF-8"), 256)


def record_id(repo: Column, path: Column, sha: Column) -> Column:
    """The first 32 hex digits over repository, path and content hash: the same in every source."""
    nul = F.lit("\x00")
    return F.substring(F.sha2(F.encode(F.concat(F.coalesce(repo, F.lit("")), nul, F.coalesce(path, F.lit("")), nul, sha), "UTF-8"), 256), 1, 32)


def git_blob_sha1(content: Column) -> Column:
    raw = F.encode(content, "UTF-8")
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(content).cast("string"), F.lit("\x00")), "UTF-8"), raw))


def token_estimate(content: Column) -> Column:
    """0 for empty text, else a quarter of its bytes and at least 1."""
    return F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.octet_length(content) / 4))).cast("bigint")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The basename without its last extension; leading dots belong to the name."""
    return F.regexp_replace(basename(path), "(?s)\\A(\\.*[^.].*)\\.[^.]*\\z", "$1")


def extension(path: Column) -> Column:
    """The last extension with its dot, or an empty string; a name that begins with dots has none for those."""
    return F.regexp_extract(basename(path), "(?s)\\A\\.*[^.].*(\\.[^.]*)\\z", 1)


def or_none(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(c, F.lit(""))
