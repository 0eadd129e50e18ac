"""Problems 7 and 8: token counts by symbol lists and merge queues, and ids by shared chunks.

Both use a byte-level BPE of the public tokenizers; its vocabulary file is a parameter.

Counting keeps each piece as a linked list of symbols with a priority queue of merges and
counts the symbols that survive; words (with the blanks before them) are gathered by slice or
file, counted once and weighted by their frequency. Encoding cuts texts into content-defined chunks by a
rolling hash; a chunk's inside is encoded once in each task, and the join of two chunks is
encoded again, piece by piece, until its pieces end where those of the next chunk do.

Defined results: a null or empty text has no tokens: count 0, ids []. Strings that look like
special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import importlib.util
import os
import re
from collections import Counter
from collections.abc import Iterable, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches
from siltworks.llm.language import BY_NAME, UNKNOWN

#: Pre-tokenizer of the byte-level BPE (fixed by the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the pre-tokenizer has it.
SPACE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a vocabulary file: the folder in SILTWORKS_TOKENIZERS, or the installed package."""
    folder = os.environ.get("SILTWORKS_TOKENIZERS")
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(folder, name)


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# --- counting -----------------------------------------------------------------------------


def surviving(piece: bytes, rank: dict[bytes, int]) -> int:
    """Symbols left of a piece after all merges, lowest rank (then leftmost) first."""
    n = len(piece)
    if n < 2 or piece in rank:
        return 1 if n else 0
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    end = list(range(1, n + 1))  # symbol k is piece[k:end[k]]; a merged symbol has end 0
    queue = []
    for k in range(n - 1):
        r = rank.get(piece[k: k + 2])
        if r is not None:
            queue.append((r, k, k + 2))
    heapq.heapify(queue)
    alive = n
    while queue:
        _, k, stop = heapq.heappop(queue)
        j = right[k] if end[k] else n
        if j >= n or not end[k] or not end[j] or end[j] != stop:
            continue  # one of the two has changed since
        end[k], end[j] = stop, 0
        right[k] = right[j]
        if right[k] < n:
            left[right[k]] = k
        alive -= 1
        if left[k] >= 0:
            r = rank.get(piece[left[k]: stop])
            if r is not None:
                heapq.heappush(queue, (r, left[k], stop))
        if right[k] < n:
            r = rank.get(piece[k: end[right[k]]])
            if r is not None:
                heapq.heappush(queue, (r, k, end[right[k]]))
    return alive


class Counts:
    """Token counts of texts; words are remembered up to a bound."""

    _WORD = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+\Z")

    def __init__(self, path: str, keep: int = 400_000) -> None:
        self.rank, self.keep = ranks(path), keep
        self.piece = regex.compile(PATTERN)
        self.words: dict[str, int] = {}

    def _word(self, word: str) -> int:
        n = sum(surviving(p.encode("utf-8", "surrogatepass"), self.rank) for p in self.piece.findall(word))
        if len(self.words) >= self.keep:
            self.words.clear()
        if len(word) < 200:
            self.words[word] = n
        return n

    def weighted(self, words: Mapping[str, int]) -> int:
        """Tokens of words that occur so many times: each word is counted once and weighted by its frequency."""
        known, total = self.words, 0
        for word, times in words.items():
            n = known.get(word)
            total += times * (self._word(word) if n is None else n)
        return total

    def __call__(self, text: str | None) -> int:
        return self.weighted(Counter(self._WORD.findall(text))) if text else 0

    def totals(self, keys: Iterable[tuple], texts: Iterable[str | None]) -> dict[tuple, list[int]]:
        """[texts, tokens] of each key; the words of all texts of a key are gathered before they are counted."""
        words: dict[tuple, Counter] = {}
        n_texts: Counter = Counter()
        for key, text in zip(keys, texts):
            n_texts[key] += 1
            if text:
                words.setdefault(key, Counter()).update(self._WORD.findall(text))
        return {k: [n, self.weighted(words.get(k, {}))] for k, n in n_texts.items()}


def _count(path: str, keys: tuple[str, ...], column: str):
    def make():
        count = Counts(path)

        def fn(c: dict[str, list]) -> dict[str, list]:
            return {k: c[k] for k in keys} | {"n_tokens": [count(t) for t in c[column]]}

        return fn

    return make


def counted(df: DataFrame, keys: list[str], column: str, path: str | None = None) -> DataFrame:
    """The given columns and n_tokens of a text column, one row for each row; texts stay in the workers."""
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_tokens bigint"
    return batches(df.select(*keys, column), _count(path or vocabulary_path(), tuple(keys), column), schema)


def _sum_up(path: str, keys: tuple[str, ...], column: str):
    def make():
        count = Counts(path)

        def fn(c: dict[str, list]) -> dict[str, list]:
            got = count.totals(zip(*[c[k] for k in keys]), c[column])
            return {k: [key[i] for key in got] for i, k in enumerate(keys)} | {"n_texts": [v[0] for v in got.values()], "n_tokens": [v[1] for v in got.values()]}

        return fn

    return make


def summed(df: DataFrame, keys: list[str], column: str, path: str | None = None) -> DataFrame:
    """n_texts and n_tokens of a text column by keys (strings), one row for each key in a batch, to be added up."""
    schema = ", ".join(f"`{k}` string" for k in keys) + ", n_texts bigint, n_tokens bigint"
    return batches(df.select(*keys, column), _sum_up(path or vocabulary_path(), tuple(keys), column), schema)


def _language():
    s = F.lower(F.trim("lang"))
    names = F.create_map(*[F.lit(x) for n, k in sorted(BY_NAME.items()) for x in (n, k)])
    code = F.coalesce(F.try_element_at(names, s), F.try_element_at(names, F.split(s, "[-_]")[0]), s)
    return F.when((s == "") | s.isin(*sorted(UNKNOWN)) | s.isNull(), "unknown").otherwise(code)


def document_slices(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Slices of documents; a null language, source or domain is "unknown", and languages are in one spelling."""
    docs = documents.select(F.coalesce("source", F.lit("unknown")).alias("source"), _language().alias("language"), F.coalesce("domain", F.lit("unknown")).alias("domain"), "text")
    docs = summed(docs, ["source", "language", "domain"], "text", path).groupBy("source", "language", "domain").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_tokens").alias("n_tokens"))
    return docs.select(F.lit("document").alias("kind"), F.lit(None).cast("string").alias("shard"), "source", "language", "domain", "n_texts", "n_tokens")


def file_slices(raw: DataFrame, shards: DataFrame, path: str | None = None) -> DataFrame:
    """Slices of files; those delivered more than once count once (they share blob_id and content)."""
    files = counted(raw, ["blob_id", "language", "source_shard"], "content", path)
    once = files.where("blob_id is not null").groupBy("blob_id").agg(F.min("language").alias("language"), F.min("source_shard").alias("source_shard"), F.max("n_tokens").alias("n_tokens"))
    once = once.drop("blob_id").unionByName(files.where("blob_id is null").drop("blob_id"))
    once = once.groupBy("source_shard", F.coalesce(F.lower(F.trim("language")), F.lit("unknown")).alias("language")).agg(F.count("*").alias("n_texts"), F.sum("n_tokens").alias("n_tokens"))
    names = shards.select(F.col("shard_id").alias("source_shard"), F.col("source_dataset").alias("s")).where("source_shard is not null").dropDuplicates(["source_shard"])
    return once.join(names, "source_shard", "left").select(
        F.lit("file").alias("kind"), F.col("source_shard").alias("shard"), F.coalesce("s", F.lit("unknown")).alias("source"), "language", F.lit("code").alias("domain"), "n_texts", "n_tokens")


def slices(documents: DataFrame, raw: DataFrame, shards: DataFrame, path: str | None = None) -> DataFrame:
    """kind, shard, source, language, domain, n_texts and n_tokens of the finest slices."""
    return document_slices(documents, path).unionByName(file_slices(raw, shards, path))


def budget(documents: DataFrame, raw: DataFrame, shards: DataFrame, path: str | None = None) -> DataFrame:
    """Exact totals by source, language and domain, with subtotals (level tells which).

    reported is the sum of shards.token_count of the source's shards and is only given for
    whole sources of files.
    """
    fine = slices(documents, raw, shards, path).groupBy("kind", "source", "language", "domain").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_tokens").alias("n_tokens"))
    total = fine.rollup("kind", "source", "language", "domain").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_tokens").alias("n_tokens"), F.grouping_id().alias("g"))
    total = total.withColumn("level", F.expr("element_at(map(0L, 'domain', 1L, 'language', 3L, 'source', 7L, 'kind', 15L, 'all'), g)")).drop("g")
    reported = shards.groupBy(F.col("source_dataset").alias("r")).agg(F.sum("token_count").alias("reported"))
    joined = total.join(reported, (F.col("source") == F.col("r")) & (F.col("kind") == "file") & (F.col("level") == "source"), "left")
    return joined.select("level", "kind", "source", "language", "domain", "n_texts", "n_tokens", "reported")


def by_shard(raw: DataFrame, shards: DataFrame, path: str | None = None) -> DataFrame:
    """Each shard's reported token_count beside the tokens of its files; reported is null where the run said nothing or 0."""
    found = file_slices(raw, shards, path).where("shard is not null").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_texts").alias("n_texts"))
    s = shards.select("shard_id", "source_dataset", F.when(F.col("token_count") > 0, F.col("token_count")).alias("reported")).dropDuplicates(["shard_id"])
    return s.join(found, s.shard_id == found.shard, "left").select(
        "shard_id", "source_dataset", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), "reported",
        (F.coalesce("n_tokens", F.lit(0)) - F.col("reported")).alias("difference"))


# --- encoding -----------------------------------------------------------------------------

#: Characters of the rolling hash's window, and the bits of the hash that are 1 at a boundary (a chunk has 128 characters on average).
WINDOW, MASK = 12, np.uint32(0x7F << 20)
#: Before white space that follows something else a piece always ends: the first and the last such place of a chunk.
_CUT = re.compile(rf"[^{SPACE}](?=[ \t\r\n])")
_LAST_CUT = re.compile(rf".*[^{SPACE}](?=[ \t\r\n])", re.S)


def boundaries(text: str) -> list[int]:
    """Ends of content-defined chunks: where the hash of the last WINDOW characters has all bits of MASK."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    h = np.zeros(len(cp), dtype=np.uint32)
    factor = np.uint32(1)
    mixed = cp * np.uint32(2_654_435_761) + np.uint32(0x9E37)
    for k in range(min(WINDOW, len(cp))):
        h[k:] += mixed[: len(cp) - k] * factor
        factor = np.uint32((int(factor) * 0x01000193) & 0xFFFFFFFF)
    out = (np.flatnonzero((h & MASK) == MASK) + 1).tolist()
    if not out or out[-1] != len(cp):
        out.append(len(cp))
    return out


class Encoder:
    """Ids of texts; insides of chunks and joins are encoded once and remembered up to a bound of characters.

    A chunk is cut into pieces of the tokenizer on its own. Its pieces are those of the text from
    the first end of a piece on at which the pieces of the text (from the last certain one before
    the chunk) and of the chunk end together; they are certain up to two characters before the
    chunk's end, as no piece depends on more of what follows. In between, the join is encoded
    again. A chunk without such a place only makes the join longer, so that text without blanks
    is treated like any other. Places after white space aren't used, as white space before other
    text is split differently from white space at an end.
    """

    def __init__(self, path: str, keep: int = 40_000_000) -> None:
        import tiktoken

        self.encode = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={}).encode_ordinary
        self.piece = regex.compile(PATTERN)
        self.keep, self.held = keep, 0
        #: Of each chunk: the places where its pieces end, and the last certain one.
        self.places: dict[str, tuple[frozenset[int], int]] = {}
        #: Of a join before a chunk: its ids with the chunk's inside, and what is left over.
        self.joined: dict[tuple[str, str], tuple[np.ndarray | None, str]] = {}
        self.insides: dict[tuple[str, int], np.ndarray] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.encode(text), dtype=np.int32)

    def _places(self, chunk: str) -> tuple[frozenset[int], int]:
        got = self.places.get(chunk)
        if got is None:
            ends = [m.end() for m in self.piece.finditer(chunk)]
            sure = [e for e in ends if e <= len(chunk) - 2 and not chunk[e - 1].isspace()]
            self.places[chunk] = got = frozenset([0, *sure]), max(sure, default=0)
            self.held += len(chunk) + 400
        return got

    def _inside(self, chunk: str, a: int, b: int) -> np.ndarray:
        """Ids of a chunk from a place to its last certain one."""
        got = self.insides.get((chunk, a))
        if got is None:
            self.insides[chunk, a] = got = self._ids(chunk[a:b])
            self.held += len(chunk) + 200
        return got

    def _join(self, pending: str, chunk: str) -> tuple[np.ndarray | None, str]:
        """Ids of pending and the chunk up to its last certain place, and the rest of the chunk; no ids where the two never agree."""
        got = self.joined.get((pending, chunk))
        if got is not None:
            return got
        both, n = pending + chunk, len(pending)
        got = None, both
        cut = _CUT.search(chunk)
        if cut:
            first, last = cut.end(), _LAST_CUT.match(chunk).end()
            got = np.concatenate([self._ids(pending + chunk[:first]), self._inside(chunk, first, last)]), chunk[last:]
        else:
            places, last = self._places(chunk)
            for e in (m.end() - n for m in self.piece.finditer(both)) if last else ():
                if e > last:
                    break
                if e >= 0 and e in places and not both[n + e - 1: n + e].isspace():
                    got = np.concatenate([self._ids(both[: n + e]), self._inside(chunk, e, last)]), chunk[last:]
                    break
        if len(both) < 4_000:
            self.joined[pending, chunk] = got
            self.held += n + 300
        return got

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        if self.held > self.keep:
            self.places.clear()
            self.joined.clear()
            self.insides.clear()
            self.held = 0
        parts: list[np.ndarray] = []
        pending, at, known = "", 0, self.joined
        for end in boundaries(text):
            chunk = text[at:end]
            at = end
            if len(pending) > 2_000:  # no place for long: what is pending grows without being searched at every chunk
                pending += chunk
                continue
            ids, pending = known.get((pending, chunk)) or self._join(pending, chunk)
            if ids is not None:
                parts.append(ids)
        parts.append(self._ids(pending))
        return np.concatenate(parts)


def _encode(path: str):
    def run(batches_: Iterable[pa.RecordBatch]):
        encode = None
        for part in batches_:
            if part.num_rows:
                encode = encode or Encoder(path)
                docs, texts = part.column(0), part.column(1).to_pylist()
                for k in range(0, len(texts), 512):  # bounded lists, however long the texts are
                    ids = [encode(t) for t in texts[k: k + 512]]
                    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                    np.cumsum([len(x) for x in ids], out=offsets[1:])
                    flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays([docs.slice(k, 512), flat], names=["doc_id", "ids"])

    return run


def ids(documents: DataFrame, path: str | None = None) -> DataFrame:
    """p8_ids: doc_id and ids of every text, without special tokens."""
    return documents.select("doc_id", "text").mapInArrow(_encode(path or vocabulary_path()), "doc_id bigint, ids array<int>")
