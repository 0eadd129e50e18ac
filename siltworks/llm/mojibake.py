"""Problem 6: text that was decoded with a wrong encoding.

The first pass counts adjacent character pairs of the whole corpus, but for words that prove
themselves spoiled (their bytes are valid UTF-8 with several multi-byte characters). Mutual
information (marginals have a floor, so that pairs of rare characters don't look like
habits) scores every pair of a content; maximum-scoring segments isolate improbable runs, widened to whole
words. Inverse mappings (encode with the encoding that was wrongly used, decode with the
right one) are tested only inside those runs, and again on their result, as text may have
been spoiled twice. A mapping is accepted if the corpus explains the restored run much
better than the one that was there. Runs with replacement or control characters between
letters are affected even if nothing restores them.

The pair table has at most CLASSES squared (under ten million) entries, whatever the corpus;
text of a dozen languages fills some thousands.

Defined results: null, empty and ASCII contents are unaffected; src_encoding is only a first
guess; content that can't be restored keeps what it has, with recovered = false.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches

#: Characters below FINE are classes of their own; above, a class is a block of 256, or a plane beyond the first.
FINE = 0x530
#: U+2000 to U+25FF (punctuation, signs, box drawing) also are classes of their own.
SIGNS = range(0x2000, 0x2600)
CLASSES = FINE + len(SIGNS) + 256 + 17
#: Least share of the pairs that a marginal counts with.
FLOOR = 0.004
#: Added to a pair's count, and what a run must gain (in nats) to be restored by an 8-bit mapping.
SMOOTH, GAIN = 0.3, 3.5
#: Share of the pairs below which a pair is rare: 8-bit mappings are tried on words that have one.
RARE = 2e-4
#: Score of a pair of plain ASCII characters, which ends a run.
PLAIN = -1.5


_ODD_WORD = re.compile(r"[^ \t\r\n]*[^\x00-\x7f][^ \t\r\n]*[ \t\r\n]?")
#: What a character of a block of 256 costs besides its block.
BLOCK = float(np.log(256))


def classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    out = np.where(cp < FINE, cp, FINE + len(SIGNS) + np.where(cp < 0x10000, cp >> 8, 256 + (cp >> 16)))
    signs = (cp >= SIGNS.start) & (cp < SIGNS.stop)
    out[signs] = FINE + cp[signs] - SIGNS.start
    out[(cp >= 48) & (cp < 58)] = 48
    out[(cp == 10) | (cp == 13) | (cp == 9)] = 32
    return out


def class_of(ch: str) -> int:
    """The class of one character, as classes() gives it."""
    cp = ord(ch)
    if cp < 128:
        return 48 if "0" <= ch <= "9" else 32 if ch in "\n\r\t" else cp
    return FINE + cp - SIGNS.start if cp in SIGNS else cp if cp < FINE else FINE + len(SIGNS) + (cp >> 8 if cp < 0x10000 else 256 + (cp >> 16))


def pairs(text: str) -> np.ndarray:
    """Codes of adjacent pairs with at least one character outside ASCII."""
    c = classes(f" {text} ")
    keep = (c[:-1] > 127) | (c[1:] > 127)
    return (c[:-1] * CLASSES + c[1:])[keep]


def proven(word: str, memo: dict[str, bool]) -> bool:
    """Whether the bytes of a word, under some encoding, are UTF-8 with all its signs in multi-byte characters."""
    got = memo.get(word)
    if got is None:
        if len(memo) > 200_000:
            memo.clear()
        got = False
        n = sum(c > "\x7f" for c in word)
        for wrong in SINGLE:
            t = _utf8(word, wrong) if n > 1 else None
            if t is not None and t != word and (wrong in ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1250") or n >= 4):
                got = True
                break
        memo[word] = got
    return got


def trusted(text: str, memo: dict[str, bool]) -> str:
    """The words of a text with signs outside ASCII, without those that prove themselves spoiled."""
    return "".join(w for w in _ODD_WORD.findall(text) if "�" not in w and not proven(w.strip(" \t\r\n"), memo))


def _count(parts: Iterable[pa.RecordBatch]):
    codes, counts, memo = np.empty(0, np.int64), np.empty(0, np.int64), {}
    for part in parts:
        got = [pairs(trusted(t, memo)) for t in part.column(0).to_pylist() if t and not t.isascii()]
        if got:
            u, n = np.unique(np.concatenate(got), return_counts=True)
            both, at = np.unique(np.concatenate([codes, u]), return_inverse=True)
            codes, counts = both, np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])


def pair_counts(raw: DataFrame) -> DataFrame:
    """code and n of every adjacent pair, counted in each task before the shuffle."""
    return raw.select("content").where("content is not null").mapInArrow(_count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


class Habits:
    """Mutual information and surprise of pairs, from the corpus' counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes, n = codes, counts.astype(float)
        total = max(1.0, n.sum())
        left, right = np.bincount(codes // CLASSES, n, CLASSES), np.bincount(codes % CLASSES, n, CLASSES)
        floor = FLOOR * total
        self.total = total
        mi = np.log(n * total / (np.maximum(left[codes // CLASSES], floor) * np.maximum(right[codes % CLASSES], floor)))
        self.by = dict(zip(codes.tolist(), n.tolist()))
        self.mi = mi
        self.cost: dict[str, float] = {}
        self.rare: dict[str, bool] = {}

    def scores(self, c: np.ndarray) -> np.ndarray:
        """Score of each pair of classes: minus its mutual information; unseen pairs score most."""
        code = c[:-1] * CLASSES + c[1:]
        out = np.full(len(code), PLAIN)
        odd = np.flatnonzero((c[:-1] > 127) | (c[1:] > 127))
        if len(odd) and len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, code[odd]), len(self.codes) - 1)
            out[odd] = np.where(self.codes[at] == code[odd], -self.mi[at], 4.0)
        return out

    def surprise(self, text: str) -> float:
        """Nats that the pairs with characters outside ASCII cost; 0 for ASCII."""
        total, before = 0.0, " "
        cost = self.cost
        for ch in text + " ":
            if ch > "\x7f" or before > "\x7f":
                two = before + ch
                got = cost.get(two)
                if got is None:
                    got = self._cost(two)
                total += got
            before = ch
        return total

    def _cost(self, two: str) -> float:
        if len(self.cost) > 500_000:
            self.cost.clear()
            self.rare.clear()
        n = self.by.get(class_of(two[0]) * CLASSES + class_of(two[1]), 0.0)
        got = -math.log((n + SMOOTH) / self.total) + BLOCK * (ord(two[1]) >= 0x2600)
        self.rare[two] = n < RARE * self.total and ord(two[1]) < 0x2600
        self.cost[two] = got
        return got

    def odd(self, word: str) -> bool:
        """Whether the word has a pair that is rare in the corpus."""
        self.surprise(word)
        return any(self.rare.get(a + b, False) for a, b in zip(" " + word, word + " "))


def runs(text: str, c: np.ndarray, score: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-scoring segments of the pair scores, widened to words, in order and disjoint."""
    hot = np.flatnonzero(score > 0)
    out: list[tuple[int, int]] = []
    if not len(hot):
        return out
    last = -1
    for h in hot.tolist():
        if h <= last:
            continue
        # from a positive pair on, the segment goes on as long as its sum stays positive; its best end counts
        total = best = 0.0
        end = h
        k = h
        while k < len(score) and total >= 0:
            total += score[k]
            if total > best:
                best, end = total, k
            k += 1
        last = end
        a, b = max(0, h - 1), min(len(text), end + 1)  # score k is between characters k-1 and k of text
        while a > 0 and text[a - 1] not in " \n\r\t":
            a -= 1
        while b < len(text) and text[b] not in " \n\r\t":
            b += 1
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


#: Encodings that are mistaken for one another (names of the codecs).
SINGLE = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859_2", "iso8859_15", "koi8_r", "cp866", "cp852", "mac_latin2", "iso8859_5")


CYRILLIC = frozenset(("cp1251", "koi8_r", "cp866", "iso8859_5"))


def _table(codec: str) -> dict[int, str]:
    """Characters of the 128 upper bytes; bytes without one keep the control character of that number."""
    return {b: bytes([b]).decode(codec, "ignore") or chr(b) for b in range(128, 256)}


TABLES = {c: _table(c) for c in SINGLE}
BACK = {c: {ord(ch): b for b, ch in t.items()} for c, t in TABLES.items()}
#: From characters read with one encoding to those of another.
ACROSS = {
    (w, r): {o: TABLES[r][b] for o, b in BACK[w].items()}
    for w in SINGLE for r in SINGLE if w != r
}


def _bytes(text: str, wrong: str) -> bytes | None:
    back, out = BACK[wrong], bytearray()
    for ch in text:
        o = ord(ch)
        if o < 128:
            out.append(o)
        elif o in back:
            out.append(back[o])
        else:
            return None
    return bytes(out)


def _utf8(text: str, wrong: str) -> str | None:
    raw = _bytes(text, wrong)
    if raw is None:
        return None
    try:
        t = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if wrong in CYRILLIC and max(t) > "\u2fff" and all(c.isalpha() for c in text if c > "\x7f"):
        return None  # a few Cyrillic words happen to be bytes of ideographs; spoiled ideographs also have signs
    return t


_WORD = re.compile(r"[^ �]+")


def by_utf8(word: str, habits: Habits, memo: dict) -> str:
    """The word as UTF-8, up to three times over, while the corpus explains it better; else the word itself."""
    got = memo.get(word)
    if got is not None:
        return got
    best = word
    for _ in range(3):
        base, step, to = habits.surprise(best), GAIN, best
        for wrong in SINGLE:
            t = _utf8(best, wrong)
            if t is not None and t != best and (g := base - habits.surprise(t)) > step:
                to, step = t, g
        if to == best:
            break
        best = to
    if len(memo) > 200_000:
        memo.clear()
    memo[word] = best
    return best


def _candidate(word: str) -> bool:
    """Whether an 8-bit mapping may be tried: signs next to letters, not a sign on its own."""
    core = word.strip("\"'`.,;:!?()[]<>*/#-")
    return len(core) > 1 and not core.isascii() and any(c.isalpha() for c in core)


def by_single(words: list[str], habits: Habits, memo: dict) -> dict[str, str]:
    """Restored words under the one 8-bit mapping that explains all of a content's runs best.

    A mapping is tested on every run of the content together, as a wrong decoding spoils
    whole passages; words that it doesn't improve stay.
    """
    if not words:
        return {}
    key = tuple(words)
    if key in memo:
        return memo[key]
    base = [habits.surprise(w) for w in words]
    odd = [{ord(c) for c in w if c > "\x7f"} for w in words]
    every = set().union(*odd)
    best: dict[str, str] = {}
    most = GAIN
    for across in ACROSS.values():
        total, top, got = 0.0, 0.0, {}
        keys = across.keys()
        if every.isdisjoint(keys):
            continue
        for w, b, o in zip(words, base, odd):
            if not o.isdisjoint(keys):
                t = w.translate(across)
                g = b - habits.surprise(t)
                total += g
                top = max(top, g)
                if g > 0:
                    got[w] = t
        if total > most and top > 0.5 * GAIN:
            most, best = total, got
    if len(memo) > 50_000:
        memo.clear()
    memo[key] = best
    return best


#: Replacement characters, unless one is meant as a string of its own, and control characters that no text has.
_LOST = re.compile("(?<![\"'`])�|�(?![\"'`])|[\\x80-\\x84\\x86-\\x9f]")


class Finding(NamedTuple):
    """What examine() says of a text: whether it is affected, its restored text, whether nothing was lost, and how many runs a mapping restored."""

    affected: bool
    restored: str
    whole: bool
    n_restored: int


def _edited(text: str, a: int, b: int, edits: list[tuple[int, int, str]]) -> str:
    """text[a:b] with those of the edits (disjoint, in order) that lie in it."""
    out = []
    for k in range(bisect_left(edits, (a,)), len(edits)):
        start, end, new = edits[k]
        if start >= b:
            break
        out += [text[a:start], new]
        a = end
    return "".join(out) + text[a:b]


def examine(text: str, habits: Habits, utf8: dict, single: dict) -> Finding:
    """Mappings are tested inside the improbable runs only, and what they restore is put at the places of those runs."""
    c = classes(f" {text} ")
    spans = [(a, b) for a, b in runs(text, c, habits.scores(c)) if not text[a:b].isascii()]
    edits: list[tuple[int, int, str]] = []
    spoiled: list[tuple[int, int, str]] = []
    for a, b in spans:
        run = text[a:b]
        new = by_utf8(run, habits, utf8) if "�" not in run else run
        if new == run:
            new = _WORD.sub(lambda m: m[0] if m[0].isascii() else by_utf8(m[0], habits, utf8), run)
        if new != run:
            edits.append((a, b, new))
        else:
            spoiled += [(a + m.start(), a + m.end(), m[0]) for m in _WORD.finditer(run) if _candidate(m[0]) and habits.odd(m[0])]
    fixed = by_single(sorted({w for _, _, w in spoiled}), habits, single)
    edits += [(a, b, fixed[w]) for a, b, w in spoiled if w in fixed]
    edits.sort()
    restored = _edited(text, 0, len(text), edits)
    # what no mapping brings back: signs of lost characters in the runs, as they are after the mappings
    lost = any(_LOST.search(text[max(0, a - 1): a] + _edited(text, a, b, edits) + text[b: b + 1]) for a, b in spans)
    return Finding(bool(edits) or lost, restored, not lost, len(edits))


def _examine_all(codes: np.ndarray, counts: np.ndarray, with_text: bool):
    def make():
        habits, utf8, single = Habits(codes, counts), {}, {}

        def fn(cols: dict[str, list]) -> dict[str, list]:
            names = ("blob_id", "recovered", "n_restored", *(["restored"] if with_text else []))
            out: dict[str, list] = {k: [] for k in names}
            for blob, text in zip(cols["blob_id"], cols["content"]):
                if text is None or text.isascii():
                    continue
                got = examine(text, habits, utf8, single)
                if got.affected:
                    out["blob_id"].append(blob)
                    out["recovered"].append(got.whole)
                    out["n_restored"].append(got.n_restored)
                    if with_text:
                        out["restored"].append(got.restored)
            return out

        return fn

    return make


def repair(raw: DataFrame, with_text: bool = True) -> DataFrame:
    """blob_id, recovered, n_restored (runs that a mapping brought back; 0 where characters are lost and nothing else is wrong) and restored content of each affected row."""
    table = pair_counts(raw).orderBy("code").toArrow()  # bounded by CLASSES squared, not by the corpus
    codes, counts = table["code"].to_numpy(), table["n"].to_numpy()
    return batches(
        raw.select("blob_id", "content").where("content is not null"), _examine_all(codes, counts, with_text),
        "blob_id string, recovered boolean, n_restored int" + (", restored string" if with_text else ""))


def found(raw: DataFrame) -> DataFrame:
    """p6_found: files with at least one wrongly decoded passage."""
    return repair(raw, False).where("blob_id is not null").select("blob_id").distinct()
