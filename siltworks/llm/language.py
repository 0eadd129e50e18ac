"""Problem 10: the language of each document and of each of its segments, by compression.

For each language a raw-content dictionary of zstandard holds sample text; a segment belongs
to the language whose dictionary lets it be encoded in the fewest bytes, with the margin to
the second as confidence; narrow margins are rejected. Segments are sentences of prose:
fenced and unfenced code, tool output, headings, identifiers and numbers are left out.
A sentence is encoded clause by clause and its sizes are added, so that clauses which many
documents share are encoded once in each task.

The dictionaries come from a bounded sample of labelled documents (SAMPLE for each
language). As labels may be wrong, the sample judges itself first: one half's dictionaries
classify the other half, and only sentences on which label and language agree are kept.

Defined results: null, empty and blank texts and texts without prose have no segments;
equal sizes are rejected; repeated texts give the same rows under each doc_id.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches

LANGS = ("en", "de", "fr", "es", "pt", "it", "nl", "pl", "ru", "ja", "zh")

#: Documents that the dictionaries are made from, for each language; their length in characters.
SAMPLE, SHORTEST, LONGEST = 120, 60, 6000
#: Bytes of a dictionary at most, and the bytes by which the best must beat the second.
DICT_BYTES, MARGIN = 32_000, 2
#: Level of compression: sizes of single clauses hardly differ between levels, and the tables of the first are the smallest.
LEVEL = 1

#: Other spellings of the languages' names (fixed values).
NAMES = {
    "en": "en eng english anglais englisch", "de": "de deu ger german deutsch", "fr": "fr fra fre french français francais", "es": "es spa spanish español espanol castellano", "pt": "pt por portuguese português portugues",
    "it": "it ita italian italiano", "nl": "nl nld dut dutch nederlands", "pl": "pl pol polish polski", "ru": "ru rus russian русский", "ja": "ja jpn jp japanese 日本語", "zh": "zh zho chi cmn cn chinese 中文",
}
BY_NAME = {n: k for k, v in NAMES.items() for n in v.split()}
UNKNOWN = frozenset("unknown und undefined undetermined none null nil n/a na nan ? - -- other mul mis zxx xx unk unspecified missing not known any auto".split()) | {"not known", "tbd", "todo"}


def label_of(lang: str | None) -> str | None:
    """The code that a label names; None if it is missing; other labels stay as they are."""
    s = (lang or "").strip().lower()
    if not s or s in UNKNOWN:
        return None
    base = re.split(r"[-_@. (]", s, maxsplit=1)[0]
    return BY_NAME.get(s) or BY_NAME.get(base) or s


# --- prose --------------------------------------------------------------------------------

_FENCED = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[^\n]*$|\Z)", re.M | re.S)
_CODE = re.compile(
    r"\s{4,}|\t|\s*(?:[$#%] \w|[\w./\-]+: (?:exit|error|0x|\d)|#include|import |from \S+ import|def |class |return\b|const |let |var |func |function |package |use |pub |public |private |static |if\s*\(|for\s*\(|while\s*\(|\}|\{|//|/\*|\*/|<\?|<\w+[ >/]|select |insert |update |create |delete |end$|fi$|done$|[\w.$\[\]\"']+\s*(?:=|:=|\+=)\s|[\w.]+\([^)]*\)\s*;?\s*$|@\w|[+\-]{3} |diff |at \w+[.(]|Traceback)",
)
_QUOTE = re.compile(r"(?: {0,3}>)+ ?")
_LEAD = re.compile(r"^\s*(?:[-*+•]\s+|\d+[.)]\s+|>+\s*|\[[ x]\]\s*|#+\s*)*")
_MARKS = re.compile(r"`[^`\n]*`|https?://\S+|\S+@\S+|<[^<>\n]{0,80}>|\b\w+(?:[_./\\:]\w+)+\b|\b[a-z]+[A-Z]\w*\b|\b0x[0-9a-f]+\b|[​-‏﻿­⁠]")
#: Ends of sentences: a stop, closing marks and a blank before something that begins one; ideographic stops need no blank.
_END = re.compile(r"[.!?…][\"'”»)\]]*\s+(?=[\"'“«(\[¿¡]*[^\Wa-zß-öø-ÿа-я_])")
_END_WIDE = re.compile(r"(?<=[.!?…])[\"'”»)\]]*\s+(?=[\"'“«(\[¿¡]*[^\Wa-zß-öø-ÿа-я_])|(?<=[。！？])[」』）]*")
_WIDE = re.compile("[。！？]")
_CLOSING, _ENDS = " \t\r\"'”»)]」』）", tuple(".!?…。！？")
_CLAUSE = re.compile(r"[,;:、，；：()\[\]—–]+\s*")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_KANA = re.compile(r"[぀-ヿ]")
_HAS_MARKS = re.compile(r"[`_/\\@<​-‏﻿­⁠]")
_HAS_JOINTS = re.compile(r"[A-Z.:](?:(?<=[a-z][A-Z])|(?<=\w[.:])(?=\w))")
_WORDS = re.compile(r"(?:[^\W\d_]{2,}[\W\d_]+(?:[^\W\d_][\W\d_]+)*){2}[^\W\d_]{2,}")


_VALUES = re.compile(r"`[^`\n]*`|\d(?<![\w.]\d)\d*(?:[.,]\d+)*(?!\w)")


def split_sentences(line: str) -> list[str]:
    """Sentences of a line; closing marks and blanks between them are dropped."""
    if not line.isascii() and _WIDE.search(line):
        return _END_WIDE.split(line)
    out, at = [], 0
    for m in _END.finditer(line):
        out.append(line[at: m.start() + 1])
        at = m.end()
    out.append(line[at:])
    return out


def parts(text: str) -> list[str]:
    """Sentences and remainders of the lines that may be prose, without code spans and numbers, in order."""
    if "```" in text or "~~~" in text:
        text = _FENCED.sub("", text)
    out: list[str] = []
    plain = _VALUES.sub("", text).split("\n")
    for k, line in enumerate(text.split("\n")):
        quote = _QUOTE.match(line) if ">" in line else None  # what is quoted may be prose or code
        if not line or line[-1] in ";{}" or _CODE.match(line, quote.end() if quote else 0):
            continue
        line = plain[k]
        head = _LEAD.match(line)
        if "#" not in head[0]:
            out += split_sentences(line[head.end():] if head.end() else line)
    return out


def prose(part: str) -> str | None:
    """The words of a whole sentence, or None: it has an end, and at least three words (or five ideographs) that aren't identifiers."""
    if part.rstrip(_CLOSING)[-1:] not in _ENDS:
        return None
    if _HAS_MARKS.search(part) or _HAS_JOINTS.search(part) or "0x" in part:
        part = _MARKS.sub(" ", part)
    return part if _WORDS.search(part) or len(_CJK.findall(part)) >= 5 else None


def sentences(text: str) -> list[str]:
    """Whole sentences of prose of a text, in order."""
    return [p for p in map(prose, parts(text)) if p is not None]


# --- classifier ---------------------------------------------------------------------------


def _script(text: str) -> tuple[str, ...]:
    """Languages that a text's script leaves possible."""
    if text.isascii():
        return LANGS[:8]
    if _CJK.search(text) and len(_CJK.findall(text)) * 3 > len(_LETTER.findall(text)):
        return ("ja",) if _KANA.search(text) else ("ja", "zh")
    return ("ru",) if _CYRILLIC.search(text) and len(_CYRILLIC.findall(text)) * 2 > len(_LETTER.findall(text)) else LANGS[:8]


_LETTER, _CYRILLIC = re.compile(r"[^\W\d_]"), re.compile("[Ѐ-ԯ]")


def clauses(sentence: str) -> list[str]:
    """What is encoded: clauses without numbers and marks around them."""
    out = (c.strip(" .!?…。！？\"'") for c in _CLAUSE.split(" ".join(sentence.split())))
    return [c for c in out if len(c) > 1]


class Classifier:
    """Compressed sizes under each language's dictionary; parts and clauses are remembered, as they recur in many documents."""

    def __init__(self, dictionaries: dict[str, bytes], keep: int = 120_000_000) -> None:
        self.by = {}
        for lang, raw in sorted(dictionaries.items()):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        #: Characters that may be remembered, and those that are, with some for each entry.
        self.keep, self.held = keep, 0
        self.sizes: dict[tuple[str, ...], dict[str, tuple[int, list[int]]]] = {}
        self.memo: dict[str, tuple[str | None, float]] = {}
        self.possible: dict[tuple[str, ...], tuple[str, ...]] = {}

    def _languages(self, script: tuple[str, ...]) -> tuple[str, ...]:
        """Languages to encode with: those of the script; all for a script that one of them has alone, so that its sentences have a margin, too."""
        got = self.possible.get(script)
        if got is None:
            got = tuple(k for k in script if k in self.by)
            self.possible[script] = got = tuple(self.by) if len(script) == 1 and got else got
        return got

    def _encode(self, clauses_: Iterable[str], possible: tuple[str, ...]) -> None:
        """Sizes of clauses in each of the languages, language by language, so that a dictionary's tables stay in the processor's cache."""
        new = list(clauses_)
        raw = [c.encode() for c in new]
        columns = [[len(x) for x in map(self.by[k].compress, raw)] for k in possible]
        self.sizes[possible].update(zip(new, zip(map(len, raw), zip(*columns))))
        self.held += sum(map(len, new)) + 200 * len(new)

    def classify(self, sentence: str) -> tuple[str | None, float]:
        """(language, confidence) of one sentence; no language if the margin is narrow."""
        return self.classify_all([sentence])[0]

    def classify_all(self, sentences_: list[str]) -> list[tuple[str | None, float]]:
        """classify() of many sentences. Every language of the script encodes every clause; none is left out by a guess.

        Where no dictionary of the script's languages is there, the script itself decides if it leaves one language.
        """
        cut: list[tuple[tuple[str, ...], list[str]]] = []
        fresh: dict[tuple[str, ...], dict[str, None]] = {}
        for s in sentences_:
            script = _script(s)
            possible = self._languages(script)
            if len(possible) < 2:
                cut.append((possible or (script if len(script) == 1 else ()), []))
                continue
            known = self.sizes.setdefault(possible, {})
            cs = clauses(s)
            cut.append((possible, cs))
            for c in cs:
                if c not in known:
                    fresh.setdefault(possible, {})[c] = None
        for possible, new in fresh.items():
            self._encode(new, possible)
        out: list[tuple[str | None, float]] = []
        for possible, cs in cut:
            if len(possible) < 2:
                out.append((possible[0], 1.0) if possible else (None, 0.0))
                continue
            if not cs:
                out.append((None, 0.0))
                continue
            known = self.sizes[possible]
            n, sizes = known[cs[0]]
            if len(cs) > 1:
                got = [known[c] for c in cs]
                n, sizes = sum([g[0] for g in got]), [sum(x) for x in zip(*[g[1] for g in got])]
            first, second = sorted(sizes)[:2]
            margin = second - first
            out.append((possible[sizes.index(first)], round(min(1.0, margin / max(8.0, 0.35 * n)), 4)) if margin >= MARGIN else (None, 0.0))
        return out

    def learn(self, parts_: Iterable[str]) -> None:
        """Remembers the language of the prose of each part."""
        new = [p for p in parts_ if p not in self.memo]
        if self.held > self.keep:
            self.sizes.clear()
            self.memo.clear()
            self.held, new = 0, list(parts_)
        texts = [prose(p) for p in new]
        self.memo.update(dict.fromkeys((p for p, t in zip(new, texts) if t is None), (None, 0.0)))
        kept = [p for p, t in zip(new, texts) if t is not None]
        self.memo.update(zip(kept, self.classify_all([t for t in texts if t is not None])))
        self.held += sum(map(len, new)) + 200 * len(new)


def _dictionary(parts: list[str]) -> bytes:
    """Distinct clauses, the most frequent at the end, where references are cheapest and nothing is cut off."""
    count: dict[str, int] = defaultdict(int)
    for s in parts:
        for c in clauses(s):
            count[c] += 1
    # a clause that brings words of its own is worth more than one more arrangement of known words
    seen: set[str] = set()
    fresh, known = [], []
    for c in sorted(count, key=lambda c: (-count[c], c)):
        pieces = set(c.lower().split()) if " " in c else {c[k: k + 3] for k in range(len(c))}
        (fresh if pieces - seen else known).append(c)
        seen |= pieces
    return "\n".join([*known[::-1], *fresh[::-1]]).encode()[-DICT_BYTES:]


def dictionaries(sample: list[tuple[str, str]]) -> dict[str, bytes]:
    """Dictionaries from (label, text), after the sample has judged itself."""
    halves: list[dict[str, list[str]]] = [defaultdict(list), defaultdict(list)]
    for k, (lang, text) in enumerate(sorted(sample)):
        halves[k % 2][lang] += [s for s in sentences(text) if lang in _script(s)]
    kept: dict[str, list[str]] = defaultdict(list)
    for own, other in ((0, 1), (1, 0)):
        judge = Classifier({k: _dictionary(_vote(v)) for k, v in halves[other].items() if v})
        for lang, parts in halves[own].items():
            kept[lang] += [s for s, (got, _) in zip(parts, judge.classify_all(parts)) if got == lang]
    return {k: _dictionary(v) for k, v in kept.items() if v}


def _vote(parts: list[str]) -> list[str]:
    """Sentences whose clauses mostly have words that the label's other sentences use, too."""
    count: dict[str, int] = defaultdict(int)
    words = [set(re.findall(r"[^\W\d_]+", s.lower())) for s in parts]
    for ws in words:
        for w in ws:
            count[w] += 1
    typical = 0.02 * len(parts) + 1
    if len(parts) < 20 or _CJK.search("".join(parts[:20])):
        return parts
    return [s for s, ws in zip(parts, words) if ws and sum(count[w] > typical for w in ws) > 0.5 * len(ws)]


def sample_of(documents: DataFrame) -> list[tuple[str, str]]:
    """At most SAMPLE labelled documents of each language, chosen by a hash of doc_id and text."""
    names = F.create_map(*[F.lit(x) for n, k in sorted(BY_NAME.items()) for x in (n, k)])
    base = F.lower(F.trim("lang"))
    d = documents.select("doc_id", "text", base.alias("l")).where(F.length("text").between(SHORTEST, LONGEST) & F.col("l").isNotNull())
    d = d.withColumn("l", F.coalesce(F.try_element_at(names, F.col("l")), F.try_element_at(names, F.split("l", "[-_]")[0]))).where("l is not null")
    d = d.withColumn("h", F.xxhash64("doc_id", "text"))
    # the smallest hashes of each language, kept map-side; texts follow for those only
    hashes = d.groupBy("l").agg(F.min_by("h", "h").alias("lo"), F.count("*").alias("n"))
    share = {r.l: r.n for r in hashes.select("l", "n").collect()}
    cond = F.lit(False)
    for lang, n in sorted(share.items()):
        # hashes are uniform: the part below this bound holds about twice the sample
        bound = -(2**63) + int(2**64 * min(1.0, 2.0 * SAMPLE / n)) - 1
        cond = cond | ((F.col("l") == lang) & (F.col("h") <= F.lit(min(bound, 2**63 - 1))))
    rows = d.where(cond).select("l", "h", "text").collect()
    by: dict[str, list] = defaultdict(list)
    for r in rows:
        by[r.l].append((r.h, r.text))
    return [(k, t) for k, v in by.items() for _, t in sorted(v)[:SAMPLE]]


_WORKER: dict[bytes, Classifier] = {}


def _segment(dicts: dict[str, bytes]):
    key = hashlib.sha256(repr(sorted(dicts.items())).encode()).digest()

    def make():
        c = _WORKER.get(key)  # a worker keeps it for its next task
        if c is None:
            _WORKER.clear()
            _WORKER[key] = c = Classifier(dicts)

        def fn(cols: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("doc_id", "lang", "segments", "langs", "confidence")}
            texts = [parts(t) if t else [] for t in cols["text"]]
            c.learn(dict.fromkeys(p for ps in texts for p in ps))
            known = c.memo
            for doc, lang, ps in zip(cols["doc_id"], cols["lang"], texts):
                got = [(k, *g) for k, p in enumerate(ps) if (g := known[p])[0]]
                if got:
                    out["doc_id"].append(doc)
                    out["lang"].append(label_of(lang))
                    out["segments"].append([g[0] for g in got])
                    out["langs"].append([g[1] for g in got])
                    out["confidence"].append([g[2] for g in got])
            return out

        return fn

    return make


_SCHEMA = "doc_id bigint, lang string, segments array<int>, langs array<string>, confidence array<double>"


def segments(documents: DataFrame) -> DataFrame:
    """doc_id, segment (its number among the parts of the text), lang and confidence of every sentence whose language is certain."""
    dicts = dictionaries(sample_of(documents))
    rows = batches(documents.select("doc_id", "lang", "text"), _segment(dicts), _SCHEMA)
    return rows.select("doc_id", F.explode(F.arrays_zip("segments", "langs", "confidence")).alias("s")).select(
        "doc_id", F.col("s.segments").alias("segment"), F.col("s.langs").alias("lang"), F.col("s.confidence").alias("confidence"))


def labels(documents: DataFrame) -> DataFrame:
    """doc_id, label (as a code), languages found, the most frequent one and its confidence."""
    dicts = dictionaries(sample_of(documents))
    rows = batches(documents.select("doc_id", "lang", "text"), _segment(dicts), _SCHEMA)
    return rows.select(
        "doc_id", F.col("lang").alias("label"), F.array_sort(F.array_distinct("langs")).alias("found"),
        F.expr("array_max(transform(array_distinct(langs), l -> struct(size(filter(langs, x -> x = l)) as n, l as lang))).lang").alias("main"),
        F.expr("aggregate(confidence, 0D, (a, x) -> a + x) / size(confidence)").alias("confidence"),
    )


def found(documents: DataFrame) -> DataFrame:
    """p10_found: languages of documents whose label is missing or wrong, or that mix languages."""
    d = labels(documents).where("doc_id is not null")
    wrong = F.col("label").isNull() | (F.size("found") > 1) | ~F.array_contains("found", F.col("label"))
    return d.where(wrong).select("doc_id", F.explode("found").alias("lang")).distinct()
