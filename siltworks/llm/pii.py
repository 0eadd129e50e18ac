"""Problem 1: personal data in free text, found and replaced by typed placeholders.

A semi-Markov conditional random field reads each line: candidate segments (bounded in
length) are scored by features of the whole span (its form, digits, words around it, how it
lies in the line), and dynamic programming over segments chooses boundaries and types
jointly. Weights are trained by gradient ascent on the log-likelihood of lines written by
the small grammar in this module, with a fixed seed; training takes a second or two on the
driver, and the model is a few hundred numbers.

Text outside all candidate segments has only the label "none" with score 0, so lines
without candidates cost one pass of a regular expression.

Defined results: null, empty and blank contents have no rows and are returned as they are;
redelivered rows give the same rows; ties between segmentations go to the earlier, longer
segment.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from functools import cache
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches

TYPES = ("email", "phone", "national_id", "address", "name")
PLACEHOLDER = {t: f"<{t.upper()}>" for t in TYPES}


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    features: tuple[str, ...]


# --- candidate segments -------------------------------------------------------------------

_AT = r"(?:@|＠|%40|\s*[\[({<]\s*(?:at|AT|arroba|ät|chez|@)\s*[\])}>]\s*|\s+(?:AT|arroba)\s+)"
_DOT = r"(?:\.|\s*[\[({]\s*(?:dot|DOT|punkt|punto|point)\s*[\])}]\s*|\s+(?:dot|DOT|punkt|punto)\s+)"
_EMAIL = re.compile(rf"(?<![\w.+@%/\-])(?P<user>\w[\w.+\-]*?)(?P<at>{_AT})(?P<host>\w[\w\-]*(?:{_DOT}\w[\w\-]*)+)")
_AT_WORD = r"[\s\[({<](?:at|arroba|chez|ät)[\s\])}>]"
_HAS_AT_WORD = re.compile(rf"(?i){_AT_WORD}")
_EMAIL_WORDS = re.compile(r"(?<![\w.+@%/\-])(?P<user>\w[\w.+\-]*)(?P<at>\s+at\s+)(?P<host>\w[\w\-]*(?:\s+(?:dot|punkt|punto)\s+\w[\w\-]*)+)")
_PHONE = re.compile(r"(?<![\w.+:#/\-])(?:\+|\()?\d(?:[\d ().\-/]|(?<=\d)\s(?=\(?\d)){5,22}\d(?:\s*(?:ext|x|Durchwahl|poste|wew|доб)\.?\s*\d{1,5})?(?![\w@]|[.\-:]\d)")
_ID = re.compile(
    r"(?<![\w.+:#/\-])(?:"
    r"\d{3}[ \-]\d{2}[ \-]\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]|[XYZ]?\-?\d{7,8}\-?[A-Z]|[A-Z]{1,3} ?\d{6,9}|[12] ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?|"
    r"\d{3}\.\d{3}\.\d{3}\-\d{2}|[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z]|\d{2} ?\d{3} ?\d{3} ?\d{3}|\d{17}[\dXx]|\d{9,13}|\d{4} \d{6}|\d{4} \d{4} \d{4}|[A-Z0-9]{9}(?=\b)"
    r")(?![\w@]|[.\-]\d)"
)
_UP = r"[^\W\d_a-zß-öø-ÿ]"
_CAPITAL = "[A-ZÀ-ÖØ-ÞĀ-ŽА-ЯЁ]"
_CAP = rf"{_CAPITAL}[^\W\d_]*(?:['’\-][^\W\d_]+)*"
_PLACE = rf"{_CAP}(?:(?:[ \-]|\-(?:sur|de|am|an der|les|la)\-)(?:de |del |am |an der |la |sur )?{_CAP}){{0,3}}"
_WAY_EN = r"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Boulevard|Blvd|Terrace|Drive|Dr|Court|Ct|Way|Close|Square|Sq|Row|Crescent|Hill|Walk|Parkway)"
_ADDRESS = re.compile(
    rf"(?<![\w/\-])(?:"
    rf"(?:(?:Flat|Apt|Apartment|Unit|Suite|Room)\.? ?\w+, ?)?\d+\w? (?:{_CAP} ){{1,4}}{_WAY_EN}\b\.?(?:,? (?:Flat|Apt|Unit|Suite)\.? ?\w+)?, {_PLACE}(?:, [A-Z]{{2,3}}(?: ?\d[\w\-]*)?(?: \d\w{{2}})?| \d{{4,5}})?"
    rf"|\d+\w?(?: bis| ter| quater)?,? (?:rue|avenue|boulevard|bd|place|chemin|impasse|allée|quai|route|cours)\b [^,\n;]{{2,40}}, \d{{5}} {_PLACE}"
    rf"|(?:{_CAP}(?:weg|straße|strasse|gasse|platz|allee|ufer|ring|damm|str\.)|(?:Am|An der|An den|Zum|Zur|Im|In der|Auf der|Alte|Alter|Neue) {_CAP}(?: {_CAP})?) \d+ ?\w?, \d{{4,5}} {_PLACE}"
    rf"|(?:Calle|C/|Avenida|Avda\.?|Plaza|Paseo|Camino|Rua|Travessa|Via|Viale|Piazza|Corso)\b [^,\n;]{{2,40}},? \d+\w?(?:, (?!\d{{4}})[^,\n;]{{1,10}}){{0,2}}, \d{{4,5}}(?:\-\d{{3}})? {_PLACE}"
    rf"|(?:(?:ul|al|os|pl)\.? )?{_CAP}(?: {_CAP})? \d+\w?(?:/\d+\w?)?(?: m\. ?\d+)?, \d\d\-\d{{3}} {_PLACE}"
    rf"|{_CAP}(?:straat|laan|weg|plein|kade|gracht|dijk|steeg) \d+ ?\w?, \d{{4}} ?[A-Z]{{2}} {_PLACE}"
    rf"|(?:ул|улица|просп|проспект|пер|наб|пл)\.? [^,\n;]{{2,30}}, ?(?:д\. ?)?\d+\w?(?:, ?(?:кв|корп|стр)\. ?\d+)*, ?(?:г\. ?)?(?:\d{{6}},? )?{_PLACE}"
    rf")"
)
_WORD = r"[^\W\d_]+(?:['’\-][^\W\d_]+)*"
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Hr|Fr|Sr|Sra|Srta|Don|Doña|M|Mme|Mlle|Sig|Dott|Pan|Pani|г-н|г-жа|господин|госпожа|Dhr|Mevr)"
_NAME = re.compile(
    rf"(?<![\w@.\-/`'’])(?:"
    rf"(?P<titled>{_TITLE}\.?\s(?:{_TITLE}\.?\s)?(?:{_CAP}\s|[^\W\d_]\.\s?)?{_CAP})"
    rf"|(?P<initial>(?:[^\W\d_a-zа-я]\.\s?){{1,2}}{_CAP})"
    rf"|(?P<turned>{_CAP},\s{_CAP})"
    rf"|(?P<plain>{_CAP}(?:\s(?:[^\W\d_a-zа-я]\.|van|von|de|da|di|del|der|la|el|{_CAP})){{0,2}}\s{_CAP})"
    rf")(?![\w@`(]|[.\-_/]\w)"
)
_LOWER_AFTER = r"\b(?:talk(?:ed|ing)? (?:to|with)|spoke (?:to|with)|spoken (?:to|with)|met with|ask(?:ed)?|ping(?:ed)?|emailed|reported by|written by|found by|cc|thanks to|assignee|author|reporter|maintainer|customer)\b"
#: Parts of those words of which a line with one has at least one.
_CUE_WORDS = ("talk", "spoke", "met with", "ask", "ping", "emailed", "ed by", "en by", "found by", "cc", "thanks to", "assignee", "author", "reporter", "maintainer", "customer")
_LOWER_CUE = re.compile(rf"(?i){_LOWER_AFTER}[:=,\s\"]*")
_LOWER = re.compile(rf"(?P<lower>{_WORD}\s{_WORD})(?![\w@`(]|[.\-_/]\w)")
_CJK_AFTER = "さん|様|氏|先生|女士|小姐"
_CJK_NAME = re.compile(rf"(?P<cjk>[一-鿿]{{2,4}}|[゠-ヿ・]{{4,12}})(?={_CJK_AFTER})")

_TWO_WORDS = re.compile(r"[^\W\d_]\.?,?\s[^\W\d_]")

_CUES = {
    "tel": re.compile(r"(?i)(?:\btel(?:efon[oe]?|éfono|éphone|efone)?\b|phone|\bcall\b|\bmobile\b|\bcell\b|\bfax\b|rufen sie|anrufen|\bnummer\b|my number|llam[ea]|appel|ligue|zadzwo|звон|тел|電話|电话|support line|hotline|whatsapp|sms)[^\n]{0,36}$"),
    "id": re.compile(
        r"(?i)(?:\bdni\b|\bnif\b|\bnie\b|\bnino\b|\bni (?:number|no)\b|national insurance|\bssn\b|soc(?:ial|\.)? ?sec(?:urity|\.)?|sécurité sociale|\bnir\b|reisepass|passport|passeport|pasaporte|passaporte|paszport|паспорт|\bid[- ]?card|identity card|ausweis|documento|dowód|carte d.identité|steuer|\btax (?:id|number)|\btin\b|\bpesel\b|codice fiscale|\bcpf\b|\bbsn\b|\bинн\b|снилс|curp|\brfc\b|身份证|マイナンバー)[^\n]{0,24}$"
    ),
    "numbers": re.compile(r"(?i)(?:order|lot|version|\bv|build|bytes?|took|\bline|row|tile|listens|port|segfault|commit|uuid|ticket|issue|invoice no|serial|sku|isbn|ip|at 0x|hash|read|offset|revision|release|\bseed|timestamp|size|count|id=)[^\n\w]{0,4}(?:no\.?|nr\.?|number|#)?[^\n\w]{0,3}$"),
    "mail": re.compile(r"(?i)(?:contact|reach|mail|send|e-?mail|reporter|user|signed-off|co-authored|assignee|from|to|cc|<|\(|/)[^\n]{0,24}$"),
    "git": re.compile(r"(?i)(?:clone|remote|git|ssh|installed|install|npm|pip|decorated|import|from '|require|package|@)[^\n]{0,16}$"),
    "ship": re.compile(r"(?i)(?:ship|deliver|send|address|anschrift|adresse|dirección|invoice|geocoder|lives? at|office|visit|adres|indirizzo|endereço|адрес)[^\n]{0,48}$"),
    "person": re.compile(r"(?i)(?:co-authored[- ]by|signed-off-by|reviewed-by|acked-by|reported[- ]by|tested-by|suggested-by|thanks to|thank you,?|author|assignee|reporter|owner|customer|client|colleague|named?|written by|found by|fixed by|\bas|\bcc|talked to|spoke (?:to|with)|talk to|asked?|ping|contact|regards|dear|hi|hello|patient|user)[,:;=\s\"'(]*$"),
    "product": re.compile(r"(?i)\b(?:the|a|an|our|this|release|project|repo|module|package|line \d+,|theme|product|class|team|branch|feature|see)\s*$"),
}
_GREETING = re.compile(r"(?i)^\W*(?:mit freundlichen|viele|beste|best|kind|warm|many|thanks|thank you|regards|cheers|sincerely|yours|saludos|un saludo|atentamente|cordialement|bien à vous|cordiali|saluti|distinti|atenciosamente|abraços|met vriendelijke|groeten|pozdrawiam|z poważaniem|с уважением|спасибо|よろしく|此致)[^\n]{0,30}$")
_AFTER = {
    "mailish": re.compile(r"^\s*[(<\[/,]\s*(?:mailto:)?[^\s@]{1,60}(?:@|%40|\s?[\[(]?\s?(?:at|AT)\s?[\])]?\s?)\w"),
    "did": re.compile(r"^,?\s(?:who|wrote|said|says|sees|found|bisected|reported|asked|confirmed|thinks|has|is|was|about|for|mentioned|suggested|hat|ha|a|qui|який|который)\b"),
    "product": re.compile(r"(?i)^\s(?:theme|release|version|team|project|server|api|cluster|module|edition|build|plugin|release|cache|layer)\b"),
    "quote": re.compile(r"^[\"'”]"),
    "colonpath": re.compile(r"^:[\w/]"),
    "call": re.compile(r"^\s?[(\[]"),
}
#: Words that begin a sentence or name things more often than people.
_COMMON = frozenset(
    "the a an this that these those it we you they our your their its each every no not all any some what when where why how who which please since with from for to of on in at and or but if as by is are was were to be do does did there here after before "
    "der die das ein eine dieser jeder unser wir ich sie es mir mit nach seit zum wenn was wo wie la le les un une des ce cette chaque notre nous je il elle el los las una este esta cada nuestro no se para desde o os as um uma cada nosso lo gli il ogni questo questa het de een elke onze dit wij ik "
    "bug feature main street fix add remove update release version build line tile see invoice contact reported signed ship call test row form error note todo warning issue support traceback clone install started overview usage setup installation introduction examples summary notes configuration background "
    "more than about again twice one two all other same late support everyone someone somebody nobody people team them him her me us it's yesterday today now then here once only just still also many few same such own way users staff north south east west northern southern old new arid".split()
)


_DIGIT = re.compile(r"\d")


def _shape(v: str) -> str:
    return re.sub(r"\d+", lambda m: str(len(m[0])), re.sub(r"[A-Z]+", "A", v))


def _cues(left: str, right: str, names: tuple[str, ...]) -> list[str]:
    out = [f"cue:{n}" for n in names if _CUES[n].search(left)]
    return out + [f"after:{n}" for n, p in _AFTER.items() if p.search(right)]


def candidates(line: str, before: str) -> list[Span]:
    """Candidate segments of a line; before is the last line that isn't blank."""
    out: list[Span] = []
    bare = line.strip(" \t\r.,;*>-")
    if "@" in line or "%40" in line or "＠" in line or _HAS_AT_WORD.search(line):
        for m in [*_EMAIL.finditer(line), *_EMAIL_WORDS.finditer(line)]:
            at, host, user = m["at"], m["host"], m["user"]
            left, right = line[max(0, m.start() - 40): m.start()], line[m.end(): m.end() + 40]
            f = ["email", "at:" + ("sign" if at in "@＠" else "code" if at == "%40" else "bracket" if re.search(r"[\[({<]", at) else "word")]
            f += ["dots:word"] if re.search(r"(?i)dot|punkt|punto", host) else []
            f += ["user:git"] if user.lower() in ("git", "hg", "svn", "ssh") else []
            f += ["host:number"] if re.match(r"v?\d+(?:\.|$)", host) or not re.search(r"[a-zA-Z]{2,}\W*$", host) else []
            f += ["scoped"] if re.search(r"@[\w\-]*/?$", left) else []
            f += ["remote"] if re.search(r"://$", left) else []
            out.append(Span(m.start(), m.end(), "email", tuple(f + _cues(left, right, ("mail", "git")))))
    n_digits = len(_DIGIT.findall(line))
    if n_digits:
        for m in _PHONE.finditer(line) if n_digits >= 7 else ():
            v = m[0]
            digits = sum(c.isdigit() for c in re.sub(r"(?i)(?:ext|x|durchwahl|poste|wew|доб).*", "", v))
            if not 7 <= digits <= 16:
                continue
            left, right = line[max(0, m.start() - 60): m.start()], line[m.end(): m.end() + 40]
            f = ["phone", f"d:{digits}", "plus" if v[0] == "+" else "paren" if v[0] == "(" else "zero" if v[0] == "0" else "digit"]
            f.append("groups:" + str(min(6, len(re.findall(r"\d+", v)))))
            f += ["dotted"] if re.fullmatch(r"\+?\d+(?:\.\d+)+", v) else []
            f += ["ipish"] if re.fullmatch(r"\d{1,3}(?:\.\d{1,5}){3}", v) else []
            f += ["date"] if re.match(r"\(?(?:19|20)\d\d[\-./]\d\d[\-./]\d\d", v) else []
            f += ["solid"] if v.isdigit() else []
            f += ["ext"] if re.search(r"[a-z]", v) else []
            out.append(Span(m.start(), m.end(), "phone", tuple(f + [c for c in _cues(left, right, ("tel", "id", "numbers"))])))
        for m in _ID.finditer(line):
            v = m[0]
            left, right = line[max(0, m.start() - 48): m.start()], line[m.end(): m.end() + 40]
            if not _DIGIT.search(v):
                continue
            f = ["national_id", "shape:" + _shape(v)]
            cues = _cues(left, right, ("id", "tel", "numbers"))
            f += ["form:ssn"] if re.fullmatch(r"\d{3}[ \-]\d{2}[ \-]\d{4}", v) else []
            out.append(Span(m.start(), m.end(), "national_id", tuple(f + cues)))
        for m in _ADDRESS.finditer(line) if "," in line else ():  # every form has a comma
            left, right = line[max(0, m.start() - 60): m.start()], line[m.end(): m.end() + 40]
            f = ["address", "post" if re.search(r"\d[\w\-]*\s*\D*$|[A-Z]{2} \d", m[0][8:]) else "place"]
            f += ["whole"] if m[0].strip() == bare else []
            out.append(Span(m.start(), m.end(), "address", tuple(f + _cues(left, right, ("ship", "product")))))
    if _TWO_WORDS.search(line):
        for m in _NAME.finditer(line):
            if not all(w[0].isupper() for w in re.findall(r"[^\W\d_]{3,}", m[0]) if w not in ("von", "van", "del", "der")):
                continue
            out.append(_name(line, before, bare, m.start(), m.end(), m.lastgroup))
            if m.lastgroup == "plain":  # its last two words, too: "Reviewer Ana Lima"
                words = list(re.finditer(r"\S+", m[0]))
                if len(words) > 2:
                    out.append(_name(line, before, bare, m.start() + words[-2].start(), m.end(), "plain"))
                    out.append(_name(line, before, bare, m.start(), m.start() + words[1].end(), "plain"))
        low = line.lower()
        for c in _LOWER_CUE.finditer(line) if any([w in low for w in _CUE_WORDS]) else ():
            m = _LOWER.match(line, c.end())
            if m and m[0] == m[0].lower():
                out.append(_name(line, before, bare, m.start(), m.end(), "lower"))
        for m in _CJK_NAME.finditer(line) if not line.isascii() else ():
            out.append(_name(line, before, bare, m.start(), m.end(), "cjk"))
    return out


def _name(line: str, before: str, bare: str, a: int, b: int, form: str) -> Span:
    v = line[a:b]
    left, right = line[max(0, a - 60): a], line[b: b + 70]
    words = re.findall(r"[^\W_]+", v)
    f = ["name", "form:" + form, f"words:{len(words)}"]
    f += ["whole"] if v == bare else []
    f += ["signed"] if v == bare and _GREETING.match(before) else []
    f += ["common"] * any(w.lower() in _COMMON for w in words)
    f += ["caps"] if all(w.isupper() for w in words) else ["capmix"] if any(w.isupper() and len(w) > 2 for w in words) else []
    f += ["camel"] if any(re.search(r"[a-zа-я][A-ZА-Я]", w) and not re.match(r"Mc|Mac|De|Di|Van|O", w) for w in words) else []
    f += ["first"] if not left.strip(" \t*->#") else []
    f += ["heading"] if re.match(r"\s*(?:#+|\*\*)", line) else []
    cues = _cues(left, right, ("person", "product"))
    if form == "lower" and re.search(r"(?i)\b(?:talked|spoke|spoken|met|talk|pinged|asked)\s(?:to\s|with\s)?$", left):
        cues.append("cue:spoke")
    if form == "turned":
        f += ["turned:caps"] if words[0].isupper() and len(words[0]) > 1 else []
    return Span(a, b, "name", tuple(f + [c if form != "lower" else c + "|lower" for c in cues]))


# --- the model ----------------------------------------------------------------------------


def features(s: Span) -> list[str]:
    """Features of a segment; those of its form are tied with the cues around it."""
    kind, rest = s.features[0], s.features[1:]
    form = next((f for f in rest if f.startswith(("form:", "at:", "shape:"))), "")
    cues = [f for f in rest if f.startswith(("cue:", "after:"))]
    out = [kind] + [f"{kind}|{f}" for f in rest]
    out += [f"{kind}|{form}|{c}" for c in cues]
    if not cues:
        out.append(f"{kind}|{form}|alone" + ("|whole" if "whole" in rest else ""))
    return out


class Model:
    """Scores of segments and of neighbouring labels."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.w = weights

    def score(self, s: Span) -> float:
        return sum(self.w.get(f, 0.0) for f in features(s))

    def step(self, label: str, kind: str) -> float:
        """Score of a segment of a kind after one with that label."""
        return self.w.get(f"next|{label}|{kind}", 0.0)

    def segment(self, line: str, before: str) -> list[Span]:
        """The best segmentation by dynamic programming over segment ends and labels (semi-Markov Viterbi)."""
        cand = candidates(line, before)
        if not cand:
            return []
        points, at, by_end = lattice(cand)
        best: list[dict[str, tuple[float, Span | None, tuple[int, str] | None]]] = [{} for _ in points]
        best[0]["none"] = (0.0, None, None)
        for k in range(1, len(points)):
            for label, (v, _, _) in best[k - 1].items():  # text between
                to = carried(label, points[k] - points[k - 1])
                if v > best[k].get(to, (-math.inf,))[0]:
                    best[k][to] = (v, None, (k - 1, label))
            for s in by_end.get(points[k], ()):
                w, j = self.score(s), at[s.start]
                for label, (v, _, _) in best[j].items():
                    v += w + self.step(label, s.kind)
                    if v > best[k].get(s.kind, (-math.inf,))[0]:
                        best[k][s.kind] = (v, s, (j, label))
        label = max(best[-1], key=lambda x: (best[-1][x][0], x))
        place: tuple[int, str] | None = (len(points) - 1, label)
        out = []
        while place:
            _, s, place_before = best[place[0]][place[1]]
            if s:
                out.append(s)
            place = place_before
        return out[::-1]


#: Characters of text over which a segment still speaks for the next one ("Name <mailbox>").
GAP = 4


def carried(label: str, gap: int) -> str:
    """The label after a stretch of text."""
    return label if gap <= GAP else "none"


def lattice(cand: list[Span]) -> tuple[list[int], dict[int, int], dict[int, list[Span]]]:
    """Places where segments begin and end, their numbers, and the segments by their end."""
    points = sorted({0, *(s.start for s in cand), *(s.end for s in cand)})
    by_end: dict[int, list[Span]] = defaultdict(list)
    for s in sorted(cand, key=lambda s: (s.end, s.start, s.kind)):
        by_end[s.end].append(s)
    return points, {p: k for k, p in enumerate(points)}, by_end


def steps(segments: list[Span]) -> list[tuple[str, str]]:
    """(label before, kind) of each segment of a segmentation, in order."""
    out, label, end = [], "none", 0
    for s in segments:
        out.append((carried(label, s.start - end), s.kind))
        label, end = s.kind, s.end
    return out


def _expected(cand: list[Span], feats: list[list[str]], w: dict[str, float]) -> tuple[list[float], dict[str, float]]:
    """Probability of each candidate and expected number of each step under the field, by the forward-backward algorithm over places and labels."""
    e = {id(s): math.exp(max(-30.0, min(30.0, sum([w[f] for f in fs if f in w])))) for s, fs in zip(cand, feats)}
    t = lambda label, kind: math.exp(w[f]) if (f := f"next|{label}|{kind}") in w else 1.0
    points, at, by_end = lattice(cand)
    fwd: list[dict[str, float]] = [defaultdict(float) for _ in points]
    fwd[0]["none"] = 1.0
    for k in range(1, len(points)):
        for label, v in fwd[k - 1].items():
            fwd[k][carried(label, points[k] - points[k - 1])] += v
        for s in by_end.get(points[k], ()):
            fwd[k][s.kind] += e[id(s)] * sum(v * t(label, s.kind) for label, v in fwd[at[s.start]].items())
    total = sum(fwd[-1].values())
    bwd: list[dict[str, float]] = [{} for _ in points]
    bwd[-1] = dict.fromkeys(fwd[-1], 1.0)
    by_start: dict[int, list[Span]] = defaultdict(list)
    for s in cand:
        by_start[s.start].append(s)
    each, moves = {id(s): 0.0 for s in cand}, defaultdict(float)
    for k in range(len(points) - 2, -1, -1):
        for label, v in fwd[k].items():
            b = bwd[k + 1].get(carried(label, points[k + 1] - points[k]), 0.0)
            for s in by_start.get(points[k], ()):
                go = e[id(s)] * t(label, s.kind) * bwd[at[s.end]].get(s.kind, 0.0)
                b += go
                p = v * go / total
                each[id(s)] += p
                moves[f"next|{label}|{s.kind}"] += p
            bwd[k][label] = b
    return [each[id(s)] for s in cand], moves


# --- training lines -----------------------------------------------------------------------

_GIVEN = "Anna Bruno Clara David Elena Fabian Greta Henrik Irina Jakob Karin Louis Marta Nils Olga Paul Rosa Stefan Tania Ulrich Vera Walter Анна Пётр Ирина Юрий".split()
_FAMILY = "Berger Castillo Dubois Eriksen Fontana Gruber Hansen Ivanov Jansen Kowalski Lindqvist Moreau Novak Oliveira Petersen Quintero Rossi Schuster Tanaka Ulrichsen Verbeek Weber Иванов Петрова Смирнов Орлова".split()
_CODE = "loader parser cacheKey flushAll merge_rows scanTable readBuffer openPipe".split()
_THINGS = "Silver Falcon|Granite Peak|Blue Heron|Rapid River|Iron Gate|Quiet Harbor|Copper Field".split("|")
_TEMPLATES = (
    "Signed-off-by: {name} <{email}>|Co-authored-by: {name} <{email}>|Reviewed by {name} ({email})|owner: {name} / {email}|written_by = \"{name}\"|Kudos to {name}, who tracked it down.|thank you {name} for looking into it|{name} wrote earlier that the retry is safe|"
    "{name} <{email}>|{name}, {email}, {phone}|our client {name} can confirm|as {name} said on the call, we wait|I asked {name} and {name2} about the branch|mail from {name} last week|the user {name} has two accounts|"
    "spoke to {lname} this morning|met with {lname} in person|please ping {lname} for access|assignee: {lname}|cc {lname}|cc: {turned}|copied {TURNED} on this|{TURNED} asked for a backport|Found by {titled}|{titled} will call back.|{initial} can reproduce it|the patient {initial} was moved|{name}|{name}|{titled}|"
    "write to {email} for the logs|my address is {email}, thanks|<{email}>|mailto:{email}|two messages reached {email}|{{\"user\": \"{email}\", \"tries\": 3}}|from={email} status=bounced|Kontakt: {email}|send it over to {email}|the account {email} is locked|"
    "phone {phone}|Telefon: {phone}|you can reach us under {phone} until noon|mobile={phone}|ring {phone} before lunch|Fax {phone}|hotline {phone}, ask for the night shift|new number: {phone}|WhatsApp {phone}|tel {phone}|"
    "{id} stays visible in the dump|we should mask {id}|user typed {id} into the wrong box|import column 7 = {id};ok|{id}|validation of {id} returns false|masking misses {id}, see below|"
    "{addr}|deliver to {addr}|home address {addr}|parcel went to {addr} again|our office moved: {addr}|lives at {addr} since May|the map puts {addr} in the sea|postal address: {addr}.|"
    "we ship {thing} on Monday|the {thing} module leaks|upgrade to {thing} {n1}.{n2}|{thing} cluster is down|page {n2} of {thing}|{heading}|### {heading}|**{heading}**|File \"{code}.py\", line {n3}, in {code2}|ask @{code} instead|use @{code}.{code2} here|"
    "git clone git@host.sample.example:x/{code}.git|remote is ssh://git@host.sample.example/x|npm install @org/{code}@{n1}.{n2}.{n1}|pip install {code}=={n1}.{n2}|order {n6}-{n2} of lot {n9}|v{n2}.{n1}.{n3}.{n4} works|nightly {date}.{n4} crashes|read {n10} bytes|offset {n10}, length {n8}|"
    "started {day} 09:14:55, {n2}.{n3} ms|bound to 10.{n3}.{n2}.{n3}:{n5}|trace {n4}b{n3}-7e|reverted in {n4}cd{n5}f|invoice no {n9}|sku {n10}|serial B{n8}|isbn {n10}|before {n1}.{n2}.{n1} it accepted {n3} rows|pid {n5} got signal {n1}|timestamp {n10}|"
    "locks held by {code} are never freed|cc the whole list|asked for a second opinion|pinged support twice|spoke to the auditors|met with nobody|talked to our hosting company|it dies in {code} at host.domain|see notes.txt at mirror.site|reading {code} at boot.cfg|{thing}, {n2} rows|Line {n3}: {heading}"
).split("|")


def _sample(rng: random.Random, template: str) -> tuple[str, list[tuple[str, str]]]:
    """A line and its (kind, text) cases."""
    digits = lambda n: "".join(str(rng.randint(1 if k == 0 else 0, 9)) for k in range(n))
    given, family = rng.choice(_GIVEN), rng.choice(_FAMILY)
    other = f"{rng.choice(_GIVEN)} {rng.choice(_FAMILY)}"
    user = rng.choice((f"{given}.{family}", f"{given}_{family}{rng.randint(1, 99)}", f"{given}{rng.randint(1, 99)}", f"{given[0]}{family}", f"{family}+tag")).lower()
    at = rng.choices(("@", " (at) ", " [at] ", " AT ", "%40"), (6, 1, 1, 2, 1))[0]
    host = rng.choice(("mail.sample.example", "sample.test", "corp.sample.invalid", "kv-sample.example"))
    host = host.replace(".", " dot ") if at in (" AT ", " (at) ") and rng.random() < 0.3 else host
    street, place = rng.choice(("Orchard", "Stone Bridge", "Mill Pond", "Upper Field")), rng.choice(("Eastbrook", "Lower Marsh", "Westham"))
    says, number = rng.choice((
        ("SSN ", f"9{digits(2)}-{digits(2)}-{digits(4)}"), ("ssn=", f"9{digits(2)} {digits(2)} {digits(4)}"), ("soc. sec. ", f"9{digits(2)}-{digits(2)}-{digits(4)}"), ("social security number: ", f"9{digits(2)} {digits(2)} {digits(4)}"),
        ("NINO ", f"QQ {digits(2)} {digits(2)} {digits(2)} C"), ("NI number ", f"QQ{digits(6)}C"), ("National Insurance: ", f"QQ {digits(2)} {digits(2)} {digits(2)} C"), ("DNI ", f"{digits(8)}{rng.choice('KTMB')}"), ("DNI/NIF: ", f"{digits(8)}{rng.choice('KTMB')}"), ("documento ", f"{digits(8)}{rng.choice('KTMB')}"),
        ("passport no. ", f"{rng.choice('CKXZ')}{digits(8)}"), ("Reisepass ", f"{rng.choice('CKXZ')}{digits(8)}"), ("ID card ", f"{rng.choice('CKXZ')}{digits(8)}"), ("PESEL ", digits(11)), ("nr PESEL: ", digits(11)), ("cpf: ", f"{digits(3)}.{digits(3)}.{digits(3)}-{digits(2)}"), ("CPF ", digits(11)),
        ("NIR ", f"1{digits(12)} {digits(2)}"), ("numéro de sécurité sociale ", f"2{digits(12)} {digits(2)}"), ("Steuer-ID ", f"{digits(2)} {digits(3)} {digits(3)} {digits(3)}"), ("tax id ", digits(9)),
    ))
    fill = {
        "name": f"{given} {family}", "name2": other, "lname": f"{given} {family}".lower(), "turned": f"{family}, {given}", "TURNED": f"{family.upper()}, {given}", "titled": f"{rng.choice(('Dr.', 'Prof.', 'Ms.', 'Mr.', 'Frau', 'Herr'))} {family}",
        "initial": f"{given[0]}. {family}", "email": f"{user}{at}{host}",
        "phone": rng.choice((f"+1 (555) 01{digits(1)}-{digits(4)}", f"+44 7700 {digits(6)}", f"+49 30 {digits(5)} {digits(3)}", f"+33.1.99.00.{digits(2)}.{digits(2)}", f"+1555010{digits(4)}", f"(555) 01{digits(1)}-{digits(4)}", f"555-01{digits(2)}", f"0{digits(4)} {digits(3)} {digits(3)}", f"020 {digits(4)} {digits(4)}", f"0049 30/{digits(5)}-{digits(3)}", f"+34 600 000 {digits(3)}", f"01 99 00 {digits(2)} {digits(2)}", f"1-555-010-{digits(4)} ext. {digits(2)}")),
        "id": says + number,
        "addr": rng.choice((f"{digits(2)} {street} {rng.choice(('Street', 'Road', 'Lane', 'Ave.', 'Blvd'))}, {place}, QX 000{digits(2)}", f"Flat {digits(1)}, {digits(2)} {street} Terrace, {place}", f"Gartenweg {digits(2)}b, 00{digits(3)} Unterau", f"Am Alten Tor {digits(2)}, 00{digits(3)} Oberau-Tal", f"{digits(2)} bis rue du Pont Neuf, 00{digits(3)} Mirval-sur-Aude", f"Calle del Pino {digits(2)}, 4º B, 00{digits(3)} Villarta", f"ul. Lipowa {digits(2)}/{digits(1)}, 00-{digits(3)} Zalesie Górne", f"Lipowa {digits(2)}/{digits(2)}, 00-{digits(3)} Zalesie Górne")),
        "thing": rng.choice(_THINGS), "code": rng.choice(_CODE), "code2": rng.choice(("run", "load", "keep")), "heading": rng.choice(("Load ", "Find ", "Merge ", "Getting ")) + rng.choice(_CODE + ["Started", "Results"]),
        "date": f"2024{rng.randint(10, 12)}{rng.randint(10, 28)}", "day": f"2024-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
    }
    fill |= {f"n{k}": digits(k) for k in range(1, 11)}
    kinds = {"name": "name", "name2": "name", "lname": "name", "turned": "name", "TURNED": "name", "titled": "name", "initial": "name", "email": "email", "phone": "phone", "addr": "address"}
    cases = [(kinds[k], fill[k]) for k in re.findall(r"(?<!\{)\{(\w+)\}", template) if k in kinds]
    line = template.format(**fill)
    if "{id}" in template:
        cases.append(("national_id", number))
    if rng.random() < 0.1:
        line = f"{line} More below."
    return line, cases


@cache
def train(n_lines: int = 1400, epochs: int = 20, seed: int = 11) -> tuple[tuple[str, float], ...]:
    """Weights of segments and of steps between them, after gradient ascent on the log-likelihood of n_lines lines of the grammar."""
    rng = random.Random(seed)
    data = []
    for k in range(n_lines):
        line, cases = _sample(rng, _TEMPLATES[k % len(_TEMPLATES)])
        cand = candidates(line, "Best regards," if rng.random() < 0.5 else "text")
        gold = {(k, line.find(t), line.find(t) + len(t)) for k, t in cases}
        if cand:
            is_gold = [(s.kind, s.start, s.end) in gold for s in cand]
            moves = [f"next|{a}|{b}" for a, b in steps(sorted((s for s, g in zip(cand, is_gold) if g), key=lambda s: s.start))]
            data.append((cand, is_gold, [features(s) for s in cand], moves))
    w: dict[str, float] = {t: -1.0 for t in TYPES}
    square: dict[str, float] = {}

    def climb(f: str, d: float) -> None:
        square[f] = q = square.get(f, 1.0) + d * d
        v = w.get(f, 0.0)
        w[f] = v + 0.7 * (d - 0.0005 * v) / math.sqrt(q)

    for _ in range(epochs):
        rng.shuffle(data)
        for cand, gold, feats, moves in data:
            each, expected = _expected(cand, feats, w)
            for p, g, fs in zip(each, gold, feats):
                d = g - p
                if abs(d) > 1e-4:
                    for f in fs:
                        climb(f, d)
            for f in {*moves, *expected}:
                d = moves.count(f) - expected.get(f, 0.0)
                if abs(d) > 1e-4:
                    climb(f, d)
    return tuple(sorted((k, round(v, 4)) for k, v in w.items()))


# --- documents ----------------------------------------------------------------------------

#: What any candidate needs one of, made of the same lists as candidates().
_WORTH = re.compile(rf"[@＠\d]|%40|[^\W\d_](?:\.?,?\s|\.){_CAPITAL}|{_CJK_AFTER}|(?i:{_AT_WORD}|{_LOWER_AFTER})")


def find(text: str, model: Model) -> list[Span]:
    """Personal data of a text; places are in the text."""
    out, at, before = [], 0, ""
    for line in text.split("\n"):
        if _WORTH.search(line):
            out += [s._replace(start=s.start + at, end=s.end + at) for s in model.segment(line, before)]
        if line.strip():
            before = line
        at += len(line) + 1
    return out


def redact(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for s in spans:
        out += [text[at: s.start], PLACEHOLDER[s.kind]]
        at = s.end
    return "".join(out) + text[at:]


def _apply(weights: tuple[tuple[str, float], ...], with_text: bool):
    def make():
        model = Model(dict(weights))

        def fn(c: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"issue_id": [], "types": []} | ({"content": []} if with_text else {})
            for issue, text in zip(c["issue_id"], c["content"]):
                spans = find(text, model) if text else []
                if spans or with_text:
                    out["issue_id"].append(issue)
                    out["types"].append([s.kind for s in spans])
                    if with_text:
                        out["content"].append(redact(text, spans) if spans else text)
            return out

        return fn

    return make


def redacted(issues: DataFrame) -> DataFrame:
    """issue_id, types (of each placeholder, in order) and content of each row."""
    return batches(issues.select("issue_id", "content"), _apply(train(), True), "issue_id bigint, types array<string>, content string")


def found(issues: DataFrame) -> DataFrame:
    """p1_found: issue_id and pii_type, distinct."""
    rows = batches(issues.select("issue_id", "content"), _apply(train(), False), "issue_id bigint, types array<string>")
    return rows.where("issue_id is not null").select("issue_id", F.explode("types").alias("pii_type")).distinct()
