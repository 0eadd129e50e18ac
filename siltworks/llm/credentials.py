"""Problem 5: credentials in source code and configuration, found with their place and made unreadable.

A keyword automaton passes over each content once; only lines on which it stops are read
with regular expressions: formats of issuers, logins in URLs and connection strings, named
values, calls, comments, encoded logins and private keys. A match must then hold up to the
structure of its kind (alphabet, length, checksum or decoded form, mix of characters). In
files that their path tells to be configuration, every line is read, as logins there stand
without a keyword. Redaction keeps the length, the issuer's prefix and the alphabet of a match
(hexadecimal stays so, letters keep case and script), so that quotes, escapes, line ends and
the code around them stay as they were.

Every pattern is linear in its line: what follows or precedes a keyword is read once, without
going back over it, so that a minified file of one line is no harder than any other.

Defined results: null and empty content has no rows; a null path only means that the file
isn't known as configuration; a BEGIN without a body, or with code before its END, is no key; redelivered rows (same blob_id and content) give the same rows.
"""

from __future__ import annotations

import base64
import binascii
import re
import unicodedata
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import batches


class Hit(NamedTuple):
    start: int
    end: int
    kind: str


#: Words and prefixes that every rule below needs at least one of, in lower case.
KEYWORDS = (
    "private key", "akia", "asia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "npm_", "xox", "sk_live_", "sk_test_", "rk_live_", "rk_test_", "aiza", "eyj",
    "sg.", "pypi-", "hf_", "dop_v1_", "shpat_", "shpca_", "shppa_", "shpss_", "://", "pass", "pw", "mot de", "contrase", "senha", "hasło", "wachtwoord", "пароль", "パスワード", "密码",
    "secret", "token", "apikey", "api_key", "api-key", "api key", "hmac", "auth", "login", "log in", "log_in", "logon", "log_on", "session", "dial", "new_client", "open", "credential", "creds", "basic", "bearer", "curl", "connect", "sign", "account", "user",
    *(f"{word}{mark}key" for word in ("access", "encryption", "private", "client", "master", "shared", "webhook", "service", "license", "deploy") for mark in ("", "_", "-")),
)
#: Letters that patterns without case take for others, but lower() doesn't.
_ALIKE = str.maketrans("İıſᲂ", "iisо")
_MARK = re.compile(r"-----(BEGIN|END) ((?:RSA |EC |DSA |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY(?: BLOCK)?)-----")
_PEM_RUN = re.compile(r"[A-Za-z0-9+/]{24,}")
#: Line ends of a key's body, also as escapes; what else stands around its lines (quotes, signs of comments and of joined strings); and header lines.
_PEM_END = re.compile(r"\r\n?|\n|\\+r|\\+n|&#(?:10|13|x[aAdD]);|%0[aAdD]|<br ?/?>")
_PEM_AROUND = " \t\"'`\\,;+|#*/>.()&[]"
_PEM_LINE = re.compile(r"[A-Za-z0-9+/=]*")
_PEM_HEAD = re.compile(r"(?:Proc-Type|DEK-Info|Version|Comment|Charset|Hash|MessageID|Key-Info): ?[^\"'`]*")
#: Formats of issuers, as they publish them: prefix, alphabet and length.
ISSUERS = (
    ("aws_key", r"(?:AKIA|ASIA)[0-9A-Z]{16}"),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36}"),
    ("forge_token", r"github_pat_[A-Za-z0-9_]{60,90}"),
    ("forge_token", r"glpat-[A-Za-z0-9_\-]{20,}"),
    ("package_token", r"npm_[A-Za-z0-9]{36}"),
    ("package_token", r"pypi-[A-Za-z0-9_\-]{40,}"),
    ("chat_token", r"xox[abeoprs]-[A-Za-z0-9\-]{20,}"),
    ("payment_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    ("cloud_key", r"AIza[A-Za-z0-9_\-]{35}"),
    ("mail_key", r"SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{30,}"),
    ("model_token", r"hf_[A-Za-z0-9]{30,}"),
    ("cloud_token", r"dop_v1_[0-9a-f]{64}"),
    ("shop_token", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}"),
    ("jwt", r"eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{16,}"),
)
_ISSUED_KINDS = frozenset(kind for kind, _ in ISSUERS)
_ISSUED = re.compile(r"(?<![A-Za-z0-9_\-+/])(?:" + "|".join(f"(?P<i{k}>{p})" for k, (_, p) in enumerate(ISSUERS)) + r")(?![A-Za-z0-9_+/])")
_URL = re.compile(r"(?<=[\w+.\-])://([^\s/:@\"'<>]*):([^\s/\"'<>]{3,}?)@[\w\[.\-]")
_CONNECT = re.compile(r"(?i)(?:^|[\s;\"'&?])(?:password|pwd|passwd|pass|accountkey|sharedaccesskey)\s*=\s*([^\s;\"'&]{4,})")
#: Read on text in lower case, as that is faster than a pattern without case.
_NAMED = re.compile(
    r"""(?x)
    (?P<name> pass(?:word|wd|phrase|wort|code)? | pwd | (?<![a-z])pw | secret[_\-]?key | (?:signing|client|webhook|app|shared|master)[_\-]?secret | secret | token
        | (?:api|access|hmac|signing|encryption|private|account|client|session|master|shared|auth|webhook|service|license|deploy)[_\-]?key | credentials? | contraseña | senha | hasło | пароль | mot_de_passe | wachtwoord )
    ["'`\]]*+ \s*+ (?:\)\s*+)? (?: : \s*+ (?:[&\w<>\[\]']{1,80}(?:\s+\w{1,80})?) \s* = | := | => | = | : | > | ,(?=\s*["'`]) | (?<=\s)(?=["'`]) ) \s*+
    (?: [rbu]? (?P<q>\"\"\"|\'\'\'|["'`]) (?P<quoted>(?:\\.|(?!(?P=q)).)*+) | (?P<bare>[^\s"'`<>;,]++) )
    """
)
#: The rest of a name before the word that _NAMED begins with; names are looked at over so many characters.
_BEFORE, NAME = re.compile(r"[\w.\-]*\Z"), 200
_ENCODED = re.compile(r"(?i)(?:\bbasic\s++|(?:auth\w{0,80}|authorization|basic|login|credentials?)[\"'`\]]*+\s*+(?::\s*+[&\w]{1,80}\s*=|:=|=>|=|:|>|(?<=\s)(?=[\"']))\s*+[\"'`]?(?:basic\s++)?)([A-Za-z0-9+/]{8,}+={0,2}+)(?![A-Za-z0-9+/=])")
_CALL = re.compile(r"\b(\w++)\s*+\(([^()]*+)\)")
_CALLED = re.compile(r"(?i)log_?in|log_?on|sign_?in|connect|auth|session|passw|credential|dial|\A(?:new_client|open)\Z")
_STRING = re.compile(r"""(["'`])((?:\\.|(?!\1).)*)\1""")
_CURL = re.compile(r"(?<=\s)(?:-u|--user)[\s=]++[\"']?([^\s:\"']++):([^\s\"']{4,})")
_BEARER = re.compile(r"(?i)\bbearer\s+([A-Za-z0-9_\-.+/=]{16,})")
_SAID = re.compile(
    r"(?i)\b(?:pass(?:word|wd|phrase|wort)?|pwd|pw|mot de passe|contraseña|senha|hasło|wachtwoord|пароль|secret|token|api key)\b(?:\s+(?:for|of|to|für|pour)\s+\S+)?\s*(?:\s(?:was|is|are|war|ist|est|était|es|era|é|to|jest|был|=)|:|=)\s*[\"'`]?([^\s\"'`,;]{6,})"
)
_SAID_BARE = re.compile(r"(?i)\b(?:pass(?:word|wd|phrase|wort)?|pwd|pw|contraseña|senha|hasło|wachtwoord|пароль)\s+([^\s\"'`,;()_]{8,})")
_LOGIN = re.compile(r"(?i)\b(?:log ?in|credentials?|account|creds|user)\b\s*+[:=]?+\s*+[\w.@\-]++\s*+[/|]\s*+([^\s,;\"'/]{6,})")
#: Files that are configuration by their path; in them, names that say less also count, and in some of them a login is a line of its own.
CONFIGURATION = re.compile(r"(?i)(?:\A|/)(?:\.env[^/]*|\.?(?:npmrc|pypirc|s3cfg|boto|my\.cnf|dockercfg)|credentials|[^/]+\.(?:env|ini|cfg|conf|cnf|config|properties|ya?ml|toml|json|xml|tf|tfvars|plist))\Z")
_CONFIGURED = re.compile(r"(?i)(?:\A|[\s\"'`<{,._\-])(?:key|auth|cred|creds|pass|dsn_?key|sas)[\"'`]?\s*+(?:[:=>]|=>)\s*+[\"'`]?([^\s\"'`<>;,]++)")
PASSWORD_FILES = {
    ".pgpass": re.compile(r"(?m)^[^:#\n]++:(?:\d+|\*):[^:\n]*+:[^:\n]++:(.+)$"), "pgpass.conf": re.compile(r"(?m)^[^:#\n]++:(?:\d+|\*):[^:\n]*+:[^:\n]++:(.+)$"),
    ".netrc": re.compile(r"\bpassword\s++(\S+)"), "_netrc": re.compile(r"\bpassword\s++(\S+)"),
}

_PLACEHOLDER = re.compile(
    r"""(?ix) \A[xX0øØхХχΧのア字\W_]+\Z | \A[aA0\-]+\Z | \A(?: [*x.•\-_#?0]{3,} | <[^>]*>? | \$\{.* | \$\(.* | \$[A-Z_a-z]\w* | \{\{.* | %\(?\w+\)?[s%]? | \[[^\]]*\] | \{\w*\} | @[\w.]+@? )\Z
      | your[_\-\s]? | change[_\-\s]?(?:me|it|this) | replace[_\-\s]?(?:me|with|this) | placeholder | example | dummy | redacted | insert[_\-\s] | todo | fixme | fill[_\-\s]?in | xxxx | \*\*\* | \bnone\b | \bnull\b | undefined
      | \A(?:password|passwd|secret|token|test|testing|default|empty|bearer|true|false|string|str|required|optional|changeit|hunter2|foobar|secret[_\-]?key)\Z
      | \A(?:os|env|process|config|settings|secrets?|vault|getenv|environ|self|this|args|params|request|ctx|conf|options|system)[.\[(:] | getenv | environ | \(\s*\) | \A/|\Avault/|\A\./|\A~/ | :// | \A[\w.]+\(
    """
)
_WORDY = re.compile(r"[a-z]+(?:[_\-./ ][a-z]+)*\Z|[A-Z]+(?:[_\-][A-Z]+)*\Z|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*\Z")


def _strong_password(v: str) -> bool:
    """Mixed characters, as a person's or a machine's password has, and neither a name nor a path; what is long and has blanks is a text."""
    if len(v) < 6 or len(v) > 200 and len(v.split()) > 1 or _PLACEHOLDER.search(v) or _WORDY.match(v):
        return False
    kinds = sum((any(c.islower() for c in v), any(c.isupper() for c in v), any(c.isdigit() for c in v), any(not c.isalnum() for c in v)))
    return kinds >= 3 or kinds == 2 and len(v) >= 8 and any(c.isdigit() for c in v) and not re.match(r"\d+(?:[.\-:]\d+)*\w?\Z", v)


def _strong_key(v: str) -> bool:
    """Long, of an alphabet of keys, with letters and digits, and of many different characters."""
    return (
        len(v) >= 16 and re.fullmatch(r"[A-Za-z0-9+/_\-=.~]+", v) is not None and not _PLACEHOLDER.search(v)
        and any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and len(set(v)) >= 8
    )


def _login(encoded: str) -> bool:
    """Whether base64 holds user:password."""
    try:
        text = base64.b64decode(encoded + "=" * (-len(encoded) % 4), validate=True).decode("ascii")
    except (binascii.Error, ValueError):
        return False
    user, colon, word = text.partition(":")
    return bool(colon and user and text.isprintable() and re.fullmatch(r"[\w.@+\-]+", user) and len(word) >= 4 and not _PLACEHOLDER.search(word))


def _checked(kind: str, v: str) -> bool:
    """Structure of an issued token. A checksum that holds settles it; one that doesn't hold may be stale, and the form decides."""
    if kind in CHECKED and forge_checksum(v):
        return True
    body = re.sub(r"\A(?:[A-Za-z]{2,5}_(?:live_|test_|pat_)?|glpat-|xox\w-|pypi-|SG\.|AKIA|ASIA|AIza)", "", v)
    if "EXAMPLE" in v.upper() or len(set(body)) < 7 or re.search(r"(.)\1{5}", body) or re.search(r"(?i)x{5}|your|1234567890", body):
        return False
    if kind == "jwt":
        head = v.split(".")[0]
        try:
            return base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))[:1] == b"{"
        except (binascii.Error, ValueError):
            return False
    return any(c.isdigit() for c in body) or len(body) >= 20 and not body.isalpha() or body.isalpha() and not (body.islower() or body.isupper())


#: Kinds of tokens whose last six characters are a checksum of the others.
CHECKED = ("forge_token", "package_token")


def forge_checksum(token: str) -> bool:
    """Whether the last six characters of a forge token are the CRC-32 of the others, in base 62."""
    body, want = token[4:-6], token[-6:]
    n, digits = zlib.crc32(body.encode()), ""
    while n:
        n, k = divmod(n, 62)
        digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[k] + digits
    return digits.rjust(6, "0") == want


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for k in KEYWORDS:
        a.add_word(k, len(k))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """text in lower case, character by character, so that places are the same."""
    low = (text if text.isascii() else text.translate(_ALIKE)).lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text.translate(_ALIKE))


def line_hits(line: str, low: str | None = None) -> Iterator[Hit]:
    """Credentials on one line, other than private keys; places are in the line, low is the line in lower case."""
    low = lowered(line) if low is None else low
    for m in _ISSUED.finditer(line):
        kind = ISSUERS[int(m.lastgroup[1:])][0]
        if _checked(kind, m[0]):
            yield Hit(m.start(), m.end(), kind)
    if "://" in line:
        for m in _URL.finditer(line):
            if not _PLACEHOLDER.search(m[2]) and not _WORDY.match(m[2]):
                yield Hit(m.start(2), m.end(2), "url_login")
    for m in _CONNECT.finditer(line):
        if _strong_password(m[1]) or _strong_key(m[1]):
            yield Hit(m.start(1), m.end(1), "connection")
    for m in _NAMED.finditer(low):
        g = "quoted" if m["quoted"] is not None else "bare"
        v = line[m.start(g): m.end(g)]
        if len(v) < 6:
            continue
        v = v.rstrip(";,)") if g == "bare" else v
        name = _BEFORE.search(low, max(0, m.start() - NAME), m.start())[0] + m["name"]
        if re.search(r"public|verify|\Ano[_\-]|cert", name):
            continue
        ok = _strong_key(v) or _strong_password(v) if re.search(r"pass|pw|contras|senha|has|парол|wacht", name) else _strong_key(v)
        if ok and not (g == "bare" and re.search(r"[()\[\]{}]|\A\w+\.\w+", v)):
            yield Hit(m.start(g), m.start(g) + len(v), "named")
    for m in _ENCODED.finditer(line):
        if _login(m[1]):
            yield Hit(m.start(1), m.end(1), "encoded_login")
    for m in _CALL.finditer(line):
        if not _CALLED.search(m[1]):
            continue
        args = list(_STRING.finditer(m[2]))
        if args and len(args) >= (1 if "pass" in m[0].lower() else 2) and _strong_password(args[-1][2]) and " " not in args[-1][2]:
            yield Hit(m.start(2) + args[-1].start(2), m.start(2) + args[-1].end(2), "call")
    curl = re.search(r"(?i)\bcurl\b", line)
    if curl:
        for m in _CURL.finditer(line, curl.end()):
            if _strong_password(m[2]):
                yield Hit(m.start(2), m.end(2), "curl_login")
    for pattern, group, kind in ((_BEARER, 1, "bearer"), (_SAID, 1, "said"), (_SAID_BARE, 1, "said"), (_LOGIN, 1, "said")):
        for m in pattern.finditer(line):
            v = m[group].rstrip(".)]") if kind == "said" and not m[group][-1:].isalnum() and len(m[group]) > 8 and m[group][-2:-1].isalnum() and m[group][-1] in ").]" else m[group]
            if (_strong_key if kind == "bearer" else _strong_password)(v) and (pattern is not _SAID_BARE or any(c.isdigit() for c in v) and any(c.isalpha() for c in v)):
                yield Hit(m.start(group), m.start(group) + len(v), kind)


def _keys(text: str) -> Iterator[tuple[int, int]]:
    """Private keys with a body: from BEGIN to the END of the same kind if all between is body, else to the last line that is."""
    marks = list(_MARK.finditer(text))
    for m, after in zip(marks, [*marks[1:], None]):
        if m[1] != "BEGIN":
            continue
        closed = after is not None and after[1] == "END" and after[2] == m[2]
        stop = after.start() if after is not None else len(text)
        at, end, runs, seen = m.end(), m.end(), False, set()
        while at <= stop:
            cut = _PEM_END.search(text, at, stop)
            upto = cut.start() if cut else stop
            line = text[at:upto]
            if closed or upto - at < 200:  # a line of an open key is short; nothing long is copied
                bare = line.strip(_PEM_AROUND)
                body = _PEM_LINE.fullmatch(bare) is not None and (closed or not bare or len(bare) >= 16 or bare.endswith("="))
            else:
                bare, body = "", False
            if not body and not _PEM_HEAD.fullmatch(bare):
                break
            if body and bare:
                runs = runs or _PEM_RUN.search(bare) is not None
                seen.update(bare[:200])
                end = at + len(line.rstrip(_PEM_AROUND))
            if not cut:
                at = stop + 1
                break
            at = cut.end()
        whole = at > stop or at == stop
        if runs and len(seen) > 8:
            yield (m.start(), after.end()) if closed and whole else (m.start(), end)


def hits(text: str, keywords: ahocorasick.Automaton, path: str | None = None) -> list[Hit]:
    """All credentials of a content, in order, without overlaps."""
    low = lowered(text)
    out: list[Hit] = []
    pem: list[tuple[int, int]] = []
    if "PRIVATE KEY" in text:
        pem = list(_keys(text))
        out += [Hit(a, b, "private_key") for a, b in pem]
    at = -1
    for end, _ in keywords.iter(low):
        if end < at:
            continue
        start = text.rfind("\n", 0, end + 1) + 1
        at = text.find("\n", end)
        at = len(text) if at < 0 else at
        out += [Hit(h.start + start, h.end + start, h.kind) for h in line_hits(text[start:at], low[start:at])]
    name = (path or "").rpartition("/")[2].lower()
    if name in PASSWORD_FILES:
        out += [Hit(m.start(1), m.end(1), "password_file") for m in PASSWORD_FILES[name].finditer(text) if len(m[1]) > 3 and not _PLACEHOLDER.search(m[1])]
    elif path and CONFIGURATION.search(path):
        for m in _CONFIGURED.finditer(text):
            if _strong_key(m[1]) and not re.search(r"[()\[\]{}]|\A\w+\.\w+", m[1]):
                out.append(Hit(m.start(1), m.end(1), "configured"))
    out.sort(key=lambda h: (h.start, -h.end))
    kept: list[Hit] = []
    k = 0
    for h in out:
        while k < len(pem) and pem[k][1] <= h.start:
            k += 1
        inside = k < len(pem) and pem[k][0] < h.start
        if (not kept or h.start >= kept[-1].end) and (h.kind == "private_key" or not inside):
            kept.append(h)
    return kept


_FILL = str.maketrans(
    {**{c: "x" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}}
)
#: Hexadecimal text keeps its alphabet.
_HEX = re.compile(r"(?:0x)?(?:[0-9a-f\-]{8,}|[0-9A-F\-]{8,})\Z")
_FILL_HEX = str.maketrans({**{c: "a" for c in "abcdef"}, **{c: "A" for c in "ABCDEF"}, **{c: "0" for c in "123456789"}})
#: What other letters become, small and capital: one of their script.
SCRIPTS = {"LATIN": "øØ", "CYRILLIC": "хХ", "GREEK": "χΧ", "HIRAGANA": "のの", "KATAKANA": "アア", "CJK": "字字"}
#: What an issuer puts before the secret part of a token; it stays.
_PREFIX = re.compile(r"(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|npm_|pypi-|xox\w-|[rs]k_(?:live|test)_|AIza|SG\.|hf_|dop_v1_|shp(?:at|ca|pa|ss)_)")


def _other(c: str) -> str:
    """The filler of a character outside ASCII: letters and digits go, signs stay."""
    if not c.isalnum():
        return c
    pair = SCRIPTS.get(unicodedata.name(c, "").split(" ")[0])
    return pair[c.isupper()] if pair else "0" if c.isdigit() else "x"


def filled(v: str) -> str:
    """A placeholder of the same length and alphabet."""
    if _HEX.match(v):
        return v[:2].replace("0X", "0x") + v[2:].translate(_FILL_HEX) if v[:2] == "0x" else v.translate(_FILL_HEX)
    out = v.translate(_FILL)
    return out if out.isascii() else "".join(c if c < "\x80" else _other(c) for c in out)


def redact(text: str, found: list[Hit]) -> str:
    """text with every credential replaced by one of the same length and alphabet; prefixes of issuers, signs and line ends stay."""
    out, at = [], 0
    for h in found:
        part = text[h.start:h.end]
        if h.kind == "private_key":
            head = _MARK.match(part)[0]
            tail = re.search(r"-----END [^-]*-----\Z", part)
            tail = tail[0] if tail else ""
            mid = part[len(head): len(part) - len(tail)]
            part = head + re.sub(r"\\[nrt]|&#\w{2,3};|%0[aAdD]|<br ?/?>|.", lambda m: m[0] if len(m[0]) > 1 else m[0].translate(_FILL), mid, flags=re.S) + tail
        else:
            m = _PREFIX.match(part) if h.kind in _ISSUED_KINDS else None
            part = m[0] + filled(part[m.end():]) if m else filled(part)
        out += [text[at:h.start], part]
        at = h.end
    return "".join(out) + text[at:]


def _scan(with_text: bool):
    def make():
        keywords = automaton()

        def fn(c: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("blob_id", "path", "lines", "kinds", *(["redacted"] if with_text else []))}
            for blob, path, text in zip(c["blob_id"], c["path"], c["content"]):
                found = hits(text, keywords, path) if text else []
                if not found and not with_text:
                    continue
                out["blob_id"].append(blob)
                out["path"].append(path)
                lines, at, line = [], 0, 1
                for h in found:
                    line += text.count("\n", at, h.start)
                    at = h.start
                    lines.append(line)
                out["lines"].append(lines)
                out["kinds"].append([h.kind for h in found])
                if with_text:
                    out["redacted"].append(redact(text, found) if found else text)
            return out

        return fn

    return make


def scan(raw: DataFrame) -> DataFrame:
    """blob_id, path, line_no and kind of each credential; the contents don't leave the Python workers."""
    rows = batches(raw.select("blob_id", "path", "content"), _scan(False), "blob_id string, path string, lines array<bigint>, kinds array<string>")
    return rows.select("blob_id", "path", F.explode(F.arrays_zip("lines", "kinds")).alias("h")).select("blob_id", "path", F.col("h.lines").alias("line_no"), F.col("h.kinds").alias("kind"))


def redacted(raw: DataFrame) -> DataFrame:
    """blob_id, path, redacted content and number of credentials, one row for each row."""
    rows = batches(raw.select("blob_id", "path", "content"), _scan(True), "blob_id string, path string, lines array<bigint>, kinds array<string>, redacted string")
    return rows.select("blob_id", "path", F.col("redacted").alias("content"), F.size("lines").alias("n_credentials"))


def found(raw: DataFrame) -> DataFrame:
    """p5_found: one row for each line on which a credential begins."""
    return scan(raw).where("blob_id is not null").select("blob_id", "line_no").distinct()
