"""Secret scan: Aho-Corasick keywords, anchored patterns at the hits, checksums inside the tokens."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import ASCII_LOWER, map_rows, table

Span = tuple[int, int, str]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]+")
JWT_PART = re.compile(r"[A-Za-z0-9_-]+")
PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")

#: Digits of the checksum at the end of GitHub's and npm's tokens, a fixed value.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_holds(body: str) -> bool:
    """The last six characters are the CRC-32 of the first thirty, in base 62."""
    rest, digits = zlib.crc32(body[:30].encode()), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = BASE62[digit] + digits
    return digits == body[30:]


def jwt_holds(header: str, claims: str) -> bool:
    """Header and claims are base64url of JSON objects, and the header names an algorithm.

    One that nests deeper than the JSON reader goes is no token.
    """
    try:
        head, body = (json.loads(base64.urlsafe_b64decode(x + "=" * (-len(x) % 4))) for x in (header, claims))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(head, dict) and "alg" in head and isinstance(body, dict)


def der_holds(block: str) -> bool:
    """The block is base64 of one DER sequence whose stated length is its real one."""
    try:
        der = base64.b64decode("".join(block.split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    wide = der[1] & 0x7F
    return len(der) == 2 + wide + int.from_bytes(der[2 : 2 + wide], "big")


#: Per kind: keywords (lower case), where a match starts seen from the keyword, pattern, and what it must fulfil.
#: The order is that of kinds in a list of spans; the first and second, with ``hex``, are the base kinds.
RULES: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN, lambda m: len(m[2]) >= 8),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= 16),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, lambda m: crc_holds(m[1])),
    "npm": (("npm_",), NPM, lambda m: crc_holds(m[1])),
    "jwt": (("eyj",), JWT, lambda m: jwt_holds(m[1], m[2])),
    "pem": (("-----begin ",), PEM, lambda m: der_holds(m[2])),
}
#: Kinds whose patterns start with a run of this form: where no match starts at one keyword in a run, none starts at a later one.
RUNS: dict[str, re.Pattern] = {"jwt": JWT_PART}
KINDS = ["assign", "access", "hex", "github", "npm", "jwt", "pem"]
BASE = KINDS[:3]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, (keywords, _, _) in RULES.items():
        for keyword in keywords:
            found.add_word(keyword, (kind, len(keyword)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """In lower case, with each character at its place. (A few letters outside ASCII get longer.)"""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(ASCII_LOWER)


def find_secrets(text: str | None, keywords: ahocorasick.Automaton) -> list[Span]:
    """Spans (start, end, kind) in code points, by start and then kind as in ``KINDS``.

    A pattern is tried only where one of its keywords starts. As every match
    starts with a keyword, going from left to right past each match gives the
    leftmost non-overlapping matches of a scan of the whole text. A run in which
    no token starts is left after its first keyword, so the time is linear in the
    text. Long runs of hexadecimal digits have no keyword and are looked for by themselves.
    """
    if not text:
        return []
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    starts: dict[str, list[int]] = {}
    for last, (kind, length) in keywords.iter(lowered(text)):
        starts.setdefault(kind, []).append(last + 1 - length)
    for kind, places in starts.items():
        _, pattern, holds = RULES[kind]
        past, run = 0, RUNS.get(kind)
        for start in sorted(places):
            if start < past:
                continue
            if m := pattern.match(text, start):
                past = m.end()
                if holds(m):
                    spans.append((m.start(), m.end(), kind))
            # The keyword is found in any case of its letters, so a run's later keyword may be the first that fits.
            elif run and text.startswith("eyJ", start):
                past = run.match(text, start).end()
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the secrets of each row's text.

    ``secrets`` holds every span with its text. A row is scanned whole and by
    itself, so repeated rows repeat and long texts are only slower. A null or
    empty text has no spans. ``docs`` must not hold a kept column ``secrets``.
    """

    def rows(texts):
        keywords = automaton()
        for text in texts:
            yield ([{"kind": k, "start": s, "end": e, "text": text[s:e]} for s, e, k in find_secrets(text, keywords)],)

    return map_rows(docs, keep, ["text"], rows, "secrets array<struct<kind:string,start:long,end:long,text:string>>")


def digest(found: DataFrame, keep: list[str]) -> DataFrame:
    """Counts and digests of the ``secrets`` of ``scan``."""

    def rows(lists):
        for secrets in lists:
            spans = [(s["start"], s["end"], s["kind"]) for s in secrets]
            base = [s for s in spans if s[2] in BASE]
            counts = [sum(s[2] == kind for s in base) for kind in BASE]
            yield (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    ddl = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_rows(found, keep, ["secrets"], rows, ddl)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])
