"""Secret scan: keyword automaton, anchored patterns only near its hits, embedded checksums."""

import base64
import hashlib
import json
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]

# The patterns are part of the contract or of public token formats.
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
GITHUB = re.compile(r"gh[opsur]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]+")
# Header lines may stand before the body.
PEM = re.compile(
    r"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY(?: BLOCK)?)-----(?:\s*[A-Za-z][A-Za-z0-9-]*: [^\r\n]*)*"
    r"[A-Za-z0-9+/=\s\\]*-----END \1-----"
)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

ANCHORED = {
    "assign": (ASSIGN, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    "access": (ACCESS, ("akia",)),
    "github": (GITHUB, ("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
    "npm": (NPM, ("npm_",)),
    "jwt": (JWT, ("eyj",)),
    "pem": (PEM, ("-----begin ",)),
}
MIN_HEX = 24


def base62_checksum(body: str) -> str:
    """The six closing characters of a token: CRC-32 of the body as a base-62 number."""
    number, digits = zlib.crc32(body.encode()), ""
    while number:
        number, digit = divmod(number, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def _is_json_object(part: str, key: str | None = None) -> bool:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (key is None or key in value)


def _is_valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= 6
    if kind == "access":
        return match.end() - match.start() >= 20
    if kind in ("github", "npm"):
        return base62_checksum(match[1]) == match[2]
    if kind == "jwt":
        header, payload, _ = match[0].split(".", 2)
        return _is_json_object(header, "alg") and _is_json_object(payload)
    return True


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, (_, keywords) in ANCHORED.items():
        for word in keywords:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


_AUTOMATON = _automaton()
_UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _folded(text: str) -> str:
    """Lower case at the same positions; one capital (I with dot) would grow by a character."""
    lower = text.lower()
    return lower if len(lower) == len(text) else text.translate(_UPPER)


def _long_hex(text: str) -> list[tuple[int, int]]:
    """Runs of ``[0-9a-f]`` of at least MIN_HEX: each covers a multiple of MIN_HEX, so only those are tried."""
    spans, done = [], 0
    for probe in HEX_PROBE.finditer(text[MIN_HEX - 1 :: MIN_HEX]):
        at = (probe.start() + 1) * MIN_HEX - 1
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in HEX_DIGITS:
            start -= 1
        done = HEX.match(text, at).end()
        if done - start >= MIN_HEX:
            spans.append((start, done))
    return spans


HEX_PROBE = re.compile(r"[0-9a-f]")
HEX_DIGITS = frozenset("0123456789abcdef")


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each secret, by start and then kind as listed; ends are exclusive.

    A pattern is tried only where a keyword hit begins, from left to right and never inside
    an earlier match of its kind. A match that fails its length or checksum is dropped.
    """
    found, done = [], dict.fromkeys(ANCHORED, 0)
    hits = {kind: [] for kind in ANCHORED}
    for last, (kind, length) in _AUTOMATON.iter(_folded(text)):
        hits[kind].append(last - length + 1)
    for kind, starts in hits.items():
        pattern = ANCHORED[kind][0]
        for start in sorted(starts):
            if start < done[kind]:
                continue
            if match := pattern.match(text, start):
                done[kind] = match.end()
                if _is_valid(kind, match):
                    found.append((start, match.end(), kind))
            elif kind == "jwt":  # every start in this run of characters fails alike
                done[kind] = JWT_RUN.match(text, start).end()
    found += [(start, end, "hex") for start, end in _long_hex(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _row(text: str) -> tuple:
    spans = find_secrets(text)
    base = [span for span in spans if span[2] in BASE_KINDS]
    counts = [sum(kind == k for _, _, kind in base) for k in BASE_KINDS]
    digest = hashlib.sha256(joined(base).encode()).hexdigest()
    return *counts, digest, joined(spans), [(k, s, e) for s, e, k in spans]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every whole text: counts and digest of the base kinds, all spans.

    A null or empty text has no secrets. Repeated rows give repeated rows, an empty table none,
    a null id stays null; other columns are ignored. Positions count code points. Work is
    one pass over each text, whatever its length; ``found`` has the spans as an array.
    """
    schema = (
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "found array<struct<kind:string,start:long,end:long>>"
    )
    scanned = docs.select(F.col(id_col).alias("id"), per_text(_row, schema)(text_col).alias("s"))
    return scanned.select(F.col("id").alias(id_col), "s.*")
