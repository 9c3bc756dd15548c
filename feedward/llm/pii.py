"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs the
labelers, and a span classifier trained on its posteriors judges the doubtful spans.

Candidates come from regular expressions. Regex, gazetteer and context labelers vote yes,
no or nothing on each. The votes of the whole corpus are counted by pattern (at most 3 to
the power of the number of labelers), and expectation-maximisation on those counts, which
equals that on all spans, gives each labeler's reliability and each pattern's posterior.
The posteriors then train a logistic classifier on the span's own features.
"""

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, per_text

#: Kinds in listing order; the last four are the method's own.
KINDS = ("email", "ip", "card", "phone", "email_masked", "phone_local", "ssn", "iban")
BASE_KINDS = KINDS[:4]

# Patterns and digit limits of the base kinds are part of the contract.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

EMAIL_MASKED = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?|\.)[A-Za-z0-9-]{1,63})+"
)
PHONE_LOCAL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

NOT_DIGITS = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\W\d_]+")
#: Gazetteers: words that stand near personal data of a kind, and words that speak against it.
CUES = {
    "email": frozenset({"email", "mail", "contact", "write", "correo", "courriel", "kontakt", "reach"}),
    "ip": frozenset({"ip", "address", "host", "server", "client", "login", "adresse"}),
    "card": frozenset({"card", "visa", "mastercard", "credit", "payment", "tarjeta", "carte", "karte"}),
    "phone": frozenset({"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"}),
    "ssn": frozenset({"ssn", "social", "security", "taxpayer"}),
    "iban": frozenset({"iban", "account", "bank", "konto", "compte", "cuenta"}),
}
CUES["email_masked"], CUES["phone_local"] = CUES["email"], CUES["phone"]
AGAINST = frozenset({"version", "release", "isbn", "issn", "doi", "order", "invoice", "serial", "page", "section", "model"})
NAMES = frozenset(
    """anna ben carlos chen david elena emma eva fatima hans ivan james jan jean john jose juan karl laura
    linda lucia maria mario marie mary michael mohammed nina olga paul peter pierre robert sara sofia thomas
    yuki""".split()
)
CONTEXT = 48  # characters on either side


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _mod_97(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards so that long words cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        if host := EMAIL_HOST.match(text, at):
            start = at
            while start > done and EMAIL_LOCAL.match(text, start - 1, start):
                start -= 1
            if start < at:
                done = host.end()
                yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in IP.finditer(text):
        if all(map(_small, match.groups())):
            yield match.span()


def _digits(match: re.Match) -> str:
    return NOT_DIGITS.sub("", match[0])


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 16 and 16 <= len(digits := _digits(match)) <= 19 and luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in PHONE.finditer(text):
        if 8 <= len(_digits(match)) <= 15:
            yield match.span()


def _spans(pattern: re.Pattern):
    return lambda text: (match.span() for match in pattern.finditer(text))


FINDERS = {
    "email": emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
    "email_masked": _spans(EMAIL_MASKED),
    "phone_local": _spans(PHONE_LOCAL),
    "ssn": _spans(SSN),
    "iban": _spans(IBAN),
}
#: What a text must contain for a finder to be worth trying.
NEEDS = {
    "email_masked": re.compile(r"[\[(]\x20?(?:at|AT)\x20?[\])]"),
    "phone_local": re.compile(r"[0-9]{3}[.-][0-9]{4}"),
    "ssn": re.compile(r"[0-9]-[0-9]{2}-[0-9]"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}"),
}
DIGIT = re.compile(r"[0-9]")


def _plausible(kind: str, span: str) -> int:
    """Regex labeler: is the span well-formed beyond its pattern?"""
    digits = NOT_DIGITS.sub("", span)
    if kind == "iban":
        return 1 if _mod_97(span) else -1
    if kind == "ssn":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or "0000" == digits[5:] or digits[3:5] == "00" else 1
    if kind == "card":
        return 1 if digits[0] in "23456" else -1
    if kind == "phone_local":
        return 1 if digits[0] not in "01" and digits[3] not in "01" else -1
    if kind == "ip":
        return -1 if digits.strip("0") == "" else 1
    if kind in ("email", "email_masked"):
        return 1 if re.search(r"[A-Za-z]{2,}$", span) else -1
    return 1 if len(digits) >= 10 else 0


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """One vote (1, 0 or -1) of each labeler on a span."""
    before, span, after = text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT]
    words = [word.lower() for word in WORD.findall(before)][-6:] + [word.lower() for word in WORD.findall(after)][:3]
    cue = 1 if CUES[kind].intersection(words) else 0
    against = -1 if AGAINST.intersection(words) else 0
    names = 1 if NAMES.intersection(words) or NAMES.intersection(re.split(r"[^a-z]+", span.lower())) else 0
    label = 1 if before.rstrip().endswith(":") else 0
    glued = -1 if (before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in "$€£#/=_" and before) else 1
    return _plausible(kind, span), cue, against, names, label, glued


LABELERS = 6


def features(kind: str, span: str, vote: tuple[int, ...]) -> tuple[int, ...]:
    """Zero-one features of a span for the classifier: votes for and against, shape, kind."""
    digits = len(NOT_DIGITS.sub("", span))
    shape = (digits == 0, digits >= 10, " " in span, len(span) >= 16)
    return tuple(int(v > 0) for v in vote) + tuple(int(v < 0) for v in vote) + tuple(map(int, shape)) + tuple(int(kind == k) for k in KINDS)


def candidates(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, votes, features) of every candidate, by kind as listed and start.

    Votes and features are packed into a number each. A span of the method's own kinds
    that overlaps a base span is no candidate.
    """
    found, taken = [], []
    has_digit = DIGIT.search(text) is not None
    for kind in KINDS:
        if kind in NEEDS:
            if not NEEDS[kind].search(text):
                continue
        elif kind != "email" and not has_digit:
            continue
        for start, end in FINDERS[kind](text):
            if kind in BASE_KINDS:
                taken.append((start, end))
            elif _overlaps(taken, start, end):
                continue
            vote = votes(kind, text, start, end)
            packed = sum((v + 1) * 3**i for i, v in enumerate(vote))
            bits = sum(f << i for i, f in enumerate(features(kind, text[start:end], vote)))
            found.append((kind, start, end, packed, bits))
        if kind == BASE_KINDS[-1]:
            taken = _merged(taken)
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same positions."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _overlaps(merged: list[tuple[int, int]], start: int, end: int) -> bool:
    """Does the span meet the last of the disjoint spans that begin before its end?"""
    place = bisect_left(merged, (end, 0))
    return place > 0 and merged[place - 1][1] > start


@dataclass
class Reliability:
    """Prior of a true span and each labeler's chances of its votes, by true class."""

    prior: float
    chances: np.ndarray  # labeler x class (false, true) x vote (-1, 0, 1)

    def posterior(self, packed: np.ndarray) -> np.ndarray:
        log = np.log(np.array([1 - self.prior, self.prior])) + np.zeros((len(packed), 2))
        for labeler, vote in enumerate(unpack(packed)):
            log += np.log(self.chances[labeler][:, vote]).T
        log -= log.max(axis=1, keepdims=True)
        odds = np.exp(log)
        return odds[:, 1] / odds.sum(axis=1)


def unpack(packed: np.ndarray) -> list[np.ndarray]:
    return [packed // 3**i % 3 for i in range(LABELERS)]


def estimate(packed: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> Reliability:
    """Expectation-maximisation over counted vote patterns.

    It starts from the belief that a vote is right more often than wrong, which also
    settles which of the two classes is the true one.
    """
    start = np.array([[[0.5, 0.35, 0.15], [0.15, 0.35, 0.5]]] * LABELERS)
    model = Reliability(0.5, start)
    votes_by = unpack(packed)
    for _ in range(rounds if len(packed) else 0):
        true = model.posterior(packed)
        weight = np.stack([counts * (1 - true), counts * true])
        chances = np.empty_like(start)
        for labeler, vote in enumerate(votes_by):
            for value in range(3):
                chances[labeler][:, value] = weight[:, vote == value].sum(axis=1)
        chances += smooth * start * 3
        chances /= chances.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + smooth) / (counts.sum() + 2 * smooth)
        if np.abs(chances - model.chances).max() < 1e-9:
            break
        model = Reliability(float(prior), chances)
    return model


WIDTH = 2 * LABELERS + 4 + len(KINDS)


def unpack_bits(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(WIDTH) & 1).astype(float)


def train(bits: np.ndarray, target: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights (intercept last) of a logistic classifier on soft targets, by damped Newton steps."""
    rows = np.hstack([unpack_bits(bits), np.ones((len(bits), 1))])
    weights = np.zeros(WIDTH + 1)
    share = counts / max(1.0, counts.sum())
    ridge = 1e-4 * np.eye(WIDTH + 1)
    for _ in range(rounds if len(bits) else 0):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (share * (p - target)) + ridge @ weights
        curve = (rows * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows + ridge
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def classify(weights: np.ndarray, bits: np.ndarray) -> np.ndarray:
    score = unpack_bits(bits) @ weights[:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def _joined(spans: list) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def _row(text: str) -> tuple:
    found = candidates(text)
    base = [span for span in found if span[0] in BASE_KINDS]
    counts = [sum(span[0] == kind for span in base) for kind in BASE_KINDS]
    return *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), found


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Personal data of every whole text: counts and digest of base spans, and all spans.

    Base spans always stay; a span of the method's own kinds is added where the classifier
    gives it at least ``threshold``. ``found`` has all spans with their probability. A null or
    empty text has none; repeated rows give repeated rows, an empty table none, a null id
    stays null, other columns are ignored. Positions count code points, ends are exclusive.

    Texts are scanned once; the candidates are written, their vote and feature patterns
    counted over the whole corpus, and the classifier is applied to what was written.
    """
    schema = (
        "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "found array<struct<kind:string,start:long,end:long,votes:long,bits:long>>"
    )
    scanned = checkpointed(
        docs.select(F.col(id_col).alias("id"), per_text(_row, schema)(text_col).alias("s")).select("id", "s.*")
    )
    # The number of patterns is bounded by the labelers and features, not by the corpus.
    patterns = (
        scanned.select(F.explode("found").alias("c")).groupBy("c.votes", "c.bits").count().toPandas().astype("int64")
        .sort_values(["votes", "bits"])
    )
    packed, bits = patterns["votes"].to_numpy(), patterns["bits"].to_numpy()
    counts = patterns["count"].to_numpy().astype(float)
    weights = train(bits, estimate(packed, counts).posterior(packed), counts)

    @F.pandas_udf("spans string, found array<struct<kind:string,start:long,end:long,probability:double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flat = [span for spans in batch for span in spans]
            chance = classify(weights, np.array([s["bits"] for s in flat], np.int64)) if flat else []
            rows, at = [], 0
            for spans in batch:
                kept = [
                    (s["kind"], s["start"], s["end"], float(p))
                    for s, p in zip(spans, chance[at : at + len(spans)], strict=True)
                    if s["kind"] in BASE_KINDS or p >= threshold
                ]
                at += len(spans)
                rows.append((_joined(kept), kept))
            yield pd.DataFrame(rows, columns=["spans", "found"])

    judged = scanned.withColumn("j", judge("found"))
    counts_cols = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    return judged.select(F.col("id").alias(id_col), *counts_cols, "j.spans", "j.found")
