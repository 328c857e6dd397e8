"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust a score.

Base kinds (email, ip, card, phone) are decided by pattern and validator alone and are always reported.
Further kinds are reported when their score reaches `THRESHOLD`: a validator (mod-97 for bank accounts)
or context words close by (for identity numbers, national phone numbers and secrets) must speak for them.

Each text is scanned whole and in linear time; nothing is shuffled. A null text is an empty one, with no
spans. Repeated rows give repeated results, an empty table an empty one; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import map_batches, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone", "secret")
THRESHOLD = 0.6
#: Characters before and after a span in which context words count.
CONTEXT_CHARS = 48

CONTEXT: dict[str, re.Pattern[str]] = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|address)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|login|client)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|credit|payment|mastercard|amex)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax|cell)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|bank|account|konto)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security|taxpayer)\b"),
    "local_phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax|cell)\b"),
    "secret": re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|credential)"),
}
#: Score of a validated match before context; a checksum or a strict form earns more.
SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "local_phone": 0.4, "secret": 0.3}
CONTEXT_BONUS = 0.35
#: Words that speak against: version numbers, part numbers, examples.
AGAINST = re.compile(r"(?i)\b(?:version|release|isbn|part no|serial|order no)\b")
AGAINST_MALUS = 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run that fails at its first digit fails at all others, hence the look-behind
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[A-Za-z0-9_]{3,8}_[A-Za-z0-9]{20,64})(?![A-Za-z0-9])")
_NOT_DIGITS = {ord(c): None for c in " -().+"}
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(_DOUBLED[int(c)] for c in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    """The account number with its first four characters moved to the end, letters as 10 to 35, leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Works outwards from each @, so that long runs of letters cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return text.translate(_NOT_DIGITS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base kinds, in order."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 or not p.lstrip("0")[3:] for p in m[0].split(".")) and all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _IBAN.finditer(text):
        if 15 <= len(a := m[0].replace(" ", "")) <= 34 and mod97(a):
            yield "iban", m.start(), m.end()
    for kind, pattern in (("ssn", _SSN), ("local_phone", _LOCAL_PHONE)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def _secrets(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _SECRET.finditer(text):
        yield "secret", m.start(), m.end()


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
    score = SCORE[kind] + CONTEXT_BONUS * bool(CONTEXT[kind].search(near)) - AGAINST_MALUS * bool(AGAINST.search(near))
    return round(min(1.0, max(0.0, score)), 2)


#: What texts with an account, identity or phone number have, and what those with a secret have.
_MAYBE = re.compile(r"[0-9]{2}")
_MAYBE_SECRET = re.compile(r"_[A-Za-z0-9]{20}|[0-9a-f]{32}")


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """Base spans, and all spans with their scores; the added ones don't overlap base ones."""
    base = base_spans(text)
    every = [(s, k, e, _score(KINDS[k], text, s, e)) for s, k, e in base]
    proposed = [*(_proposed(text) if _MAYBE.search(text) else ()), *(_secrets(text) if _MAYBE_SECRET.search(text) else ())]
    if proposed:
        taken = [(s, e) for s, _, e in base]
        for kind, s, e in proposed:
            if (score := _score(kind, text, s, e)) >= THRESHOLD and not any(a < e and s < b for a, b in taken):
                every.append((s, KINDS.index(kind), e, score))
        every.sort()
    return base, every


def _named(spans: list) -> str:
    return ",".join(f"{KINDS[x[1]]}:{x[0]}:{x[2]}" for x in spans)


_NONE = hashlib.sha256(b"").hexdigest()


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts by base kind, a digest of the base spans, all spans and their scores."""

    def scan(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "scores")}
        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            base, every = find(text or "")
            out["doc_id"].append(doc_id)
            for i, kind in enumerate(BASE_KINDS):
                out[f"n_{kind}"].append(sum(k == i for _, k, _ in base) if base else 0)
            out["base_sha256"].append(hashlib.sha256(_named(base).encode()).hexdigest() if base else _NONE)
            out["spans"].append(_named(every))
            out["scores"].append([x[3] for x in every])
        return out

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return map_batches(rows, scan, f"doc_id {id_type}, {counts}, base_sha256 string, spans string, scores array<double>")


def redact(text: str) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, last = [], 0
    for s, k, e, _ in find(text)[1]:
        if s >= last:
            out += [text[last:s], f"[{KINDS[k].upper()}]"]
        last = max(last, e)
    return "".join([*out, text[last:]])


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
