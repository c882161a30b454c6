"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts.

Four base kinds (email, ip, card, phone) keep every span whose check passes. Further kinds start
from a prior score that a checksum (IBAN: mod 97; card of 13 to 15 digits: Luhn) or words nearby
raise or lower; a span is kept from ``MIN_SCORE`` on, unless a base span covers part of it. A secret runs
to the end of its characters whatever its length; where base spans cover part of it, its other parts
of at least ``SECRET_PART`` characters are kept.

Defined results: a null or empty text has no spans; repeated rows give repeated results; an empty
table gives an empty table. Whole texts are read whatever their length: every pattern starts only
where a run of its characters starts, so time grows in step with the text. Columns other than the
key and the text are not read by ``find_personal_data`` and are passed through by ``redact``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "bank_card", "national_id", "local_phone", "secret")
KINDS = BASE_KINDS + EXTRA_KINDS
MIN_SCORE = 0.6
CONTEXT_CHARS = 40
SECRET_PART = 8

# The local part is the run before the @; it is found from the @ backwards.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"[0-9](?<![0-9+.-][0-9])[0-9]{2}\)?[\x20.-]{1,2}[0-9]{3}[.-][0-9]{4}(?![0-9.-])")
SECRET_VALUE = re.compile(r"[=:]\s{0,3}[\"']?([A-Za-z0-9+/_.-]{8,}+)")
SECRET_NAME = re.compile(r"(?i)(?:password|passwd|secret|token|api_?key)\s{0,3}\Z")
# Words whose presence nearby raises (+) or lowers (-) the score of a kind.
CONTEXT = {
    "iban": (("iban", "bank", "account", "konto", "transfer"), ("order", "serial")),
    "bank_card": (("card", "visa", "credit", "amex", "debit"), ("order", "invoice", "isbn")),
    "national_id": (("ssn", "social", "security", "identity"), ("part", "serial", "version")),
    "local_phone": (("phone", "tel", "call", "fax", "mobile"), ("order", "version", "total")),
    "secret": ((), ("example", "placeholder")),
}
PRIOR = {"iban": 0.5, "bank_card": 0.3, "national_id": 0.4, "local_phone": 0.4, "secret": 0.8}
CHECKSUM, NEAR = 0.4, 0.3


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    past = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            past = m.end()
            yield start, past


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four base kinds, ordered by kind and start."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def context_score(kind: str, text: str, start: int, end: int) -> float:
    near = set(re.findall(r"[a-z]+", (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()))
    good, bad = CONTEXT[kind]
    return PRIOR[kind] + NEAR * bool(near & set(good)) - NEAR * bool(near & set(bad))


def extra_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the scored kinds that no base span touches, ordered by kind and start."""
    taken = sorted((a, b) for _, a, b in base)
    furthest = list(accumulate((e for _, e in taken), max))  # end of the spans up to each
    free = lambda a, b: (i := bisect.bisect_left(taken, (b, 0))) == 0 or furthest[i - 1] <= a
    found = []

    def offer(kind: str, a: int, b: int, checksum: bool = False) -> None:
        if context_score(kind, text, a, b) + CHECKSUM * checksum >= MIN_SCORE and free(a, b):
            found.append((kind, a, b))

    def offer_secret(a: int, b: int) -> None:
        if context_score("secret", text, a, b) < MIN_SCORE:
            return
        for i in range(bisect.bisect_right(furthest, a), len(taken)):
            start, end = taken[i]
            if start >= b:
                break
            if start - a >= SECRET_PART:
                found.append(("secret", a, start))
            a = max(a, end)
        if b - a >= SECRET_PART:
            found.append(("secret", a, b))

    if not DIGIT.search(text):
        return found
    for m in IBAN.finditer(text):
        if 15 <= len(m.group().replace(" ", "")) <= 34 and mod97(m.group()):
            offer("iban", m.start(), m.end(), True)
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 15 and luhn(digits):
                offer("bank_card", m.start(), m.end())
    for m in SSN.finditer(text):
        offer("national_id", m.start(), m.end())
    for m in LOCAL_PHONE.finditer(text):
        offer("local_phone", m.start(), m.end())
    if "=" in text or ":" in text:
        for m in SECRET_VALUE.finditer(text):
            if any(map(str.isdigit, m.group(1))) and SECRET_NAME.search(text[max(0, m.start() - 20) : m.start()]):
                offer_secret(*m.span(1))
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans as one."""
    out, past = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= past:
            out += [text[past:a], f"<{kind.upper()}>"]
        past = max(past, b)
    return "".join(out) + text[past:]


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f"n_{k}": [] for k in BASE_KINDS} | {"base_sha256": [], "spans": []}
            for value in batch.column(1):
                body = value.as_py() or ""
                base = base_spans(body)
                for k in BASE_KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + extra_spans(body, base)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], [key, *out])

    return docs.select(key, text).mapInArrow(scan, schema)


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The same rows and columns with the personal data in ``text`` replaced; nulls stay null.
    ``length`` names a column that holds the text's length and is brought up to date."""

    @F.pandas_udf("string")
    def clean(column):
        def one(body):
            if not body:
                return body
            base = base_spans(body)
            spans = base + extra_spans(body, base)
            return redacted(body, spans) if spans else body

        return column.map(one, na_action="ignore")

    out = docs.withColumn(text, clean(F.col(text)))
    if length:
        kind = dict(docs.dtypes)[length]
        out = out.withColumn(length, F.coalesce(F.length(text).cast(kind), F.col(length)))
    return out
